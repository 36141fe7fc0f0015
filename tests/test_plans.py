
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from crewload import params as P
from crewload.operators.dedup import first_per_key
from crewload.plans import fa, reconcile as rc
from crewload.session import scratch_path
from crewload.sources import fixtures, history


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def history_path(spark):
    """The derived log written the way a production table is laid out."""
    path = scratch_path(spark, "history")
    fixtures.txn(spark, SF_SMALL).write.partitionBy("BID_PERIOD").parquet(path)
    return path


@pytest.fixture(scope="module")
def history_table(spark, history_path):
    return spark.read.parquet(history_path)


def test_window_scan_pushes_day_range(spark, history_table):
    lo, hi = P.DEFAULT.bounds(P.DEFAULT.fa_window)
    s = plan(history.scan_window(history_table, lo, hi).select("CREW_ID"))
    assert "PushedFilters: [IsNotNull(PAIRING_DATE), GreaterThanOrEqual(PAIRING_DATE" in s
    assert "ReadSchema: struct<CREW_ID:string,PAIRING_DATE:date>" in s


def test_backfill_scan_prunes_partitions(spark, history_table):
    s = plan(history.scan_bid_periods(history_table, "2024-02", "2024-03"))
    assert "PartitionFilters: [isnotnull(BID_PERIOD" in s


def test_first_per_key_limits_before_shuffle(spark, history_table):
    df = first_per_key(history_table, ["CREW_ID", "PAIRING_DATE"], [F.col("TXN_SEQ")])
    s = plan(df)
    assert "WindowGroupLimit" in s


def test_backfill_reads_the_log_once(spark, history_table, history_path):
    scan = fa.fa_scan(history_table, P.DEFAULT, True)
    firsts = fa.fa_backfill_firsts(scan, P.DEFAULT)
    assert plan(firsts).count("FileScan parquet") == 1
    silver = fa.fa_silver(history_table, P.DEFAULT, True)
    name = history_path.rstrip("/").rsplit("/", 1)[-1]
    assert name not in plan(silver)  # every branch reads the staged rows, not the log


def test_day_flags_are_one_hash_aggregate(spark, history_table):
    s = plan(rc.day_flags(rc.explore_rows(history_table)))
    assert "partial_max" in s and s.count("HashAggregate") == 2
    assert "SortAggregate" not in s and "Sort [" not in s
    assert s.count("Exchange") == 1


def test_single_steps_stage_only_what_they_read(spark):
    import __spark_entry__ as E
    from crewload.session import staging_scope

    for name, most in [("last_position", 0), ("overlap_days", 0), ("released_after_asn", 0), ("paid_assignments", 1)]:
        with staging_scope(spark) as staged:
            E.queries()[name](spark, SF_SMALL)
            assert len(staged) == most, name


@pytest.mark.parametrize("name", ["fa_backfill", "pilot_backfill", "reconciled_days", "utilization_hnl", "append_batch"])
def test_no_cartesian_products(spark, name):
    import __spark_entry__ as E

    s = plan(E.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in s and "BroadcastNestedLoopJoin" not in s


def test_broadcast_only_when_measured_small(spark, history_table):
    from crewload.operators.joins import broadcast_if_small, join_null_safe
    from crewload.session import stage

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # no plan-time guesses
    try:
        dim = stage(history_table.select("CREW_ID", "BASE").distinct(), "dim").withColumnRenamed("BASE", "B2")
        small = join_null_safe(history_table, broadcast_if_small(dim), ["CREW_ID"])
        assert "BroadcastHashJoin" in plan(small)
        big = join_null_safe(history_table, broadcast_if_small(dim, max_bytes=16), ["CREW_ID"])
        assert "BroadcastHashJoin" not in plan(big)
        bounded = broadcast_if_small(dim, max_bytes=1 << 20, bound_from=history_table.select("CREW_ID", "BASE"))
        assert "BroadcastHashJoin" in plan(join_null_safe(history_table, bounded, ["CREW_ID"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
