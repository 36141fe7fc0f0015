"""The named silver table: guard without a shuffle of the target, overwrite
that survives failures, rows counted by the write."""

import pytest
from conftest import D
from pyspark.sql import functions as F

from crewload.schema import SILVER
from crewload.session import scratch_path, stage
from crewload.sinks import tables
from crewload.sinks.catalog import SilverTable, row_key


def rows(spark, items):
    return spark.createDataFrame([("FA", crew, "RLV", day, "FA", period, base, "NA") for crew, day, period, base in items], SILVER)


@pytest.fixture
def table(spark):
    place = scratch_path(spark, "db")
    return SilverTable(spark, f"t_{place[-12:]}.silver", 4, place)


OLD = [("a", D(1, 1), "2024-01", "HNL"), ("b", D(2, 2), "2024-02", None), (None, None, None, None), ("d", D(3, 3), "2024-03", "SEA")]


def test_guard_shuffles_only_the_batch(spark, table):
    table.overwrite(rows(spark, OLD))
    batch = stage(rows(spark, [*OLD, ("e", D(2, 2), "2024-02", None)]), "batch")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = table.new_rows(batch, ["2024-01", "2024-02", "2024-03", None])
        text = new._jdf.queryExecution().executedPlan().toString()
        assert text.count("Exchange") == 1 and "Bucketed: true" in text and "LeftAnti" in text
        target = text[text.rindex("Sort [") :]
        assert "FileScan" in target and "Exchange" not in target  # nothing between the scan and the join
        assert [r.CREW_ID for r in new.collect()] == ["e"]
        pruned = table.new_rows(batch, ["2024-02"])._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(BID_PERIOD" in pruned or "PartitionFilters: [(BID_PERIOD" in pruned
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_second_append_adds_nothing(spark, table):
    table.overwrite(rows(spark, OLD[:1]))
    batch = rows(spark, [*OLD, OLD[1]])  # a row twice in the batch: both are kept
    assert [table.append(batch) for _ in range(2)] == [4, 0]
    assert table.read().count() == 5 and table.read().columns == [f.name for f in SILVER.fields]
    assert sorted(table.periods(), key=str) == ["2024-01", "2024-02", "2024-03", None]


def test_overwrite_drops_old_periods_and_survives_failure(spark, table):
    assert table.overwrite(rows(spark, OLD)) == 4
    with pytest.raises(Exception, match="planned"):
        table.overwrite(rows(spark, OLD).withColumn("BASE", F.raise_error(F.lit("planned")).cast("string")))
    assert table.read().count() == 4
    assert table.overwrite(rows(spark, OLD[1:2])) == 1
    assert table.periods() == ["2024-02"] and table.read().count() == 1
    assert table.overwrite(rows(spark, [])) == 0 and table.read().count() == 0


def test_path_overwrite_survives_failure(spark):
    path = scratch_path(spark, "safe")
    assert tables.write_overwrite(rows(spark, OLD), path) == 4
    with pytest.raises(Exception, match="planned"):
        tables.write_overwrite(rows(spark, OLD).withColumn("BASE", F.raise_error(F.lit("planned")).cast("string")), path)
    assert tables.read_silver(spark, path).count() == 4
    assert tables.write_overwrite(rows(spark, OLD[:1]), path) == 1
    assert [r.CREW_ID for r in tables.read_silver(spark, path).collect()] == ["a"]


def test_sinks_take_a_table_name(spark, table):
    assert tables.is_name("crew.silver") and not tables.is_name("/data/silver") and not tables.is_name("silver")
    assert tables.write_overwrite(rows(spark, OLD[:2]), table.name) == 2
    assert tables.append_guarded(spark, rows(spark, OLD), table.name) == 2
    assert tables.append_plain(rows(spark, OLD[:1]), table.name) == 1
    assert tables.read_silver(spark, table.name).count() == 5


def test_rows_are_counted_by_the_write(spark, monkeypatch):
    """No count of its own, and the number is that of the rows written."""
    path = scratch_path(spark, "counted")
    many = rows(spark, [(str(i), D(1 + i % 28, 1), "2024-01", "HNL") for i in range(500)]).repartition(5)
    monkeypatch.setattr(type(many), "count", lambda self: pytest.fail("counted apart"))
    assert tables.write_overwrite(many, path) == 500
    assert tables.append_guarded(spark, many.unionByName(rows(spark, OLD)), path) == 4


def test_row_key_tells_rows_apart(spark):
    tricky = [("a", "b"), ("a,1:b", None), (None, None), ("-", "-"), ("", ""), (None, "")]
    df = spark.createDataFrame(tricky, "x string, y string").select(row_key(["x", "y"]).alias("k"))
    assert df.distinct().count() == len(tricky) and df.where("k IS NULL").count() == 0
