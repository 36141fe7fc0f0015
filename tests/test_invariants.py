
from collections import Counter

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from crewload import params as P
from crewload.operators import expand
from crewload.plans import fa, reconcile as rc
from crewload.sources import fixtures


@pytest.fixture(scope="module")
def txn(spark):
    return fixtures.txn(spark, SF_SMALL)


def multiset(df):
    return Counter(tuple(r) for r in df.collect())


def test_semi_plus_anti_is_whole(spark, txn):
    r = rc.reconcile(txn)
    with_r = rc.asn_with_reserve(r.days, r.available)
    without = rc.asn_without_reserve(r.days, r.available)
    assert with_r.count() + without.count() == r.days.count()
    assert multiset(with_r.unionByName(without)) == multiset(r.days)


def test_reconciled_has_one_row_per_crew_day_and_code(spark, txn):
    res = rc.reconciled_days(txn)
    dup = res.groupBy("CREW_ID", "PAIRING_DATE", "TRANSACTION_CODE").count().where(F.col("count") > 1)
    assert dup.count() == 0


def test_expansion_count_equals_group_spans(spark, txn):
    p = P.DEFAULT
    asn = fa.fa_backfill_parts(fa.fa_scan(txn, p, True), p)[1]
    ends = expand.trip_ends(asn, fa.fa_day_keys(True), fa.fa_order())
    spans = ends.groupBy(*fa.fa_pad_keys(True)).agg((F.datediff(F.max("DATE"), F.min("DATE")) + 1).alias("n"))
    expected = spans.agg(F.sum("n")).first()[0]
    padded = expand.pad_days(ends, fa.fa_pad_keys(True))
    assert padded.count() == expected


def test_result_independent_of_input_partitioning(spark, txn):
    base = multiset(rc.reconciled_days(txn))
    for n in (1, 5, 13):
        shuffled = txn.repartition(n, F.rand(seed=n))
        assert multiset(rc.reconciled_days(shuffled)) == base


def test_fa_backfill_independent_of_input_partitioning(spark, txn):
    base = multiset(fa.fa_silver(txn, P.DEFAULT, True))
    assert multiset(fa.fa_silver(txn.repartition(7, F.rand(seed=3)), P.DEFAULT, True)) == base


def test_append_roundtrip_second_run_adds_nothing(spark, txn):
    from crewload.session import scratch_path
    from crewload.sinks import tables as sinks

    path = scratch_path(spark, "inv-append")
    sinks.write_overwrite(fa.fa_silver(txn, P.DEFAULT, True), path)
    batch = fa.fa_silver(txn, P.DEFAULT, False)
    first = sinks.append_guarded(spark, batch, path)
    assert first > 0
    assert sinks.append_guarded(spark, batch, path) == 0


def test_result_independent_of_session_time_zone(spark, txn):
    base = multiset(rc.reconciled_days(txn))
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("America/Los_Angeles", "Pacific/Honolulu", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            assert multiset(rc.reconciled_days(txn)) == base, tz
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
