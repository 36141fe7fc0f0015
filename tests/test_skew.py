"""A hot crew: a third of the log moved onto one crew id (and one day).

The log is derived from the driver's table, as in every other test. The
checks are that the plans pre-aggregate before the shuffle (partial
aggregates, partial window limits), that nothing becomes a nested-loop or
cartesian join, and that the result invariants still hold.
"""

import pytest
from conftest import SF_CHECK
from pyspark.sql import functions as F

from crewload import params as P
from crewload.plans import fa, reconcile as rc
from crewload.sources import fixtures


@pytest.fixture(scope="module")
def hot(spark):
    t = fixtures.txn(spark, SF_CHECK)
    moved = F.col("TXN_SEQ") % 3 == 0
    return t.withColumn("CREW_ID", F.when(moved, F.lit("4242")).otherwise(F.col("CREW_ID"))).withColumn(
        "PAIRING_DATE", F.when(moved, F.lit("2024-03-01").cast("date")).otherwise(F.col("PAIRING_DATE"))
    )


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_plans_combine_before_shuffle(spark, hot):
    flags = rc.day_flags(rc.explore_rows(hot))
    s = plan(flags)
    assert "partial_max" in s and "SortAggregate" not in s
    assert "WindowGroupLimit" in plan(rc.day_claims(rc.explore_rows(hot), flags))
    firsts = fa.fa_backfill_firsts(fa.fa_scan(hot, P.DEFAULT, True), P.DEFAULT)
    s2 = plan(firsts)
    assert "WindowGroupLimit" in s2 and "Partial" in s2


def test_hot_key_results_hold_invariants(spark, hot):
    r = rc.reconcile(hot)
    res = r.result
    dup = res.groupBy("CREW_ID", "PAIRING_DATE", "TRANSACTION_CODE").count().where(F.col("count") > 1)
    assert dup.count() == 0
    w = rc.asn_with_reserve(r.days, r.available).count()
    wo = rc.asn_without_reserve(r.days, r.available).count()
    assert w + wo == r.days.count()
    hot_days = r.flags.where(F.col("CREW_ID") == "4242").count()
    assert hot_days >= 1
    s = plan(res)
    assert "CartesianProduct" not in s and "NestedLoop" not in s
