"""The running release rule (W6), the wrap-time rule (W8), and the shuffle of
the reconciliation (J4-J7, M11)."""

import datetime as dt

import pytest
from conftest import SF_CHECK, D, txn_rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from crewload import params as P
from crewload.plans import pilot, reconcile as rc
from crewload.plans.common import with_stamp
from crewload.sources import fixtures

CODES = ["RLV", "RSV", "SNO", "GDO", "ASN", "FLP", "DRP"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def released(codes):
    """The rule as written: a running flag and a lag."""
    seen, hit, before = False, False, False
    for c in codes:
        seen = seen or c == "RLV"
        hit = hit or (seen and before)
        before = c in ("SNO", "GDO", "OFF")
    return hit


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from(CODES), max_size=7), min_size=1, max_size=40))
def test_running_rule_matches_a_loop(spark, groups):
    items = [
        (c, D(1), None, None, f"2024-11-01 00:{i:02d}:00", {"CREW_ID": str(100 + g), "TXN_SEQ": 50 * g + i})
        for g, codes in enumerate(groups)
        for i, c in enumerate(codes)
    ]
    got = {r.CREW_ID: r.released for r in rc.running_releases(with_stamp(txn_rows(spark, items))).collect()} if items else {}
    assert got == {str(100 + g): released(c) for g, c in enumerate(groups) if "RLV" in c}


def test_running_rule_is_another_rule(spark):
    p = P.RunParams(run_date=dt.date(2024, 12, 10))
    day = lambda *codes: txn_rows(spark, [(c, D(5), D(5), None, f"2024-11-01 00:0{i}:00") for i, c in enumerate(codes)])
    n = lambda t, q: rc.reconcile(t, q).available.count()
    running = p.with_(running_release=True)
    assert (n(day("RLV", "SNO", "RLV"), p), n(day("RLV", "SNO", "RLV"), running)) == (1, 0)  # given back, then on again
    assert (n(day("RLV", "SNO"), p), n(day("RLV", "SNO"), running)) == (0, 1)  # a release that nothing follows
    assert (n(day("RSV"), p), n(day("RSV"), running)) == (1, 0)  # the variant knows RLV only


@pytest.fixture(scope="module")
def hot(spark):
    moved = F.col("TXN_SEQ") % 3 == 0
    t = fixtures.txn_times(spark, SF_CHECK)
    t = t.withColumn("CREW_ID", F.when(moved, F.lit("4242")).otherwise(F.col("CREW_ID")))
    t = t.withColumn("PAIRING_DATE", F.when(moved, F.lit("2024-03-11").cast("date")).otherwise(F.col("PAIRING_DATE")))
    t = t.withColumn("CREW_INDICATOR", F.when(moved, F.lit("FA")).otherwise(F.col("CREW_INDICATOR")))
    return t.withColumn("TO_TIME", F.when(moved & (F.col("TXN_SEQ") % 101 == 0), F.lit("09:00:00")).otherwise(F.col("TO_TIME"))).cache()


def test_running_rule_holds_no_group(spark, hot):
    rows = rc.explore_rows(hot)
    text = plan(rc.running_releases(rows))
    assert "Window" not in text and "SortAggregate" not in text and text.count("partial_max") >= 2
    codes = [r.TRANSACTION_CODE for r in rows.where("CREW_ID = '4242' AND PAIRING_DATE = DATE'2024-03-11'").orderBy("update_dt", "TXN_SEQ").collect()]
    assert len(codes) > 2000
    got = rc.running_releases(rows).where("CREW_ID = '4242' AND PAIRING_DATE = DATE'2024-03-11'").collect()
    assert [r.released for r in got] == [released(codes)]


def wrap(spark, items, **kw):
    """items: (code, from, to, pairing); all on one crew and day."""
    base = txn_rows(spark, [(c, D(10), D(10), no, f"2024-11-01 00:00:{i:02d}") for i, (c, _, _, no) in enumerate(items)], indicator="P")
    times = spark.createDataFrame([(i, f, t) for i, (_, f, t, _) in enumerate(items, 1)], "TXN_SEQ long, FROM_TIME string, TO_TIME string")
    p = P.RunParams(run_date=dt.date(2024, 12, 10))
    out = pilot.wrap_times(base.join(times, "TXN_SEQ"), p, **kw).collect()
    return sorted((r.TRANSACTION_CODE, r.FROM_TIME, r.TO_TIME) for r in out)


def test_longest_duty_over_midnight(spark):
    items = [("SCR", "08:00:00", "12:00:00", None), ("SCR", "22:00:00", "06:00:00", None), ("ARC", "01:00:00", "02:00:00", None)]
    assert wrap(spark, items) == [("SCR", "22:00:00", "06:00:00")]
    assert wrap(spark, items, over_midnight=False) == [("SCR", "08:00:00", "12:00:00")]


def test_ties_stay_then_the_first_of_each_code(spark):
    items = [
        ("SCR", "08:00:00", "12:00:00", None), ("SCR", "09:00:00", "13:00:00", None), ("ARC", "23:00:00", "03:00:00", None),
        ("ARC", "00:00:00", "23:00:00", "7"), ("ASN", "00:00:00", "23:00:00", None),
    ]
    assert wrap(spark, items) == [("ARC", "23:00:00", "03:00:00"), ("SCR", "08:00:00", "12:00:00")]


@pytest.mark.parametrize("bad", [None, "24:00:00", "7:00", ""])
def test_an_unknown_length_leaves_the_day_out(spark, bad):
    assert wrap(spark, [("SCR", "08:00:00", "12:00:00", None), ("ARC", "08:00:00", bad, None)]) == []


def test_wrap_times_limit_before_the_shuffle(spark, hot):
    out = pilot.wrap_times(hot)
    text = plan(out)
    assert text.count("WindowGroupLimit") >= 3  # partial top-1 first: a hot day sends one row per code and length
    assert out.groupBy("CREW_ID", "PAIRING_DATE", "TRANSACTION_CODE").count().where("count > 1").count() == 0


def test_reconciliation_shuffles_once_after_its_staged_tables(spark, hot):
    r = rc.reconcile(hot)
    text = plan(r.result)
    assert text.count("Exchange") == 1 and "Join" not in text
    assert plan(rc.day_claims(r.rows, r.flags)).count("Exchange") == 3
    widest = r.day_rows.groupBy("CREW_ID", "PAIRING_DATE").count().agg(F.max("count")).first()[0]
    assert widest < 40  # a third of the log on one crew and day, yet a handful of rows there


def test_day_flags_equal_the_joins(spark, hot):
    """The windows against the join operators (J4-J7) on the same steps."""
    r = rc.reconcile(hot)
    key = lambda df: sorted(map(str, df.select(*P.SILVER_COLUMNS).collect()))
    days = rc.assignment_days(r.paid, r.expanded)
    later = rc.carried(r.expanded, r.claims)
    assert key(r.days) == key(days)
    assert key(r.assigned) == key(rc.asn_with_reserve(days, r.available))
    assert key(r.unassigned) == key(rc.asn_without_reserve(days, r.available))
    assert key(r.carried) == key(later)
    assert key(r.reserve) == key(rc.reserve_minus_carried(r.available, later))
