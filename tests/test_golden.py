"""Golden scenarios T1-T7 (FIXTURES.md §3): small literal logs."""

import datetime as dt

from conftest import D, days, txn_rows
from pyspark.sql import functions as F

from crewload import params as P
from crewload.plans import fa, reconcile as rc
from crewload.plans.utilization import utilization_live
from crewload.sinks import tables as sinks
from crewload.session import scratch_path

RUN = P.RunParams(run_date=dt.date(2024, 12, 20))


def st(i):
    return f"2024-11-01 08:00:{i:02d}"


def rec(spark, rows):
    return rc.reconcile(txn_rows(spark, rows), RUN)


def test_t1_overlap_keeps_second_reserve_day(spark):
    rows = [
        ("RLV", D(16), D(16), None, st(1)),
        ("ASN", D(16), D(19), "A", st(2)),
        ("FLP", D(16), D(16), None, st(3)),
        ("RLV", D(17), D(17), None, st(4)),
        ("ASN", D(17), D(17), "B", st(5)),
        ("FLP", D(17), D(17), None, st(6)),
    ]
    r = rec(spark, rows)
    assert days(rc.overlap_days(r.flags)) == [16, 17]
    assert days(r.carried) == [18, 19]
    assert days(r.reserve) == [16, 17]


def test_t2_assignment_days_without_reserve_dropped(spark):
    rows = [
        ("RLV", D(10), D(10), None, st(1)),
        ("RLV", D(11), D(11), None, st(2)),
        ("RLV", D(12), D(12), None, st(3)),
        ("ASN", D(12), D(14), "A", st(4)),
    ]
    r = rec(spark, rows)
    assert days(r.assigned) == [12]
    assert days(r.carried) == [13, 14]
    assert days(r.reserve) == [10, 11, 12]


def test_t3_carried_reserve_removed_and_percent(spark):
    rows = [
        ("RLV", D(12), D(12), None, st(1)),
        ("RLV", D(13), D(13), None, st(2)),
        ("RLV", D(14), D(14), None, st(3)),
        ("ASN", D(12), D(14), "A", st(4)),
    ]
    r = rec(spark, rows)
    assert days(r.reserve) == [12]
    assert days(r.assigned) == [12, 13, 14]
    rep = {x["PAIRING_DATE"].day: x for x in utilization_live(r.result).collect()}
    assert rep[12]["perc_utl"] == 100.0 and rep[12]["RLV"] == 1 and rep[12]["ASN"] == 1
    assert rep[13]["perc_utl"] is None and rep[13]["RLV"] == 0
    assert rep[14]["perc_utl"] is None


def test_t4_backfill_cutoff_is_strict(spark):
    rows = [
        ("RLV", D(5), D(5), None, "2024-11-24 00:00:00"),
        ("RLV", D(6), D(6), None, "2024-11-23 23:59:59"),
    ]
    out = fa.fa_silver(txn_rows(spark, rows), RUN.with_(last_bid_period="2024-12"), backfill=True)
    assert days(out) == [6]


def test_t5_drop_after_reserve_rejects_day(spark):
    rows = [("RLV", D(20), D(20), None, st(1)), ("DRP", D(20), D(20), None, st(2))]
    r = rec(spark, rows)
    assert r.available.count() == 0
    assert days(rc.released_after_reserve(r.flags)) == [20]


def test_t5b_drop_before_reserve_keeps_day(spark):
    rows = [("DRP", D(20), D(20), None, st(1)), ("RLV", D(20), D(20), None, st(2))]
    assert days(rec(spark, rows).available) == [20]


def test_t6_assignment_release_codes(spark):
    kept = rec(spark, [("ASN", D(21), D(21), "C", st(1)), ("DRP", D(21), D(21), None, st(2))])
    assert days(kept.paid) == [21]
    gone = rec(spark, [("ASN", D(21), D(21), "C", st(1)), ("SNO", D(21), D(21), None, st(2))])
    assert gone.paid.count() == 0


def test_t7_append_twice_adds_nothing_second_time(spark):
    rows = [
        ("RLV", D(3, 3), D(3, 3), None, "2024-01-10 08:00:00", {"BASE": None}),
        ("RLV", D(4, 3), D(4, 3), None, "2024-01-10 08:00:01"),
    ]
    batch = fa.fa_silver(txn_rows(spark, rows), P.DEFAULT, backfill=False)
    assert batch.where(F.col("BASE").isNull()).count() == 1
    path = scratch_path(spark, "t7")
    sinks.write_overwrite(batch.limit(0), path)
    assert sinks.append_guarded(spark, batch, path) == 2
    assert sinks.append_guarded(spark, batch, path) == 0
    assert sinks.read_silver(spark, path).count() == 2
