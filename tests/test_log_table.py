"""The partitioned log: day catalogue, partition listing, optional sequence."""

import datetime as dt

import pytest
from conftest import SF_SMALL

from crewload import params as P
from crewload.plans import fa, pilot, reconcile as rc
from crewload.session import delete_path, scratch_path
from crewload.sources import fixtures, history
from crewload.sources.log_table import RANGES, LogTable, open_log, partition_values, write_log


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def same(a, b):
    cols = sorted(a.columns)
    key = lambda r: tuple(str(x) for x in r)
    return sorted(map(key, a.select(*cols).collect())) == sorted(map(key, b.select(*cols).collect()))


@pytest.fixture(scope="module")
def txn(spark):
    return fixtures.txn(spark, SF_SMALL).cache()


@pytest.fixture(scope="module")
def log(spark, txn):
    path = scratch_path(spark, "log")
    write_log(txn.where("TXN_SEQ % 2 = 0"), path)
    write_log(txn.where("TXN_SEQ % 2 = 1"), path)
    return open_log(spark, path)


def test_window_opens_only_the_periods_that_hold_it(log, txn):
    lo, hi = dt.date(2024, 3, 5), dt.date(2024, 3, 25)
    assert isinstance(log, LogTable) and log.periods_between(lo, hi) == ["2024-03"]
    scan = history.scan_window(log, lo, hi)
    text = plan(scan)
    assert "PartitionFilters" in text and "2024-03" in text.split("PartitionFilters")[1].split("]")[0]
    assert {f.split("BID_PERIOD=")[1][:7] for f in log.window(lo, hi).inputFiles()} >= {"2024-03"}
    assert same(scan, history.scan_window(txn, lo, hi))
    assert "PushedFilters: [IsNotNull(PAIRING_DATE)" in text


def test_late_rows_of_a_period_widen_its_range(spark, txn):
    path = scratch_path(spark, "log-late")
    write_log(txn, path)
    odd = txn.limit(1).selectExpr("* EXCEPT (PAIRING_DATE, BID_PERIOD)", "DATE'2025-12-31' AS PAIRING_DATE", "'2024-01' AS BID_PERIOD")
    write_log(odd, path)
    found = LogTable(spark, path)
    day = dt.date(2025, 12, 31)
    assert found.periods_between(day, day) == ["2024-01"] and history.scan_window(found, day, day).count() == 1


def test_periods_without_an_entry_are_opened(spark, txn):
    path = scratch_path(spark, "log-other")
    write_log(txn.where("BID_PERIOD <> '2024-02'"), path)
    txn.where("BID_PERIOD = '2024-02'").write.mode("append").partitionBy("BID_PERIOD").parquet(path)  # another writer
    log = LogTable(spark, path)
    assert "2024-02" in log.periods_between(dt.date(2030, 1, 1), dt.date(2030, 1, 2))
    for window in (P.DEFAULT.fa_window, P.DEFAULT.pilot_window):
        lo, hi = P.DEFAULT.bounds(window)
        assert same(history.scan_window(log, lo, hi), history.scan_window(txn, lo, hi))
    delete_path(spark, f"{path}/{RANGES}")
    assert log.periods_between(dt.date(2030, 1, 1), dt.date(2030, 1, 2)) == log.periods()


def test_null_and_odd_periods(spark, txn):
    path = scratch_path(spark, "log-null")
    odd = txn.selectExpr("* EXCEPT (BID_PERIOD)", "CASE TXN_SEQ % 3 WHEN 0 THEN NULL WHEN 1 THEN 'a/b c' ELSE '2024-01' END AS BID_PERIOD")
    write_log(odd, path)
    log = open_log(spark, path)
    assert sorted(log.periods(), key=str) == ["2024-01", None, "a/b c"] or set(log.periods()) == {None, "a/b c", "2024-01"}
    lo, hi = P.DEFAULT.bounds(P.DEFAULT.fa_window)
    assert same(history.scan_window(log, lo, hi), history.scan_window(odd, lo, hi))


def test_periods_are_listed_without_a_scan(spark, log, txn):
    listed = history.bid_periods(log, "2024-02", "2024-10")
    assert "FileScan" not in plan(listed)
    assert [r[0] for r in listed.collect()] == [r[0] for r in history.bid_periods(txn, "2024-02", "2024-10").collect()]
    assert "HashAggregate" in plan(history.bid_periods(txn, "2024-02", "2024-10"))  # no partitions: distinct


def test_a_table_that_is_not_partitioned_is_a_dataframe(spark, txn):
    path = scratch_path(spark, "flat")
    txn.write.parquet(path)
    assert partition_values(spark, path) is None and not isinstance(open_log(spark, path), LogTable)


def test_plans_take_the_log_table(spark, log, txn):
    sched = fixtures.sched(spark, SF_SMALL)
    assert same(fa.fa_silver(log, backfill=False), fa.fa_silver(txn, backfill=False))
    assert same(pilot.pilot_silver(log, sched), pilot.pilot_silver(txn, sched))
    assert same(rc.reconciled_days(log), rc.reconciled_days(txn))


def test_tables_without_sequences(spark, txn):
    """The source's own tables have none; the choice is then the same however
    the table is read, and where no rows tie it is the usual one."""
    plain = txn.drop("TXN_SEQ")
    sched = fixtures.sched(spark, SF_SMALL)
    bare = sched.drop("SCHED_SEQ")
    for run in (
        lambda t, s: fa.fa_silver(t, backfill=True),
        lambda t, s: fa.fa_silver(t, backfill=False),
        lambda t, s: pilot.pilot_silver(t, s, backfill=False),
        lambda t, s: rc.reconciled_days(t),
        lambda t, s: pilot.latest_schedule(s),
    ):
        a = run(plain, bare)
        assert same(a, run(plain.repartition(7, "BASE").select(*reversed(plain.columns)), bare.repartition(5)))
        assert a.count() == run(txn, sched).count()


def test_a_malformed_stamp_counts_as_missing_everywhere(spark, txn):
    odd = txn.selectExpr("* EXCEPT (UPDATE_TIME)", "CASE WHEN TXN_SEQ % 2 = 0 THEN '9:00' ELSE UPDATE_TIME END AS UPDATE_TIME")
    none = txn.selectExpr("* EXCEPT (UPDATE_TIME)", "CASE WHEN TXN_SEQ % 2 = 1 THEN UPDATE_TIME END AS UPDATE_TIME")
    assert same(fa.fa_silver(odd, backfill=True), fa.fa_silver(none, backfill=True))
    assert same(rc.reconciled_days(odd), rc.reconciled_days(none))
