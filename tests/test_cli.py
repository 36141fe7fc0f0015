"""The command line runs each job end to end on tables written as files."""

from collections import Counter

from conftest import D, SF_SMALL, txn_rows

from crewload import params as P
from crewload.__main__ import main
from crewload.session import scratch_path
from crewload.sinks.tables import read_silver
from crewload.sources import fixtures


def test_cli_jobs(spark):
    import __spark_entry__ as E

    hist, sched = scratch_path(spark, "cli-hist"), scratch_path(spark, "cli-sched")
    fixtures.txn(spark, SF_SMALL).write.parquet(hist)
    fixtures.sched(spark, SF_SMALL).write.parquet(sched)
    table, out = scratch_path(spark, "cli-table"), scratch_path(spark, "cli-report")
    common = ["--history", hist, "--run-date", "2024-03-15", "--last-bid-period", P.LAST_BID_PERIOD]
    main(["backfill-fa", *common, "--table", table])
    main(["backfill-pilot", *common, "--schedule", sched, "--table", table])
    fa_added = main(["append-fa", *common, "--table", table])["rows_added"]
    main(["append-pilot", *common, "--schedule", sched, "--table", table])
    assert main(["append-fa", *common, "--table", table])["rows_added"] == 0
    assert fa_added > 0
    got = Counter(tuple(r) for r in read_silver(spark, table).collect())
    want = Counter(tuple(r) for r in E.queries()["append_roundtrip"](spark, SF_SMALL).collect())
    assert got == want
    main(["explore", *common, "--out", out])
    rep = Counter(tuple(r) for r in spark.read.parquet(out).collect())
    assert rep == Counter(tuple(r) for r in E.queries()["utilization_hnl"](spark, SF_SMALL).collect())


def test_backfill_reads_every_later_period(spark):
    hist, table = scratch_path(spark, "late-hist"), scratch_path(spark, "late-table")
    day = D(10, 3, 2031)
    txn_rows(spark, [("RLV", day, day, 7, "2031-02-01 10:00:00", {"BID_PERIOD": "2031-03"})]).write.parquet(hist)
    main(["backfill-fa", "--history", hist, "--run-date", "2031-04-01", "--table", table])
    assert [(r.BID_PERIOD, r.PAIRING_DATE) for r in read_silver(spark, table).collect()] == [("2031-03", day)]
    main(["backfill-fa", "--history", hist, "--run-date", "2031-04-01", "--table", table, "--last-bid-period", "2031-02"])
    assert read_silver(spark, table).count() == 0
