"""Command line: one command per job of the source's five programs.

    python -m crewload backfill     --history H --schedule S --table T [--run-date D]
    python -m crewload backfill-fa  --history H --table T
    python -m crewload backfill-pilot --history H --schedule S --table T
    python -m crewload append-fa    --history H --table T
    python -m crewload append-pilot --history H --schedule S --table T
    python -m crewload explore      --history H --out O [--base HNL]
    python -m crewload wrap-times   --history H --out O
    python -m crewload load-log     --history NEW --table LOG

Sources are any format Spark reads (``--format``, default parquet). A log
that ``load-log`` keeps (Parquet by bid period, with its day catalogue) is
opened period by period. ``--table`` is a folder or a name
(``database.table``). The session is the cluster's (``spark-submit``) or a local one. A backfill reads
every bid period of the log from ``--first-bid-period`` on, unless
``--last-bid-period`` ends it.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from . import params as P
from .plans import fa, pilot, reconcile
from .plans.utilization import utilization_live
from .session import SQL_DEFAULTS, build_session, staging_scope
from .sinks.tables import append_guarded, append_plain, write_overwrite
from .sources.history import log_rows, read_table
from .sources.log_table import open_log, write_log
from .streaming.rolling import run_backfill


def main(argv=None) -> dict:
    ap = argparse.ArgumentParser(prog="crewload")
    ap.add_argument("command", choices=["backfill", "backfill-fa", "backfill-pilot", "append-fa", "append-pilot", "explore", "wrap-times", "load-log"])
    ap.add_argument("--history", required=True)
    ap.add_argument("--schedule")
    ap.add_argument("--table")
    ap.add_argument("--out")
    ap.add_argument("--format", default="parquet")
    ap.add_argument("--run-date", default=dt.date.today().isoformat())
    ap.add_argument("--base", default=P.REPORT_BASE)
    ap.add_argument("--first-bid-period", default=P.FIRST_BID_PERIOD)
    ap.add_argument("--last-bid-period", default=P.NO_LAST_BID_PERIOD)
    ap.add_argument("--asn-rows-only", action="store_true", help="FA increments take the ASN rows of a day, not the whole day")
    ap.add_argument("--fold-arc-in-backfill", action="store_true", help="the pilot backfill stores ARC as SCR")
    ap.add_argument("--flag-date-intent", action="store_true", help="the equipment date rule ends with April 2024")
    ap.add_argument("--running-release", action="store_true", help="explore: a release counts by the running rule")
    ap.add_argument("--literal-fill", action="store_true", help="missing values of padded days come from the row above, whatever its trip")
    ap.add_argument("--pilot-cutoff-day", type=int, help="reserve cutoff day of pilot increments")
    ap.add_argument("--master", default=None, help="local master for runs outside a cluster")
    a = ap.parse_args(argv)

    from pyspark.sql import SparkSession

    spark = build_session(master=a.master) if a.master else SparkSession.builder.getOrCreate()
    for key, value in SQL_DEFAULTS.items():  # a cluster's session does not have them
        spark.conf.set(key, value)
    p = P.RunParams(
        run_date=dt.date.fromisoformat(a.run_date),
        first_bid_period=a.first_bid_period,
        last_bid_period=a.last_bid_period,
        asn_rows_only=a.asn_rows_only,
        fold_arc_in_backfill=a.fold_arc_in_backfill,
        flag_date_intent=a.flag_date_intent,
        running_release=a.running_release,
        literal_fill=a.literal_fill,
        pilot_cutoff_day=a.pilot_cutoff_day,
    )
    hist = open_log(spark, a.history, a.format)
    sched = read_table(spark, a.schedule, a.format) if a.schedule else None
    result: dict = {"command": a.command, "run_date": a.run_date}
    with staging_scope(spark):
        if a.command == "backfill":
            run_backfill(hist, sched, a.table, p)
        elif a.command == "backfill-fa":
            result["rows_written"] = write_overwrite(fa.fa_silver(hist, p, backfill=True), a.table)
        elif a.command == "backfill-pilot":
            result["rows_added"] = append_plain(pilot.pilot_silver(hist, sched, p, backfill=True), a.table)
        elif a.command == "append-fa":
            result["rows_added"] = append_guarded(spark, fa.fa_silver(hist, p, backfill=False), a.table)
        elif a.command == "append-pilot":
            result["rows_added"] = append_guarded(spark, pilot.pilot_silver(hist, sched, p, backfill=False), a.table)
        elif a.command == "explore":
            report = utilization_live(reconcile.reconciled_days(hist, p), a.base)
            report.write.mode("overwrite").parquet(a.out)
        elif a.command == "wrap-times":
            pilot.wrap_times(hist, p).write.mode("overwrite").parquet(a.out)
        elif a.command == "load-log":
            write_log(log_rows(hist), a.table)
    print(json.dumps(result))
    return result


if __name__ == "__main__":
    main()
