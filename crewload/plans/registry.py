"""Named queries over the driver's tables: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import params as P
from ..functions.dates import backfill_cutoff, incremental_cutoff, update_stamp
from ..functions.predicates import not_equal_drop_null, not_in_keep_null
from ..operators import dedup, expand, groups, joins, ordered, reshape
from ..schema import SILVER
from ..sinks import tables as sinks
from ..sinks.catalog import SilverTable
from ..session import scratch_path, stage
from ..sources import fixtures, history
from ..sources.log_table import LogTable, write_log
from . import fa, pilot, reconcile as rc, utilization
from .common import STAMP, silver, with_stamp

Query = Callable[[SparkSession, str], DataFrame]


class Tables:
    """The two crew tables of one scale factor (built on first use)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def txn(self) -> DataFrame:
        return fixtures.txn(self.spark, self.sf_dir)

    @cached_property
    def sched(self) -> DataFrame:
        return fixtures.sched(self.spark, self.sf_dir)


#: Named silver tables already written, by Spark application and input folder.
_TARGETS: dict[tuple[str, str], SilverTable] = {}


def named_table(t: Tables, name: str) -> SilverTable:
    """An empty silver table in a database of its own, in the shared folder."""
    db = scratch_path(t.spark, "db").rsplit("-", 1)[-1]
    buckets = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    return SilverTable(t.spark, f"crew_{db}.{name}", buckets, scratch_path(t.spark, f"db-{db}"))


def backfilled_table(t: Tables, p: P.RunParams) -> SilverTable:
    """The table as both backfills leave it, written once per application
    and input: what an incremental run finds."""
    key = (t.spark.sparkContext.applicationId, t.sf_dir)
    if key not in _TARGETS:
        table = named_table(t, "reserve_utilization")
        table.overwrite(fa.fa_silver(t.txn, p, True))
        table.append(pilot.pilot_silver(t.txn, t.sched, p, True), guarded=False)
        _TARGETS[key] = table
    return _TARGETS[key]


def log_table(t: Tables) -> LogTable:
    """The log as the production table: partitioned, with its day catalogue."""
    path = scratch_path(t.spark, "log")
    write_log(t.txn, path)
    return LogTable(t.spark, path)


def build(params: P.RunParams = P.DEFAULT) -> dict[str, Query]:
    p = params
    q: dict[str, Query] = {}

    def reg(name):
        def deco(fn):
            q[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
            return fn

        return deco

    @reg("fa_backfill")
    def _(t):
        return fa.fa_silver(t.txn, p, backfill=True)

    @reg("fa_incremental")
    def _(t):
        return fa.fa_silver(t.txn, p, backfill=False)

    @reg("utilization_fa")
    def _(t):
        return utilization.utilization_fa(fa.fa_silver(t.txn, p, backfill=True))

    @reg("schedule_latest")
    def _(t):
        return pilot.latest_schedule(t.sched, p, backfill=False)

    @reg("pilot_backfill")
    def _(t):
        return pilot.pilot_silver(t.txn, t.sched, p, backfill=True)

    @reg("pilot_incremental")
    def _(t):
        return pilot.pilot_silver(t.txn, t.sched, p, backfill=False)

    @reg("utilization_pilot")
    def _(t):
        return utilization.utilization_pilot(pilot.pilot_silver(t.txn, t.sched, p, backfill=True), p)

    def recon(t):
        return rc.reconcile(t.txn, p)

    @reg("available_reserve")
    def _(t):
        return silver(recon(t).available)

    @reg("paid_assignments")
    def _(t):
        return recon(t).paid.drop("TXN_SEQ")

    @reg("released_after_reserve")
    def _(t):
        return rc.released_after_reserve(recon(t).flags)

    @reg("overlap_days")
    def _(t):
        return rc.overlap_days(recon(t).flags)

    @reg("released_after_asn")
    def _(t):
        return rc.released_after_asn(recon(t).flags)

    @reg("last_position")
    def _(t):
        return rc.reserve_position(recon(t).rows)

    @reg("asn_without_reserve")
    def _(t):
        return recon(t).unassigned

    @reg("asn_with_reserve")
    def _(t):
        return recon(t).assigned

    @reg("carried_days")
    def _(t):
        return silver(recon(t).carried)

    @reg("reserve_minus_carried")
    def _(t):
        return silver(recon(t).reserve)

    @reg("reconciled_days")
    def _(t):
        return recon(t).result

    @reg("utilization_hnl")
    def _(t):
        return rc.utilization_hnl(t.txn, p)

    # --- evident-intent options (C items) -----------------------------------

    @reg("fa_incremental_asn_rows_only")
    def _(t):
        return fa.fa_silver(t.txn, p.with_(asn_rows_only=True), backfill=False)

    @reg("pilot_backfill_arc_folded")
    def _(t):
        return pilot.pilot_silver(t.txn, t.sched, p.with_(fold_arc_in_backfill=True), backfill=True)

    @reg("pilot_incremental_cutoff")
    def _(t):
        return pilot.pilot_silver(t.txn, t.sched, p.with_(pilot_cutoff_day=21), backfill=False)

    @reg("available_reserve_running")
    def _(t):
        return silver(rc.reconcile(t.txn, p.with_(running_release=True)).available)

    @reg("running_releases")
    def _(t):
        return rc.running_releases(recon(t).rows)

    @reg("wrap_times")
    def _(t):
        return pilot.wrap_times(fixtures.txn_times(t.spark, t.sf_dir), p)

    literal = p.with_(literal_fill=True)

    @reg("fa_backfill_literal_fill")
    def _(t):
        return fa.fa_silver(t.txn, literal, backfill=True)

    @reg("fa_incremental_literal_fill")
    def _(t):
        return fa.fa_silver(t.txn, literal, backfill=False)

    @reg("pilot_backfill_literal_fill")
    def _(t):
        return pilot.pilot_silver(t.txn, t.sched, literal, backfill=True)

    @reg("carried_days_literal_fill")
    def _(t):
        return silver(rc.reconcile(t.txn, literal).carried)

    @reg("reconciled_days_literal_fill")
    def _(t):
        return rc.reconcile(t.txn, literal).result

    # --- sources and parameters -------------------------------------------

    @reg("scan_window_by_catalogue")
    def _(t):
        return history.scan_window(log_table(t), *p.bounds(p.pilot_window))

    @reg("bid_periods_by_partition")
    def _(t):
        return history.bid_periods(log_table(t), p.first_bid_period, p.last_bid_period)

    @reg("scan_window")
    def _(t):
        return history.scan_window(t.txn, *p.bounds(p.fa_window))

    @reg("scan_bid_period")
    def _(t):
        return history.scan_bid_periods(t.txn, p.first_bid_period, p.last_bid_period)

    @reg("bid_periods")
    def _(t):
        return history.bid_periods(t.txn, p.first_bid_period, p.last_bid_period)

    @reg("schedule_scan")
    def _(t):
        return history.schedule_scan(t.sched, *p.pilot_bid_range)

    @reg("cutoff_incremental")
    def _(t):
        runs = t.txn.select(F.col("PAIRING_DATE").alias("run_date")).distinct()
        return runs.withColumn(
            "cutoff", incremental_cutoff(F.col("run_date"), p.cutoff_lead_days, p.incremental_cutoff_day)
        )

    @reg("cutoff_backfill")
    def _(t):
        return t.txn.select("BID_PERIOD").distinct().withColumn("cutoff", backfill_cutoff("BID_PERIOD", p.backfill_cutoff_day))

    # --- filters -------------------------------------------------------------

    @reg("not_placeholder_crew")
    def _(t):
        return t.txn.where(not_in_keep_null("CREW_ID", P.PLACEHOLDER_CREW_IDS))

    @reg("equipment_exclusion")
    def _(t):
        return t.sched.where(not_equal_drop_null("EQUIPMENT", P.EXCLUDED_EQUIPMENT))

    @reg("group_any")
    def _(t):
        rows = with_stamp(history.scan_window(t.txn, *p.bounds(p.fa_window)).where(F.col("CREW_INDICATOR") == P.FA))
        return groups.group_any(rows, ["CREW_ID", "PAIRING_DATE"], F.col("TRANSACTION_CODE") == P.ASSIGNMENT_CODE)

    @reg("group_reject")
    def _(t):
        rows = rc.explore_rows(t.txn, p)
        return groups.group_reject(rows, ["CREW_ID", "PAIRING_DATE"], F.col("TRANSACTION_CODE").isin(*P.RELEASE_CODES))

    @reg("latest_ties")
    def _(t):
        s = pilot.schedule_versions(t.sched, p, backfill=False).withColumn(STAMP, update_stamp())
        return dedup.latest_with_ties(s, pilot.VERSION_KEYS, STAMP)

    @reg("equipment_date_rule")
    def _(t):
        return pilot.pilot_silver(t.txn, t.sched, p.with_(flag_date_intent=True), backfill=True)

    # --- joins ---------------------------------------------------------------

    def pilot_firsts(t, backfill):
        scan = pilot.pilot_scan(t.txn, p, backfill)
        return pilot.pilot_firsts(scan, pilot.latest_schedule(t.sched, p, backfill), backfill, p)

    @reg("schedule_inner")
    def _(t):
        return silver(pilot.pilot_reserve(pilot_firsts(t, False)))

    @reg("schedule_left")
    def _(t):
        return silver(pilot.pilot_reserve(pilot_firsts(t, True)))

    @reg("append_guard")
    def _(t):
        return joins.append_guard(fa.fa_silver(t.txn, p, False), fa.fa_silver(t.txn, p, True))

    # --- dedup, counts, reshape ----------------------------------------------

    @reg("first_per_key")
    def _(t):
        return silver(fa.fa_incremental_parts(fa.fa_scan(t.txn, p, False), p)[0])

    @reg("group_ids")
    def _(t):
        rows = fa.fa_scan(t.txn, p, False).where((F.col("CREW_INDICATOR") == P.FA) & F.col("TRANSACTION_CODE").isin(*P.FA_RESERVE_CODES))
        keys = ["CREW_ID", "PAIRING_DATE", "TRANSACTION_CODE"]
        return ordered.dense_ids(rows.select("TXN_SEQ", *keys), keys)

    @reg("distinct_crew_day")
    def _(t):
        rows = history.scan_window(t.txn, *p.bounds(p.explore_window)).where(F.col("CREW_INDICATOR") == P.FA)
        crews = groups.group_any(rows, ["CREW_ID"], F.col("TRANSACTION_CODE").isin(*P.FA_RESERVE_CODES))
        days = dedup.distinct_rows(crews.select("CREW_ID", "PAIRING_DATE"))
        return days.where(not_in_keep_null("CREW_ID", P.PLACEHOLDER_CREW_IDS))

    @reg("daily_counts")
    def _(t):
        from ..functions.predicates import fold_code

        rows = recon(t).result.withColumn("TRANSACTION_CODE", fold_code("TRANSACTION_CODE", *P.FOLDED_FA_CODE))
        return reshape.daily_counts(rows, ["PAIRING_DATE", "TRANSACTION_CODE", "BASE"])

    @reg("unpivot_dates")
    def _(t):
        return expand.unpivot_dates(expand.multi_day(recon(t).paid.drop("TXN_SEQ")))

    @reg("pivot_codes")
    def _(t):
        return reshape.pivot_codes(fa.fa_silver(t.txn, p, True), ["PAIRING_DATE", "BASE"], ["RLV", P.ASSIGNMENT_CODE])

    # --- expansion, fill, union, alignment -----------------------------------

    def fa_bf_asn(t):
        return fa.fa_backfill_parts(fa.fa_scan(t.txn, p, True), p)[1]

    @reg("expand_single")
    def _(t):
        return silver(fa.fa_single(fa_bf_asn(t), True))

    @reg("expand_multi")
    def _(t):
        return silver(fa.fa_multi(fa_bf_asn(t), True))

    @reg("pad_days")
    def _(t):
        ends = expand.trip_ends(fa_bf_asn(t), fa.fa_day_keys(True), fa.fa_order())
        padded = expand.pad_days(ends, fa.fa_pad_keys(True))
        return padded.select(
            "BID_PERIOD", "CREW_ID", "BASE", "PAIRING_NO", "DATE", "name", "CREW_INDICATOR", "TRANSACTION_CODE", "PAIRING_POSITION"
        )

    @reg("fill_down")
    def _(t):
        return silver(pilot.pilot_multi(pilot.pilot_assignments(pilot_firsts(t, True)), True))

    @reg("union_silver")
    def _(t):
        return reshape.union_by_name(fa.fa_silver(t.txn, p, True), pilot.pilot_silver(t.txn, t.sched, p, True))

    @reg("align_columns")
    def _(t):
        return joins.align_columns(recon(t).paid, t.spark.createDataFrame([], SILVER))[0]

    # --- table lifecycle -------------------------------------------------------

    @reg("append_batch")
    def _(t):
        table = backfilled_table(t, p)
        batch = stage(pilot.pilot_silver(t.txn, t.sched, p, False), "batch")
        periods = [r[0] for r in batch.select("BID_PERIOD").distinct().collect()]
        return silver(table.new_rows(batch, periods))

    @reg("named_table_roundtrip")
    def _(t):
        table = named_table(t, "silver")
        table.overwrite(reshape.union_by_name(fa.fa_silver(t.txn, p, True), pilot.pilot_silver(t.txn, t.sched, p, True)))
        table.overwrite(fa.fa_silver(t.txn, p, True))
        table.append(fa.fa_silver(t.txn, p, False))
        return table.read()

    @reg("rows_added")
    def _(t):
        table, fa_inc = named_table(t, "counted"), fa.fa_silver(t.txn, p, False)
        runs = [
            ("1 backfill", table.overwrite(fa.fa_silver(t.txn, p, True))),
            ("2 append", table.append(fa_inc)),
            ("3 append again", table.append(fa_inc)),
        ]
        return t.spark.createDataFrame(runs, "run string, rows long")

    @reg("table_periods")
    def _(t):
        found = [(x,) for x in backfilled_table(t, p).periods()]
        return t.spark.createDataFrame(found, "BID_PERIOD string")

    @reg("overwrite_roundtrip")
    def _(t):
        path = scratch_path(t.spark, "silver-overwrite")
        sinks.write_overwrite(fa.fa_silver(t.txn, p, True), path)
        return sinks.read_silver(t.spark, path)

    @reg("append_roundtrip")
    def _(t):
        path = scratch_path(t.spark, "silver-append")
        sinks.write_overwrite(fa.fa_silver(t.txn, p, True), path)
        sinks.append_plain(pilot.pilot_silver(t.txn, t.sched, p, True), path)
        sinks.append_guarded(t.spark, fa.fa_silver(t.txn, p, False), path)
        sinks.append_guarded(t.spark, pilot.pilot_silver(t.txn, t.sched, p, False), path)
        return sinks.read_silver(t.spark, path)

    return q
