"""Pilot silver rows: latest schedule (M12), backfill (M6), incremental (M7).

Pilot days are joined to the latest schedule version on crew, bid period,
seat and base (NULL matching NULL) to learn the equipment. The schedule is a
dimension (one row per crew, version and seat), far smaller than the log:
its latest versions are broadcast only when the versions read measure small
enough (one aggregate); otherwise the join is a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import params as P
from ..functions.dates import incremental_cutoff, seconds_of_day, update_stamp
from ..functions.predicates import flag_rule_keep, fold_code, if_else, not_equal_drop_null
from ..operators.dedup import first_per_key, latest_per_key
from ..operators.expand import DATE, expand_multi, expand_single, fill_literal
from ..operators.joins import broadcast_if_small, join_null_safe
from ..operators.reshape import union_by_name
from ..sources.history import Log, scan_bid_periods, scan_window, schedule_scan
from .common import FILL_COLS, SEQ, STAMP, first_order, keyed, silver, stage, with_sequence, with_stamp

JOIN_KEYS = ["CREW_ID", "BID_PERIOD", "PAIRING_POSITION", "BASE"]
SCHED_OUT = ["CREW_ID", "BID_PERIOD", "PAIRING_POSITION", "EQUIPMENT", "BASE"]
VERSION_KEYS = ["CREW_ID", "EFFECTIVE_FROM_DATE", "EFFECTIVE_TO_DATE", "PAIRING_POSITION"]


def schedule_versions(schedule: DataFrame, params: P.RunParams, backfill: bool) -> DataFrame:
    """S4 for either run: the incremental run reads run month .. month of
    run+30; the backfill every bid period of its range."""
    if backfill:
        return schedule_scan(schedule, params.first_bid_period, params.last_bid_period)
    lo, hi = params.pilot_bid_range
    return schedule_scan(schedule, lo, hi)


def latest_schedule(schedule: DataFrame, params: P.RunParams = P.DEFAULT, backfill: bool = False) -> DataFrame:
    """Latest version per crew, effective range and seat (per bid date
    in the backfill), highest SCHED_SEQ among equal stamps (a hash of the row
    where the schedule has no such column)."""
    s = with_sequence(schedule_versions(schedule, params, backfill), "SCHED_SEQ").withColumn(STAMP, update_stamp())
    keys = (["BID_DATE"] if backfill else []) + VERSION_KEYS
    s = latest_per_key(s, keys, STAMP, "SCHED_SEQ")
    return s.select("CREW_ID", F.col("BID_DATE").alias("BID_PERIOD"), "PAIRING_POSITION", "EQUIPMENT", "BASE")


def pilot_scan(history: Log, params: P.RunParams, backfill: bool) -> DataFrame:
    if backfill:
        return scan_bid_periods(history, params.first_bid_period, params.last_bid_period)
    lo, hi = params.bounds(params.pilot_window)
    return scan_window(history, lo, hi)


def _pilot_rows(scan: DataFrame, codes, backfill: bool) -> DataFrame:
    rows = with_stamp(scan.where((F.col("CREW_INDICATOR") == P.PILOT) & F.col("TRANSACTION_CODE").isin(*codes)))
    return first_per_key(rows, keyed(["CREW_ID", "PAIRING_DATE", "TRANSACTION_CODE"], backfill), first_order())


def pilot_day_keys(backfill: bool):
    return keyed(["CREW_ID", "EQUIPMENT", "TRANSACTION_CODE", DATE], backfill)


def pilot_pad_keys(backfill: bool):
    return keyed(["CREW_ID", "TRANSACTION_CODE", "EQUIPMENT", "PAIRING_NO"], backfill)


def pilot_single(asn: DataFrame, backfill: bool) -> DataFrame:
    return expand_single(asn, pilot_day_keys(backfill), first_order())


def pilot_multi(asn: DataFrame, backfill: bool, params: P.RunParams = P.DEFAULT) -> DataFrame:
    keys, pads = pilot_day_keys(backfill), pilot_pad_keys(backfill)
    if params.literal_fill:
        padded = expand_multi(asn, keys, pads, first_order(), ())
        out = fill_literal(padded, pads, first_order(), FILL_COLS, ["BID_PERIOD"] if backfill else [])
    else:
        out = expand_multi(asn, keys, pads, first_order(), FILL_COLS)
    return out.withColumnRenamed(DATE, "PAIRING_DATE")


def pilot_firsts(
    scan: DataFrame, sched_latest: DataFrame, backfill: bool, params: P.RunParams = P.DEFAULT
) -> DataFrame:
    """Reserve and ASN rows share the dedup key, so one window pass over one
    scan finds both, and one join gives them their equipment. The join is a
    left join with a match marker: reserve rows keep unmatched days in the
    backfill (left join), ASN rows never do (inner join). With
    ``pilot_cutoff_day`` set, incremental reserve rows must be stamped before
    that cutoff (P5), as FA reserve rows are."""
    codes = P.PILOT_RESERVE_CODES + (P.ASSIGNMENT_CODE,)
    rows = scan
    if params.pilot_cutoff_day is not None and not backfill:
        cutoff = incremental_cutoff(F.lit(params.run_date), params.cutoff_lead_days, params.pilot_cutoff_day)
        rows = with_stamp(rows).where((F.col("TRANSACTION_CODE") == P.ASSIGNMENT_CODE) | (F.col(STAMP) < cutoff))
    rows = _pilot_rows(rows, codes, backfill).select(
        "CREW_INDICATOR",
        "CREW_ID",
        "TRANSACTION_CODE",
        "PAIRING_NO",
        "PAIRING_DATE",
        "TO_DATE",
        "PAIRING_POSITION",
        "BID_PERIOD",
        "BASE",
        STAMP,
        SEQ,
    )
    rows = rows.where(F.col("PAIRING_POSITION").isin(*P.PILOT_SEATS))
    marked = sched_latest.withColumn("__matched", F.lit(True))
    joined = join_null_safe(rows, marked, JOIN_KEYS, "left" if backfill else "inner")
    return joined.withColumn("__matched", F.coalesce(F.col("__matched"), F.lit(False)))


def pilot_reserve(firsts: DataFrame) -> DataFrame:
    """Reserve days with their equipment, captains and first officers only."""
    return firsts.where(F.col("TRANSACTION_CODE").isin(*P.PILOT_RESERVE_CODES))


def pilot_assignments(firsts: DataFrame) -> DataFrame:
    """ASN rows whose schedule is known."""
    return firsts.where((F.col("TRANSACTION_CODE") == P.ASSIGNMENT_CODE) & F.col("__matched"))


def pilot_silver(history: Log, schedule: DataFrame, params: P.RunParams = P.DEFAULT, backfill: bool = True) -> DataFrame:
    """M6 (backfill) / M7 (incremental)."""
    scan = pilot_scan(history, params, backfill)
    # The schedule is a dimension: broadcast its latest versions when the
    # versions read (a superset, same columns) measure small enough.
    versions = schedule_versions(schedule, params, backfill).select(
        "CREW_ID", F.col("BID_DATE").alias("BID_PERIOD"), "PAIRING_POSITION", "EQUIPMENT", "BASE"
    )
    latest = broadcast_if_small(latest_schedule(schedule, params, backfill), bound_from=versions)
    firsts = stage(pilot_firsts(scan, latest, backfill, params), "pilot-firsts")
    reserve, asn = pilot_reserve(firsts), pilot_assignments(firsts)
    out = union_by_name(silver(reserve), silver(pilot_single(asn, backfill)), silver(pilot_multi(asn, backfill, params)))
    if backfill:
        frm = P.FOLDED_PILOT_CODE[0] if params.fold_arc_in_backfill else P.BACKFILL_TYPO_CODE
        out = out.where(F.col("PAIRING_DATE") <= F.lit(params.run_date))
        out = out.withColumn("TRANSACTION_CODE", fold_code("TRANSACTION_CODE", frm, P.FOLDED_PILOT_CODE[1]))
        out = out.where(not_equal_drop_null("EQUIPMENT", P.EXCLUDED_EQUIPMENT))
        out = out.where(flag_rule_keep("PAIRING_DATE", "EQUIPMENT", params.flag_date, P.FLAGGED_EQUIPMENT))
    else:
        out = out.withColumn(
            "BASE", if_else(F.col("EQUIPMENT") == P.OVERRIDE_EQUIPMENT, F.lit(P.OVERRIDE_BASE), F.col("BASE"))
        )
        out = out.where(F.col("PAIRING_DATE") <= F.lit(params.incremental_cap))
        out = out.withColumn("TRANSACTION_CODE", fold_code("TRANSACTION_CODE", *P.FOLDED_PILOT_CODE))
        out = out.where(not_equal_drop_null("EQUIPMENT", P.EXCLUDED_EQUIPMENT))
    return silver(out)


WRAP_COLS = ["CREW_ID", "PAIRING_DATE", "FROM_TIME", "TO_TIME"]


def wrap_times(history: Log, params: P.RunParams = P.DEFAULT, over_midnight: bool = True) -> DataFrame:
    """The longest duty of each crew and day among reserve rows without a
    pairing: ties of the maximum kept, then the first row of each code.

    ``FROM_TIME`` and ``TO_TIME`` are texts ``HH:mm:ss``; a duty that ends
    before it starts ends the next day (``over_midnight=False``: the plain,
    then negative, difference of the source). A day with a row whose length
    is unknown has an unknown maximum and is left out, as in the source.

    Two rows of one crew, day, code and length are alike but for their
    order, so a top-1 on those four comes first, before any shuffle: a hot
    day sends on as many rows as it has codes and lengths, however many rows
    tie for the maximum.
    """
    lo, hi = params.bounds(params.pilot_window)
    rows = scan_window(history, lo, hi).where(F.col("TRANSACTION_CODE").isin(*P.PILOT_RESERVE_CODES) & F.col("PAIRING_NO").isNull())
    span = seconds_of_day("TO_TIME") - seconds_of_day("FROM_TIME")
    if over_midnight:
        span = span + F.when(span < 0, 86400).otherwise(0)
    rows = with_stamp(rows).withColumn("__span", span).select(*WRAP_COLS, "TRANSACTION_CODE", "__span", STAMP, SEQ)
    day = ["CREW_ID", "PAIRING_DATE"]
    firsts = first_per_key(rows, [*day, "TRANSACTION_CODE", "__span"], first_order())
    top = F.rank().over(Window.partitionBy(*day).orderBy(F.col("__span").desc_nulls_first()))
    return firsts.withColumn("__top", top).where((F.col("__top") == 1) & F.col("__span").isNotNull()).select(*WRAP_COLS, "TRANSACTION_CODE")
