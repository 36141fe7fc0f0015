"""Flight-attendant silver rows: backfill (M4) and incremental batch (M5).

Both are one lazy plan over the whole scan. The backfill ran once per bid
period in the source; here ``BID_PERIOD`` is part of every key instead, so
all periods go through the same shuffles in one job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions.dates import backfill_cutoff, incremental_cutoff
from ..functions.predicates import fold_code
from ..operators.dedup import first_per_key
from ..operators.expand import DATE, expand_multi, expand_single, fill_literal
from ..operators.groups import group_any
from ..operators.reshape import union_by_name
from ..sources.history import Log, scan_bid_periods, scan_window
from .common import ASN_COLS, FILL_COLS, SEQ, STAMP, first_order, keyed, lit_equipment, silver, stage, with_stamp


def fa_scan(history: Log, params: P.RunParams, backfill: bool) -> DataFrame:
    if backfill:
        return scan_bid_periods(history, params.first_bid_period, params.last_bid_period)
    lo, hi = params.bounds(params.fa_window)
    return scan_window(history, lo, hi)


def fa_cutoff(params: P.RunParams, backfill: bool):
    if backfill:
        return backfill_cutoff("BID_PERIOD", params.backfill_cutoff_day)
    return incremental_cutoff(F.lit(params.run_date), params.cutoff_lead_days, params.incremental_cutoff_day)


def fa_order():
    return first_order()


def fa_day_keys(backfill: bool):
    return keyed(["CREW_ID", "TRANSACTION_CODE", DATE, "PAIRING_NO"], backfill)


def fa_pad_keys(backfill: bool):
    return keyed(["CREW_ID", "BASE", "PAIRING_NO"], True) if backfill else ["CREW_ID", "PAIRING_NO", STAMP]


def fa_single(asn: DataFrame, backfill: bool) -> DataFrame:
    # backfill ASN rows are already one per (period, crew, day, code), which
    # makes the single-day key (period, crew, code, day, pairing) unique
    return lit_equipment(expand_single(asn, fa_day_keys(backfill), first_order(), input_unique=backfill), P.FA_EQUIPMENT)


def fa_multi(asn: DataFrame, backfill: bool, params: P.RunParams = P.DEFAULT) -> DataFrame:
    keys, pads = fa_day_keys(backfill), fa_pad_keys(backfill)
    if params.literal_fill:  # a backfill filled each bid period by itself
        padded = expand_multi(asn, keys, pads, first_order(), ())
        out = fill_literal(padded, pads, first_order(), FILL_COLS, ["BID_PERIOD"] if backfill else [])
    else:
        out = expand_multi(asn, keys, pads, first_order(), FILL_COLS)
    return lit_equipment(out.withColumnRenamed(DATE, "PAIRING_DATE"), P.FA_EQUIPMENT)


def fa_backfill_firsts(scan: DataFrame, params: P.RunParams) -> DataFrame:
    """Backfill reserve rows (before their cutoff) and ASN rows share one
    key, so one window pass over one scan finds the first row of both."""
    codes = P.FA_RESERVE_CODES + (P.ASSIGNMENT_CODE,)
    rows = with_stamp(scan.where((F.col("CREW_INDICATOR") == P.FA) & F.col("TRANSACTION_CODE").isin(*codes)))
    rows = rows.where((F.col("TRANSACTION_CODE") == P.ASSIGNMENT_CODE) | (F.col(STAMP) < fa_cutoff(params, True)))
    rows = first_per_key(rows, keyed(["CREW_ID", "PAIRING_DATE", "TRANSACTION_CODE"], True), first_order())
    return rows.select(*ASN_COLS, SEQ)


def fa_backfill_parts(scan: DataFrame, params: P.RunParams) -> tuple[DataFrame, DataFrame]:
    """Backfill reserve and assignment rows, from first rows staged once."""
    firsts = stage(fa_backfill_firsts(scan, params), "fa-bf-firsts")
    reserve = firsts.where(F.col("TRANSACTION_CODE").isin(*P.FA_RESERVE_CODES))
    return lit_equipment(reserve, P.FA_EQUIPMENT), firsts.where(F.col("TRANSACTION_CODE") == P.ASSIGNMENT_CODE)


def fa_incremental_parts(scan: DataFrame, params: P.RunParams) -> tuple[DataFrame, DataFrame]:
    """Incremental reserve and assignment rows from one pass over the log.

    The assignment branch keeps the first row per (crew, day, code, stamp);
    the reserve branch the first per (crew, day, code) before the cutoff,
    which is the first of those finer first rows. So one window pass on the
    finer key (partial top-1 before the shuffle), staged once, feeds both;
    the "day holds an ASN" test is a distinct of that staged table joined
    back (null-safe semi join).
    """
    rows = with_stamp(scan.where(F.col("CREW_INDICATOR") == P.FA))
    fine = stage(
        first_per_key(rows, ["CREW_ID", "PAIRING_DATE", "TRANSACTION_CODE", STAMP], first_order()).select(*ASN_COLS, SEQ),
        "fa-inc-firsts",
    )
    rsv = fine.where(F.col("TRANSACTION_CODE").isin(*P.FA_RESERVE_CODES) & (F.col(STAMP) < fa_cutoff(params, False)))
    rsv = first_per_key(rsv, ["CREW_ID", "PAIRING_DATE", "TRANSACTION_CODE"], first_order())
    reserve = lit_equipment(rsv, P.FA_EQUIPMENT)
    is_asn = F.col("TRANSACTION_CODE") == P.ASSIGNMENT_CODE
    asn = fine.where(is_asn) if params.asn_rows_only else group_any(fine, ["CREW_ID", "PAIRING_DATE"], is_asn)
    return reserve, asn


def fa_silver(history: Log, params: P.RunParams = P.DEFAULT, backfill: bool = True) -> DataFrame:
    """M4 (backfill) / M5 (incremental): union, date cap, RSV counted as RLV."""
    scan = fa_scan(history, params, backfill)
    reserve, asn = (fa_backfill_parts if backfill else fa_incremental_parts)(scan, params)
    parts = [silver(reserve), silver(fa_single(asn, backfill)), silver(fa_multi(asn, backfill, params))]
    cap = params.run_date if backfill else params.incremental_cap
    out = union_by_name(*parts).where(F.col("PAIRING_DATE") <= F.lit(cap))
    out = out.withColumn("TRANSACTION_CODE", fold_code("TRANSACTION_CODE", *P.FOLDED_FA_CODE))
    return silver(lit_equipment(out, P.FA_EQUIPMENT))
