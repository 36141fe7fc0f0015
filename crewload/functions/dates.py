"""Date and update-stamp expressions.

All are built-in Column expressions: they stay inside whole-stage codegen and
fold to literals when their inputs are literals.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    if isinstance(c, Column):
        return c
    if isinstance(c, (dt.date, dt.datetime)):
        return F.lit(c)
    return F.col(c)


def update_stamp(date_col="UPDATE_DATE", time_col="UPDATE_TIME") -> Column:
    """'yyyy-MM-dd HH:mm:ss' text of the update; NULL if either part is NULL
    or not of that form (one rule for cutoffs, order and day flags).

    The text orders like the moment it names, so it is compared and sorted
    as text (cutoffs, earliest / latest version).
    """
    stamp = F.concat(_col(date_col).cast("string"), F.lit(" "), _col(time_col).cast("string"))
    return F.when(stamp.rlike(r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d$"), stamp)


def stamp_order(stamp="update_dt", seq="TXN_SEQ") -> list[Column]:
    """Sort order for "first": earliest, NULL last, then the sequence."""
    return [_col(stamp).asc_nulls_last(), _col(seq).asc()]


def incremental_cutoff(run_date, lead_days: int = 7, day: int = 25) -> Column:
    """P2: '<month before run+lead>-<day> 00:00:00'.

    The month step clamps at the month end (31 Mar -> 29 Feb), so the cutoff
    month is always the calendar month before run+lead.
    """
    month = F.add_months(F.date_add(_col(run_date), lead_days), -1)
    return F.concat(F.date_format(month, "yyyy-MM"), F.lit(f"-{day:02d} 00:00:00"))


def backfill_cutoff(bid_period="BID_PERIOD", day: int = 24) -> Column:
    """P3: '<bid period, day> minus one month' at midnight, per row."""
    anchor = F.try_to_date(F.concat(_col(bid_period), F.lit(f"-{day:02d}")), "yyyy-MM-dd")
    return F.concat(F.date_format(F.add_months(anchor, -1), "yyyy-MM-dd"), F.lit(" 00:00:00"))


def seconds_of_day(time_col) -> Column:
    """Seconds since midnight of an ``HH:mm:ss`` text; NULL for any other."""
    t = _col(time_col).cast("string")
    part = lambda i: F.substring(t, i, 2).try_cast("int")
    return F.when(t.rlike(r"^([01]\d|2[0-3]):[0-5]\d:[0-5]\d$"), part(1) * 3600 + part(4) * 60 + part(7))
