"""Trip expansion: one row per day of an assignment.

A multi-day assignment is stored as one row ``PAIRING_DATE .. TO_DATE``.
The source unpivots the two ends, removes duplicate ends, inserts the
missing days of each pad group between its first and last day and fills the
descriptive columns downwards. Here that is one window per pad group after
the end dedup: each end row, sorted by day inside its group, emits its own
day plus the missing days up to the next end (``sequence`` + ``explode``),
carrying the filled values. Groups hold ends only (at most one per day and
code, because of the dedup), so a group is bounded by its calendar span,
not by the data volume.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .dedup import first_per_key
from .ordered import fill_down_all

DATE = "DATE"
NAME = "name"  # which end a row came from; NULL on an inserted day
ENDS = ("PAIRING_DATE", "TO_DATE")


def unpivot_dates(df: DataFrame, ends: Sequence[str] = ENDS) -> DataFrame:
    """Wide -> long on the two end columns (``name``, ``DATE``)."""
    ids = [c for c in df.columns if c not in ends]
    return df.unpivot(ids, list(ends), NAME, DATE)


def single_day(df: DataFrame) -> DataFrame:
    """Rows whose trip starts and ends on the same day (NULL ends: neither)."""
    return df.where(F.col("PAIRING_DATE") == F.col("TO_DATE"))


def multi_day(df: DataFrame) -> DataFrame:
    return df.where(F.col("PAIRING_DATE") != F.col("TO_DATE"))


def expand_single(
    df: DataFrame, dedup_keys: Sequence[str], order: Sequence[Column], input_unique: bool = False
) -> DataFrame:
    """Single-day trips, one row per ``dedup_keys`` (DATE is the day).

    Unpivoting a single-day row yields two identical days, which the dedup
    folds into one, so the day is simply PAIRING_DATE. ``input_unique``
    states that ``df`` already has one row per ``dedup_keys`` (the caller
    deduplicated on a finer-or-equal key), and skips the no-op shuffle.
    """
    rows = single_day(df).withColumn(DATE, F.col("PAIRING_DATE")).withColumn(NAME, F.lit("PAIRING_DATE"))
    if not input_unique:
        rows = first_per_key(rows, dedup_keys, order)
    return rows.drop("PAIRING_DATE", "TO_DATE").withColumnRenamed(DATE, "PAIRING_DATE")


def trip_ends(df: DataFrame, dedup_keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Multi-day trips unpivoted to their two ends, one end per ``dedup_keys``
    (which must contain ``DATE``)."""
    return first_per_key(unpivot_dates(multi_day(df)), dedup_keys, order)


def pad_days(
    ends: DataFrame,
    group_keys: Sequence[str],
    fill_cols: Sequence[str] = (),
    tiebreak: Sequence[Column] = (),
) -> DataFrame:
    """X3 (+ W7 when ``fill_cols``): insert every missing day between the
    first and last ``DATE`` of each group.

    Inserted days carry the group keys, ``NAME`` NULL and, for
    ``fill_cols``, the last non-NULL value at or before them in day order
    (the downward fill); every other column is NULL on inserted days. Fill
    columns of existing rows are filled the same way.
    """
    w = Window.partitionBy(*group_keys).orderBy(F.col(DATE).asc(), *tiebreak)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cols = ends.columns
    # Group keys are constant inside a group, so only the other fill columns
    # need the window; all window expressions go in one projection, so they
    # share one sort and the exchange on the group keys is not repeated.
    to_fill = [c for c in fill_cols if c not in group_keys]
    win = ends.select(
        *[F.last(c, ignorenulls=True).over(upto).alias(c) if c in to_fill else F.col(c) for c in cols],
        F.lead(DATE).over(w).alias("__next"),
    )
    nxt, day = F.col("__next"), F.col(DATE)
    # days to emit after this end: up to the day before the next end; an
    # integer offset range keeps the expansion free of session time zones
    span = F.when(nxt.isNull() | (nxt <= day), F.lit(0)).otherwise(F.datediff(nxt, day) - 1)
    spread = win.select(*cols, F.explode(F.sequence(F.lit(0), span)).alias("__off"))
    spread = spread.withColumn("__day", F.date_add(day, F.col("__off")))
    inserted = F.col("__off") > 0
    keep = set(group_keys) | set(fill_cols)
    return spread.select(
        *[F.col(c) if c in keep else F.when(inserted, F.lit(None)).otherwise(F.col(c)).alias(c) for c in cols if c != DATE],
        F.col("__day").alias(DATE),
    )


def expand_multi(
    df: DataFrame,
    dedup_keys: Sequence[str],
    pad_keys: Sequence[str],
    order: Sequence[Column],
    fill_cols: Sequence[str],
) -> DataFrame:
    """Ends -> dedup -> pad -> fill, with ``NAME`` kept for X4."""
    ends = trip_ends(df, dedup_keys, order)
    return pad_days(ends, pad_keys, fill_cols, tiebreak=[F.col(NAME).asc_nulls_last(), *order])


def trip_order(pad_keys: Sequence[str], order: Sequence[Column]) -> list[Column]:
    """Rows of padded trips: trips by their keys, days ascending."""
    return [*(F.col(k).asc_nulls_last() for k in pad_keys), F.col(DATE).asc(), F.col(NAME).asc_nulls_last(), *order]


def fill_literal(
    padded: DataFrame, pad_keys: Sequence[str], order: Sequence[Column], fill_cols: Sequence[str], within: Sequence[str] = ()
) -> DataFrame:
    """W7 as the source writes it (N8): one fill over all trips, so a missing
    value takes that of the row above even if it belongs to another trip."""
    return fill_down_all(padded, fill_cols, trip_order(pad_keys, order), within)


def carried_days(expanded: DataFrame) -> DataFrame:
    """X4 core: every day of a multi-day trip except its first day (rows
    that are the TO_DATE end or inserted)."""
    return expanded.where((F.col(NAME) == "TO_DATE") | F.col(NAME).isNull())
