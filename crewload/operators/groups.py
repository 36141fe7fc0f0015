"""Group-level predicates and order positions.

The source sorts each (crew, day) group by update stamp and compares row
numbers ("a release code after the last reserve code"). Such a test only
needs, per group, the sort key of the last row of each code set: "some row
of set B comes after the last row of set A" is "last(B) > last(A)". So the
flags are plain aggregates (``max`` of a fixed-width sort key, which hash
aggregation updates in place) with partial aggregation before the shuffle,
and the rows meet their flags through a null-safe semi or anti join, which
AQE can split when one group is hot.
Nothing gathers a whole group in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import anti_join, join_null_safe, semi_join


def sort_key(stamp: str = "update_dt", seq: str = "TXN_SEQ") -> Column:
    """Ascending row order as one decimal: the 14 digits of the stamp (NULL
    last, as is a stamp not of the form yyyy-MM-dd HH:mm:ss), then the
    sequence (NULL first)."""
    return F.expr(
        rf"""cast(coalesce(CASE WHEN {stamp} RLIKE r'^\d{{4}}-\d\d-\d\d \d\d:\d\d:\d\d$'
            THEN cast(translate({stamp}, '- :', '') AS decimal(15, 0)) END, 100000000000000BD) * 100000000000000000000BD
        + coalesce(cast({seq} AS decimal(20, 0)) + 9223372036854775809BD, 0BD) AS decimal(38, 0))"""
    )


def last_key(codes: Sequence[str], code_col: str = "TRANSACTION_CODE", key: Column | None = None) -> Column:
    """W2 as an aggregate: sort key of the last row whose code is in ``codes``
    (NULL when the group has none)."""
    key = sort_key() if key is None else key
    return F.max(F.when(F.col(code_col).isin(*codes), key))


def after(later: Column, earlier: Column) -> Column:
    """``later > earlier`` with a missing side meaning "no such row".

    A missing ``earlier`` counts as position 0, so any ``later`` row wins.
    """
    return F.when(later.isNull(), F.lit(False)).when(earlier.isNull(), F.lit(True)).otherwise(later > earlier)


def group_flags(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    """One row per group with the named aggregate columns."""
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])


def group_any(df: DataFrame, keys: Sequence[str], pred: Column) -> DataFrame:
    """F8: rows of the groups where ``pred`` holds for at least one row."""
    hit = df.where(pred).select(*keys).distinct()
    return semi_join(df, hit, keys)


def group_reject(df: DataFrame, keys: Sequence[str], pred: Column) -> DataFrame:
    """rows of the groups where ``pred`` holds for no row."""
    hit = df.where(pred).select(*keys).distinct()
    return anti_join(df, hit, keys)


def last_position(df: DataFrame, keys: Sequence[str], codes: Sequence[str], name: str = "last_pos") -> DataFrame:
    """W2 with the source's 1-based row number of the last row in ``codes``
    (NULL when absent), per group.

    The row number is the count of group rows sorted at or before that row:
    an aggregate, a join of the one-row-per-group result back, and a second
    aggregate. No per-group sort.
    """
    last = group_flags(df, keys, {"__last": last_key(codes)})
    ranked = join_null_safe(df.select(*keys, sort_key().alias("__k")), last, keys, "inner")
    return ranked.groupBy(*keys).agg(
        F.when(F.max(F.col("__last")).isNull(), F.lit(None).cast("int"))
        .otherwise(F.count(F.when(F.col("__k") <= F.col("__last"), 1)).cast("int"))
        .alias(name)
    )
