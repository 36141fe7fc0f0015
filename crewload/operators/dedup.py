"""First / latest row per key (D1, F10) and whole-row distinct.

``row_number() = 1`` over a key is planned by Catalyst as a
``WindowGroupLimit``: a partial top-1 per key runs before the shuffle, so a
hot key sends at most one row per map task across the network.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "__rn"


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of each key group in ``order``.

    ``order`` must make the choice deterministic (end it with a unique
    column), because a DataFrame has no row order of its own.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)


def latest_per_key(df: DataFrame, keys: Sequence[str], stamp: str, tiebreak: str) -> DataFrame:
    """F10 + D1: the latest version per key (highest stamp, NULL loses), ties
    broken by the highest ``tiebreak``."""
    return first_per_key(df, keys, [F.col(stamp).desc_nulls_last(), F.col(tiebreak).desc()])


def latest_with_ties(df: DataFrame, keys: Sequence[str], stamp: str) -> DataFrame:
    """F10 alone: every row whose stamp equals its group's maximum (ties
    kept; a group whose stamps are all NULL is kept whole). The maximum is a partial aggregate joined back on the keys, so a
    hot group is never sorted in one task."""
    from .joins import join_null_safe

    top = df.groupBy(*keys).agg(F.max(stamp).alias("__top"))
    joined = join_null_safe(df, top, keys, "inner")
    return joined.where(F.col(stamp).eqNullSafe(F.col("__top"))).drop("__top")


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row distinct (partial + final hash aggregate)."""
    return df.distinct()
