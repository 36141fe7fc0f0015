"""Joins by column name with NULL matching NULL (J1-J7), and A1.

The source matches missing keys to each other, so every key compares with
``<=>``. Spark still plans ``<=>`` as an equi-join (hash or sort-merge on
coalesced keys); AQE turns it into a broadcast join only when the runtime
size of a side is under the broadcast threshold, and splits skewed
partitions of the big side.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``on`` with NULL = NULL; key columns appear once.

    For ``inner``/``left`` the key values are taken from the left side and
    the right side contributes its other columns (fan-out kept).
    """
    how = how.lower()
    on = list(on)
    l, r = left.alias("__l"), right.alias("__r")
    cond = reduce(lambda a, b: a & b, [F.col(f"__l.{c}").eqNullSafe(F.col(f"__r.{c}")) for c in on])
    joined = l.join(r, cond, how)
    if how in ("left_semi", "semi", "leftsemi", "left_anti", "anti", "leftanti"):
        return joined
    right_only = [c for c in right.columns if c not in on and c not in left.columns]
    return joined.select(*[F.col(f"__l.{c}").alias(c) for c in left.columns], *[F.col(f"__r.{c}").alias(c) for c in right_only])


def measured_bytes(df: DataFrame) -> int:
    """Bytes ``df`` takes as Spark rows, measured by one aggregate: 8 bytes
    of header plus 8 per field, plus the bytes of each string field rounded
    up to whole words."""
    fields = df.schema.fields
    per_row = F.lit(8 + 8 * len(fields))
    for f in fields:
        if f.dataType.typeName() in ("string", "binary"):
            per_row = per_row + F.coalesce(F.octet_length(F.col(f.name)) + 7, F.lit(0))
    return int(df.agg(F.sum(per_row).alias("b")).first()["b"] or 0)


def broadcast_if_small(df: DataFrame, max_bytes: int = 64 << 20, bound_from: DataFrame | None = None) -> DataFrame:
    """Mark ``df`` for broadcast only when its size is *measured* to fit
    (twice the row bytes, for the hash table); beyond the bound the join
    stays a shuffle join.

    ``bound_from`` may be a cheaper DataFrame known to be at least as large
    (e.g. the scan ``df`` is reduced from, with ``df``'s columns), so the
    bound is proven without computing ``df`` twice. Deciding before the join
    is planned spares the big side its shuffle, which a runtime (AQE)
    conversion cannot: by then both sides are shuffled.
    """
    measured = measured_bytes(df if bound_from is None else bound_from)
    return F.broadcast(df) if 2 * measured <= max_bytes else df


def semi_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    return join_null_safe(left, right.select(*on), on, "left_semi")


def anti_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    return join_null_safe(left, right.select(*on), on, "left_anti")


def common_columns(new: DataFrame, target: DataFrame) -> list[str]:
    """A1: names present in both, in the order of ``target``."""
    mine = set(new.columns)
    return [c for c in target.columns if c in mine]


def align_columns(new: DataFrame, target: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A1: project both sides on their common columns (metadata only)."""
    cols = common_columns(new, target)
    return new.select(*cols), target.select(*cols)


def append_guard(batch: DataFrame, target: DataFrame) -> DataFrame:
    """Batch rows with no identical row (NULL = NULL) in the target, on
    all common columns. Duplicates inside the batch are all kept."""
    b, t = align_columns(batch, target)
    return anti_join(b, t, b.columns)
