"""Whole-table order without a single task: dense ids (D3), running sums and
the ungrouped downward fill (W7 as the source writes it).

A DataFrame is range-partitioned on the order and written once, each row
with the number of its range (so the ranges stay fixed, whatever is retried).
Inside a range a window does the work; across ranges only one row per range
(a count, a sum, the last values) is folded on the driver and sent back. The
number of ranges is ``spark.sql.shuffle.partitions``, so nothing that is
collected or broadcast grows with the data.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..session import stage
from .joins import join_null_safe

PART = "__part"


def range_parts(df: DataFrame, order: Sequence[Column], name: str = "ranges") -> DataFrame:
    """``df`` staged in order ranges, ``PART`` being the range's number. Rows
    of equal order lie in one range, so the order should be near total."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stage(df.repartitionByRange(n, *order).withColumn(PART, F.spark_partition_id()), name)


def _carried(parts: DataFrame, summary: dict[str, Column], fold: Callable[[dict, dict], dict]) -> DataFrame:
    """One row per range: ``summary`` of all ranges before it, folded in
    range order; to be broadcast (as many rows as ranges)."""
    rows = parts.groupBy(PART).agg(*(c.alias(n) for n, c in summary.items()))
    seen: dict = dict.fromkeys(summary)
    out = []
    for r in sorted(rows.collect(), key=lambda r: r[PART]):
        out.append((r[PART], *seen.values()))
        seen = fold(seen, {n: r[n] for n in summary})
    schema = StructType([StructField(f.name, f.dataType) for f in rows.schema])
    return F.broadcast(parts.sparkSession.createDataFrame(out, schema))


def running_sum(df: DataFrame, order: Sequence[Column], value: str, name: str = "before") -> DataFrame:
    """Every row with the sum of ``value`` (NULL: 0) over all rows before it."""
    parts = range_parts(df, order, "running-sum")
    total = F.coalesce(F.sum(value), F.lit(0)).cast("long")
    base = _carried(parts, {"__base": total}, lambda a, b: {"__base": (a["__base"] or 0) + b["__base"]})
    upto = Window.partitionBy(PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(value).over(upto), F.lit(0)).cast("long")
    joined = parts.withColumn("__in", inside).join(base, PART, "left")
    return joined.select(*df.columns, (F.col("__in") + F.coalesce("__base", F.lit(0))).alias(name))


def dense_ids(df: DataFrame, keys: Sequence[str], name: str = "temp_id") -> DataFrame:
    """D3: every row with the 1-based number of its key group, groups in key
    order (NULL last): a dense rank over the whole table.

    The distinct keys are numbered by range; the rows meet their number by a
    null-safe join, which AQE splits where one group holds much of the table.
    """
    order = [F.col(k).asc_nulls_last() for k in keys]
    parts = range_parts(df.select(*keys).distinct(), order, "group-ids")
    base = _carried(parts, {"__base": F.count(F.lit(1))}, lambda a, b: {"__base": (a["__base"] or 0) + b["__base"]})
    inside = F.row_number().over(Window.partitionBy(PART).orderBy(*order))
    ids = parts.withColumn("__in", inside).join(base, PART, "left")
    ids = ids.select(*keys, (F.col("__in") + F.coalesce("__base", F.lit(0))).cast("long").alias(name))
    return join_null_safe(df, ids, keys, "inner")


def fill_down_all(
    df: DataFrame, cols: Sequence[str], order: Sequence[Column], within: Sequence[str] = ()
) -> DataFrame:
    """Ungrouped downward fill: each NULL of ``cols`` becomes the last value
    above it in ``order``, across all groups (rows before the first value
    stay NULL). ``order`` should be total: equal rows may take turns. A value
    doesn't pass a change of ``within``, whose columns must lead the order.
    """
    parts = range_parts(df, order, "fill-down")
    w = Window.partitionBy(PART, *within).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    place = F.row_number().over(Window.partitionBy(PART).orderBy(*order))
    scope = "named_struct({})".format(", ".join(f"'k{i}', `{c}`" for i, c in enumerate(within)) or "'k', 0")
    last = {
        f"__last_{c}": F.expr(f"max_by(named_struct('v', `{c}`, 's', {scope}), __pos) FILTER (WHERE `{c}` IS NOT NULL)")
        for c in cols
    }
    carry = _carried(parts.withColumn("__pos", place), last, lambda a, b: {n: a[n] if b[n] is None else b[n] for n in a})
    filled = parts.select(
        PART, F.expr(scope).alias("__scope"),
        *(F.last(c, ignorenulls=True).over(upto).alias(c) if c in cols else F.col(c) for c in df.columns),
    ).join(carry, PART, "left")

    def value(c: str) -> Column:
        above = F.when(F.col(f"__last_{c}.s").eqNullSafe(F.col("__scope")), F.col(f"__last_{c}.v"))
        return F.coalesce(c, above).alias(c)

    return filled.select(*(value(c) if c in cols else F.col(c) for c in df.columns))
