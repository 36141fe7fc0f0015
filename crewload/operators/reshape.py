"""Counts and code pivots (D4, D8) and the union by name."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def daily_counts(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Rows per group (partial + final hash aggregate)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).cast("bigint").alias(name))


def pivot_codes(df: DataFrame, keys: Sequence[str], codes: Sequence[str], code_col: str = "TRANSACTION_CODE") -> DataFrame:
    """One count column per code, 0 where a group lacks the code.

    The code list is explicit, so Spark needs no extra pass to find the
    distinct values and the output schema does not depend on the data.
    """
    return (
        df.groupBy(*keys)
        .pivot(code_col, list(codes))
        .agg(F.count(F.lit(1)).cast("bigint"))
        .na.fill(0, subset=list(codes))
    )


def union_by_name(*dfs: DataFrame) -> DataFrame:
    """Stack by column name, keeping duplicates."""
    return reduce(lambda a, b: a.unionByName(b), dfs)
