"""Silver table sinks: overwrite (S6), guarded append.

A table is a folder of Parquet files partitioned by ``BID_PERIOD``, or a name
(``database.table``, see ``catalog``). An append stages the batch once (the
lineage is cut in the cluster's shared checkpoint folder), takes its day and
bid period ranges from that copy, anti-joins it against the target pruned to
those ranges and writes what is new. The target's file list is fixed when it
is read, and new files appear only when the whole write commits, so files
added by the append itself are never compared, and a retried task repeats
the same comparison.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import append_guard
from ..params import SILVER_COLUMNS
from ..schema import SILVER
from ..session import delete_path, stage
from ..sources.log_table import partition_values
from .catalog import SilverTable

PARTITION = "BID_PERIOD"


def is_name(table: str) -> bool:
    """Whether ``table`` is a table name (``database.table``), not a path."""
    return re.fullmatch(r"\w+(\.\w+)+", table) is not None


def _write(df: DataFrame, path: str, mode: str, partition_by: str | None) -> dict:
    """Partitioned write. The ``rebalance`` hint adds one shuffle on the
    partition column that AQE may split (a huge bid period is written by
    many tasks) or merge (small periods do not leave many tiny files). Rows
    and periods are observed above it, in the writing stage."""
    if not partition_by or partition_by not in df.columns:
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode).parquet(path)
        return seen.get
    seen = Observation()
    rows = df.hint("rebalance", partition_by).observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.collect_set(F.col(partition_by).cast("string")).alias("periods"),
        F.count(F.when(F.col(partition_by).isNull(), 1)).alias("null_periods"),
    )
    rows.write.mode(mode).partitionBy(partition_by).option("partitionOverwriteMode", "dynamic").parquet(path)
    return seen.get


def write_overwrite(df: DataFrame, path: str, partition_by: str | None = PARTITION) -> int:
    """Replace the whole table; returns the rows written.

    A partitioned table is replaced partition by partition when all new files
    are written, and periods that ``df`` lacks are removed last: a run that
    fails leaves the old table in place.
    """
    if is_name(path):
        return SilverTable(df.sparkSession, path).overwrite(df)
    spark = df.sparkSession
    before = partition_values(spark, path, partition_by) if partition_by else None
    seen = _write(df, path, "overwrite", partition_by)
    if before and "periods" in seen:
        now = {*seen["periods"], *([None] if seen["null_periods"] else [])}
        for p in before:
            if p not in now:
                name = "__HIVE_DEFAULT_PARTITION__" if p is None else p
                delete_path(spark, f"{path.rstrip('/')}/{partition_by}={name}")
    return seen["rows"]


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """Read back with the declared schema, so the partition column stays
    text ('2024-03' is never re-inferred) and columns keep their order."""
    if is_name(path):
        return SilverTable(spark, path).read()
    return spark.read.schema(SILVER).parquet(path).select(*SILVER_COLUMNS)


def batch_ranges(batch: DataFrame) -> dict[str, tuple]:
    """Smallest and largest day and bid period (one tiny aggregate), used to
    prune the target scan."""
    pruned = [c for c in ("PAIRING_DATE", PARTITION) if c in batch.columns]
    r = batch.agg(*(f(c).alias(f"{f.__name__}_{c}") for c in pruned for f in (F.min, F.max))).first()
    return {c: (r[f"min_{c}"], r[f"max_{c}"]) for c in pruned}


def guarded_rows(batch: DataFrame, target: DataFrame, ranges: dict[str, tuple] | None = None) -> DataFrame:
    """M8 core: batch rows not already in the target (all common columns,
    NULL = NULL). The target is pruned to the batch's measured ranges first,
    NULLs kept: safe because the ranged columns are among the compared ones.
    The bid period range opens only the partitions of those periods."""
    for name, (lo, hi) in (ranges or {}).items():
        if name in target.columns:
            inside = F.col(name).isNull()
            target = target.where(inside if lo is None else inside | F.col(name).between(F.lit(lo), F.lit(hi)))
    return append_guard(batch, target)


def append_guarded(spark: SparkSession, batch: DataFrame, path: str, partition_by: str | None = PARTITION) -> int:
    """S7 + S8: append the guarded batch and return the rows added, as the
    write itself counted them."""
    if is_name(path):
        return SilverTable(spark, path).append(batch)
    staged = stage(batch, "append-batch")
    rows = guarded_rows(staged, read_silver(spark, path), batch_ranges(staged))
    return _write(rows, path, "append", partition_by)["rows"]


def append_plain(df: DataFrame, path: str, partition_by: str | None = PARTITION) -> int:
    """The pilot backfill appends without a guard; returns the rows added."""
    if is_name(path):
        return SilverTable(df.sparkSession, path).append(df, guarded=False)
    return _write(df, path, "append", partition_by)["rows"]
