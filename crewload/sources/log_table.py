"""The transaction log as a partitioned table with a day catalogue.

The log is filtered by PAIRING_DATE but partitioned by BID_PERIOD, so a day
window alone would open the files of every period. The writer therefore
keeps a zone map beside the data: the smallest and largest day of each
period it wrote (``_day_ranges``, a folder that Spark's readers skip). A scan
turns its window into the few periods that can hold such days, which is a
partition filter.

The catalogue may only ever be too wide. An append adds its ranges before its
data, so a run that dies in between opens a partition for nothing; a period
without an entry (another writer, a lost catalogue) is always opened; a
period with a NULL day has no more to it, since no window keeps that row.
"""

from __future__ import annotations

import datetime as dt
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

PERIOD, DAY = "BID_PERIOD", "PAIRING_DATE"
RANGES = "_day_ranges"
RANGE_SCHEMA = "BID_PERIOD string, LO_DAY date, HI_DAY date"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def _folder(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, hpath


def _hidden(name: str) -> bool:
    return name.startswith(("_", "."))


def partition_values(spark: SparkSession, path: str, column: str = PERIOD) -> list[str | None] | None:
    """The values of a table's first partition column that have data files,
    from folder names alone (no data file is opened); None when the table
    isn't partitioned by ``column``."""
    fs, hpath = _folder(spark, path)
    if not fs.exists(hpath):
        return None
    out: list[str | None] = []
    for s in fs.listStatus(hpath):
        name = s.getPath().getName()
        if _hidden(name):
            continue
        if not s.isDirectory() or not name.startswith(f"{column}="):
            return None
        if any(not _hidden(f.getPath().getName()) for f in fs.listStatus(s.getPath())):
            value = unquote(name.split("=", 1)[1])
            out.append(None if value == NULL_PARTITION else value)
    return out


def write_log(df: DataFrame, path: str, mode: str = "append") -> None:
    """Write (``overwrite``) or extend (``append``) a log and its catalogue.
    ``df`` is read twice, the first time for two columns only."""
    ranges = df.groupBy(PERIOD).agg(F.min(DAY).alias("LO_DAY"), F.max(DAY).alias("HI_DAY")).coalesce(1)
    data = df.hint("rebalance", PERIOD).write.mode(mode).partitionBy(PERIOD)
    if mode == "overwrite":  # replaces the folder, the old catalogue with it
        data.parquet(path)
        ranges.write.mode("append").parquet(f"{path.rstrip('/')}/{RANGES}")
    else:
        ranges.write.mode("append").parquet(f"{path.rstrip('/')}/{RANGES}")
        data.parquet(path)


class LogTable:
    """A log written by ``write_log`` (or by others, partitioned alike). The
    plans take it wherever they take a DataFrame of the log."""

    def __init__(self, spark: SparkSession, path: str):
        self.sparkSession, self.path = spark, path
        found = spark.read.parquet(path).schema
        text = [StructField(f.name, StringType()) if f.name == PERIOD else f for f in found.fields]
        self.rows = spark.read.schema(StructType(text)).parquet(path)  # '2024-03' stays text

    @property
    def columns(self) -> list[str]:
        return self.rows.columns

    def periods(self) -> list[str | None] | None:
        return partition_values(self.sparkSession, self.path)

    def day_ranges(self) -> dict[str | None, tuple[dt.date | None, dt.date | None]]:
        """Smallest and largest day by period, all writes together."""
        place = f"{self.path.rstrip('/')}/{RANGES}"
        fs, hpath = _folder(self.sparkSession, place)
        if not fs.exists(hpath):
            return {}
        entries = self.sparkSession.read.schema(RANGE_SCHEMA).parquet(place)
        rows = entries.groupBy(PERIOD).agg(F.min("LO_DAY").alias("lo"), F.max("HI_DAY").alias("hi")).collect()
        return {r[PERIOD]: (r.lo, r.hi) for r in rows}

    def periods_between(self, lo: dt.date, hi: dt.date) -> list[str | None] | None:
        """Periods that may hold days of lo..hi (None: unknown, open all)."""
        there = self.periods()
        if there is None:
            return None
        known = self.day_ranges()
        keep = lambda r: r[0] is not None and r[0] <= hi and r[1] >= lo
        return [p for p in there if p not in known or keep(known[p])]

    def window(self, lo: dt.date, hi: dt.date) -> DataFrame:
        """Rows of the periods that may hold days of lo..hi."""
        periods = self.periods_between(lo, hi)
        if periods is None:
            return self.rows
        inside = F.col(PERIOD).isin(*[p for p in periods if p is not None])
        return self.rows.where(inside | F.col(PERIOD).isNull() if None in periods else inside)


def open_log(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> LogTable | DataFrame:
    """The log at ``path``: a ``LogTable`` if it is Parquet partitioned by
    bid period, else a plain DataFrame of any format Spark reads."""
    if fmt == "parquet" and not options and partition_values(spark, path) is not None:
        return LogTable(spark, path)
    return spark.read.format(fmt).options(**options).load(path)
