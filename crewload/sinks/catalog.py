"""The silver table under a name in a database.

``SilverTable`` is partitioned by BID_PERIOD and bucketed by ``ROW_KEY``, a
stored text that encodes all eight columns (NULL apart from every text). The
append guard then is one plain equality: the table is read in its buckets and
never shuffled, only the batch is, and the joined rows already lie in the
buckets they are written to. Two rows share a key only if they are equal, so
no crew, base or day makes a bucket hot. The key is a storage column: ``read``
returns the eight columns of the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..params import SILVER_COLUMNS
from ..schema import SILVER
from ..session import stage

PERIOD = "BID_PERIOD"
ROW_KEY = "ROW_KEY"
BUCKETS = 64


def row_key(columns=SILVER_COLUMNS) -> Column:
    """All columns as one text, each by its length and value; NULL is '-'."""
    texts = [F.col(c).cast("string") for c in columns]
    return F.concat_ws(",", *(F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts))


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


class SilverTable:
    """``name`` is ``database.table``; the table is made on first use.

    Rows are compared and stored by the eight silver columns: a batch may
    lack some (NULL) and have others (left out). ``buckets`` should be about
    the number of tasks a full read takes; it is fixed when the table is made.
    """

    def __init__(self, spark: SparkSession, name: str, buckets: int = BUCKETS, database_location: str | None = None):
        self.spark, self.name, self.buckets = spark, name, buckets
        if "." in name:
            place = f" LOCATION '{database_location}'" if database_location else ""
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(name.rsplit('.', 1)[0])}{place}")
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in SILVER.fields if f.name != PERIOD)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {_quoted(name)} ({columns}, {ROW_KEY} string, {PERIOD} string) USING parquet"
            f" PARTITIONED BY ({PERIOD}) CLUSTERED BY ({ROW_KEY}) INTO {buckets} BUCKETS"
        )

    def stored(self) -> DataFrame:
        return self.spark.table(_quoted(self.name))

    def read(self) -> DataFrame:
        """The eight columns, in their order."""
        return self.stored().select(*SILVER_COLUMNS)

    def periods(self) -> list[str | None]:
        """S3: bid periods from the catalogue's partitions; no file is read."""
        found = [r[0].split("=", 1)[1] for r in self.spark.sql(f"SHOW PARTITIONS {_quoted(self.name)}").collect()]
        return [None if p in ("__HIVE_DEFAULT_PARTITION__", "null") else p for p in found]

    def _keyed(self, df: DataFrame) -> DataFrame:
        cols = [F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in SILVER.fields]
        return df.select(*cols).withColumn(ROW_KEY, row_key())

    def new_rows(self, batch: DataFrame, periods: list[str | None] | None = None) -> DataFrame:
        """Batch rows with no equal row in the table. ``periods`` (those
        of the batch) make the table open only their partitions."""
        there = self.stored()
        if periods is not None:
            inside = F.col(PERIOD).isin(*[p for p in periods if p is not None])
            there = there.where(inside | F.col(PERIOD).isNull() if None in periods else inside)
        return self._keyed(batch).join(there.select(ROW_KEY), ROW_KEY, "left_anti")

    def _insert(self, rows: DataFrame, overwrite: bool) -> dict:
        """Insert rows bucket by bucket; their number and periods are observed
        in the writing stage, whose tasks count once however often they run."""
        seen = Observation()
        found = rows.select(*self.stored().columns).observe(
            seen,
            F.count(F.lit(1)).alias("rows"),
            F.collect_set(PERIOD).alias("periods"),
            F.count(F.when(F.col(PERIOD).isNull(), 1)).alias("null_periods"),
        )
        conf, old = "spark.sql.sources.partitionOverwriteMode", self.spark.conf.get("spark.sql.sources.partitionOverwriteMode")
        self.spark.conf.set(conf, "dynamic")
        try:
            found.write.insertInto(_quoted(self.name), overwrite=overwrite)
        finally:
            self.spark.conf.set(conf, old)
        return seen.get

    def append(self, batch: DataFrame, guarded: bool = True) -> int:
        """S7 + M8: append the batch (behind the guard) and return the rows
        added (S8), counted by the write itself."""
        if not guarded:
            return self._insert(self._spread(self._keyed(batch)), overwrite=False)["rows"]
        batch = stage(batch, "append-batch")  # read twice; a plain scan also keeps the join whole
        periods = [r[0] for r in batch.select(PERIOD).distinct().collect()] if PERIOD in batch.columns else None
        return self._insert(self.new_rows(batch, periods), overwrite=False)["rows"]

    def _spread(self, rows: DataFrame) -> DataFrame:
        return rows.repartition(self.buckets, ROW_KEY)

    def overwrite(self, df: DataFrame) -> int:
        """The table becomes ``df``. New files replace the partitions only
        when all of them are written (a failed run leaves the table as it
        was); periods that ``df`` lacks are dropped after that."""
        before = self.periods()
        seen = self._insert(self._spread(self._keyed(df)), overwrite=True)
        now = {*seen["periods"], *([None] if seen["null_periods"] else [])}
        for p in before:
            if p not in now:
                spec = f"{PERIOD} = '{p}'" if p is not None else f"{PERIOD} = null"
                self.spark.sql(f"ALTER TABLE {_quoted(self.name)} DROP IF EXISTS PARTITION ({spec})")
        return seen["rows"]
