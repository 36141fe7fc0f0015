"""Scans of the transaction log and the schedule.

Each scan is a plain ``where`` on the source DataFrame, so on a Parquet
table Catalyst pushes the day range into the row-group filters and, when the
table is written with ``partitionBy('BID_PERIOD')``, prunes partitions. A
``LogTable`` also knows each period's days, so a day window opens only the
periods that can hold it, and its periods are listed without a scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .log_table import LogTable

Log = DataFrame | LogTable
SCHEDULE_COLUMNS = (
    "SCHED_SEQ",
    "CREW_ID",
    "EFFECTIVE_FROM_DATE",
    "EFFECTIVE_TO_DATE",
    "EQUIPMENT",
    "PAIRING_POSITION",
    "BID_DATE",
    "UPDATE_DATE",
    "UPDATE_TIME",
    "BASE",
    "BID_TYPE",
)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """A history or schedule table; any format Spark reads (``jdbc`` too)."""
    return spark.read.format(fmt).options(**options).load(path)


def log_rows(history: Log) -> DataFrame:
    return history.rows if isinstance(history, LogTable) else history


def scan_window(history: Log, lo: dt.date, hi: dt.date) -> DataFrame:
    """Rows whose PAIRING_DATE lies in the closed range lo..hi."""
    rows = history.window(lo, hi) if isinstance(history, LogTable) else history
    return rows.where(F.col("PAIRING_DATE").between(F.lit(lo), F.lit(hi)))


def scan_bid_periods(history: Log, first: str, last: str) -> DataFrame:
    """Every bid period of the backfill in one scan (text range)."""
    return log_rows(history).where(F.col("BID_PERIOD").between(first, last))


def bid_periods(history: Log, first: str, last: str) -> DataFrame:
    """S3: catalogue of bid periods in range, newest first. Of a partitioned
    table the folder names tell them; else a distinct over one column."""
    listed = history.periods() if isinstance(history, LogTable) else None
    if listed is not None:
        inside = sorted((p for p in listed if p is not None and first <= p <= last), reverse=True)
        return history.sparkSession.createDataFrame([(p,) for p in inside], "BID_PERIOD string")
    return (
        scan_bid_periods(log_rows(history).select("BID_PERIOD"), first, last)
        .distinct()
        .orderBy(F.col("BID_PERIOD").desc())
    )


def schedule_scan(schedule: DataFrame, first: str, last: str | None = None) -> DataFrame:
    """Projected schedule versions by bid date (range, or one value)."""
    cols = [c for c in SCHEDULE_COLUMNS if c in schedule.columns]
    bid = F.col("BID_DATE")
    cond = bid == first if last is None else bid.between(first, last)
    return schedule.select(*cols).where(cond)
