"""Pieces shared by the crew pipelines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import stamp_order, update_stamp
from ..params import SILVER_COLUMNS
from ..session import stage  # noqa: F401  (re-exported for the plans)

STAMP = "update_dt"
SEQ = "TXN_SEQ"
FILL_COLS = ("CREW_INDICATOR", "CREW_ID", "TRANSACTION_CODE", "PAIRING_POSITION", "BID_PERIOD", "BASE")
ASN_COLS = (
    "CREW_INDICATOR",
    "CREW_ID",
    "TRANSACTION_CODE",
    "PAIRING_NO",
    "PAIRING_DATE",
    "TO_DATE",
    "PAIRING_POSITION",
    "BID_PERIOD",
    "BASE",
    STAMP,
)


def with_sequence(df: DataFrame, seq: str) -> DataFrame:
    """``df`` with the tie-break column ``seq``. A table without one (the
    source's own query selects none) gets a hash of the whole row: the same
    row has the same place however the table is read, and only equal rows
    tie."""
    if seq in df.columns:
        return df
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in sorted(df.columns)]
    return df.withColumn(seq, F.xxhash64(*texts))


def with_stamp(df: DataFrame) -> DataFrame:
    """Log rows with their update stamp, and with a sequence if they have none."""
    return with_sequence(df, SEQ).withColumn(STAMP, update_stamp())


def first_order():
    """Earliest update first, NULL stamps last, then the log sequence."""
    return stamp_order(STAMP, SEQ)


def silver(df: DataFrame) -> DataFrame:
    """Project to the silver table's columns, in its order."""
    return df.select(*SILVER_COLUMNS)


def keyed(keys, backfill: bool):
    """Backfills ran once per bid period, so every key carries the period."""
    return (["BID_PERIOD"] if backfill else []) + [k for k in keys if not (backfill and k == "BID_PERIOD")]


def lit_equipment(df: DataFrame, value: str) -> DataFrame:
    return df.withColumn("EQUIPMENT", F.lit(value))
