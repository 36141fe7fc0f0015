"""Crew tables derived from the driver's generated tables.

The driver ships no crew data, so ``events`` becomes the transaction log and
``orders`` the versioned crew schedule (rules in FIXTURES.md §2). The columns
and types are those of the real sources, so every plan reads these exactly as
it would read the production tables. The derivation is plain Spark SQL
expressions (``selectExpr``): one projection over each scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# --- fixed values: derivation rules of the two crew views (FIXTURES.md §2) ---
TXN_STAGE = [
    "event_id AS TXN_SEQ",
    "CASE WHEN user_id % 3 = 0 THEN 'P' ELSE 'FA' END AS CREW_INDICATOR",
    "CAST(user_id AS STRING) AS CREW_ID",
    """CASE WHEN event_type IN ('signup','view') THEN
         CASE WHEN user_id % 3 = 0 THEN CASE WHEN event_id % 2 = 0 THEN 'SCR' ELSE 'ARC' END
              ELSE CASE WHEN event_id % 2 = 0 THEN 'RLV' ELSE 'RSV' END END
       WHEN event_type = 'purchase' THEN 'ASN'
       WHEN event_type = 'error' THEN CASE event_id % 4 WHEN 0 THEN 'SNO' WHEN 1 THEN 'GDO' WHEN 2 THEN 'OFF' ELSE 'DRP' END
       ELSE CASE event_id % 9 WHEN 0 THEN 'FLP' WHEN 1 THEN 'FLU' WHEN 2 THEN '2SK' WHEN 3 THEN 'FLV' WHEN 4 THEN 'FLS'
            WHEN 5 THEN 'SOP' WHEN 6 THEN 'REM' WHEN 7 THEN 'FAR' ELSE 'MIL' END END AS TRANSACTION_CODE""",
    "date_add(CAST(ts AS DATE), CAST(30 * (user_id % 4) AS INT)) AS PAIRING_DATE",
    """CASE WHEN user_id % 3 <> 0 THEN 'FA' WHEN user_id % 15 = 0 THEN 'SO' WHEN user_id % 6 = 0 THEN 'CA'
       ELSE 'FO' END AS PAIRING_POSITION""",
    """CASE WHEN event_id % 89 = 0 THEN NULL WHEN user_id % 5 = 0 THEN 'LAX' WHEN user_id % 5 = 1 THEN 'SEA'
       ELSE 'HNL' END AS BASE""",
    "substr(CAST(ts AS STRING), 12, 8) AS UPDATE_TIME",
]
TXN_FINAL = [
    "TXN_SEQ",
    "CREW_INDICATOR",
    "CREW_ID",
    "TRANSACTION_CODE",
    "CASE WHEN TRANSACTION_CODE = 'ASN' THEN CAST(TXN_SEQ % 200 AS STRING) END AS PAIRING_NO",
    "PAIRING_DATE",
    """CASE WHEN TXN_SEQ % 97 = 0 THEN NULL
       WHEN TRANSACTION_CODE = 'ASN' THEN date_add(PAIRING_DATE, CAST(TXN_SEQ % 4 AS INT))
       ELSE PAIRING_DATE END AS TO_DATE""",
    "PAIRING_POSITION",
    "substr(CAST(PAIRING_DATE AS STRING), 1, 7) AS BID_PERIOD",
    "BASE",
    "date_sub(PAIRING_DATE, CAST(TXN_SEQ % 60 AS INT)) AS UPDATE_DATE",
    "UPDATE_TIME",
]
# Duty times of the log rows (FIXTURES.md §2): a start, and an end up to 23.5
# hours later (so some duties pass midnight); some ends are missing.
TXN_TIMES = [
    "*",
    "UPDATE_TIME AS FROM_TIME",
    """CASE WHEN TXN_SEQ % 101 <> 0 THEN substr(CAST(TIMESTAMP'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0,
       CAST(substr(UPDATE_TIME, 1, 2) AS INT) , CAST(substr(UPDATE_TIME, 4, 2) AS INT) + 30 * CAST(TXN_SEQ % 48 AS INT),
       CAST(substr(UPDATE_TIME, 7, 2) AS INT)) AS STRING), 12, 8) END AS TO_TIME""",
]
SCHED_COLS = [
    "o_orderkey AS SCHED_SEQ",
    "CAST(o_custkey AS STRING) AS CREW_ID",
    "date_add(DATE'2024-01-01', CAST(30 * (o_orderkey % 4) AS INT)) AS EFFECTIVE_FROM_DATE",
    "date_add(DATE'2024-01-30', CAST(30 * (o_orderkey % 4) AS INT)) AS EFFECTIVE_TO_DATE",
    """CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN '717' WHEN '2' THEN '789' WHEN '3' THEN '33Y'
       WHEN '4' THEN '330' ELSE NULL END AS EQUIPMENT""",
    """CASE WHEN o_custkey % 3 <> 0 THEN 'FA' WHEN o_custkey % 15 = 0 THEN 'SO' WHEN o_custkey % 6 = 0 THEN 'CA'
       ELSE 'FO' END AS PAIRING_POSITION""",
    "concat('2024-0', CAST(1 + o_orderkey % 4 AS STRING)) AS BID_DATE",
    "CAST(o_orderdate AS DATE) AS UPDATE_DATE",
    "'12:00:00' AS UPDATE_TIME",
    "CASE WHEN o_custkey % 5 = 0 THEN 'LAX' WHEN o_custkey % 5 = 1 THEN 'SEA' ELSE 'HNL' END AS BASE",
    "o_orderstatus AS BID_TYPE",
]
# ---------------------------------------------------------------------------


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transaction log from ``events``."""
    return _table(spark, sf_dir, "events").selectExpr(*TXN_STAGE).selectExpr(*TXN_FINAL)


def txn_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transaction log with the duty times ``FROM_TIME`` and ``TO_TIME``."""
    return txn(spark, sf_dir).selectExpr(*TXN_TIMES)


def sched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crew schedule versions from ``orders``."""
    return _table(spark, sf_dir, "orders").selectExpr(*SCHED_COLS)
