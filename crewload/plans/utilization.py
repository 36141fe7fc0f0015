"""Gold utilization reports (M1-M3).

Each is one aggregate over the silver rows: partial counts per task, one
shuffle on the report keys, then a narrow projection for the percent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions.predicates import flag_rule_keep, fold_code, percent_2dp, percent_half_even
from ..operators.reshape import pivot_codes

GOLD_COLUMNS = ("PAIRING_POSITION", "PAIRING_DATE", "BASE", "EQUIPMENT", "ASN", "RLV_SCR", "PERCENT_UTILIZATION")


def utilization_live(reconciled: DataFrame, base: str = P.REPORT_BASE) -> DataFrame:
    """M1: daily reserve and assignment counts for one base, and the percent
    of reserve crew used (half-even integer; NULL on a day with no reserve)."""
    rows = reconciled.where(F.col("BASE") == base).withColumn(
        "TRANSACTION_CODE", fold_code("TRANSACTION_CODE", *P.FOLDED_FA_CODE)
    )
    wide = pivot_codes(rows, ["PAIRING_DATE", "BASE"], ["RLV", P.ASSIGNMENT_CODE])
    return wide.withColumn("perc_utl", percent_half_even(F.col("ASN"), F.col("RLV")))


def utilization_fa(fa_silver: DataFrame) -> DataFrame:
    """M2: per day and base; days without reserve are left out."""
    wide = pivot_codes(fa_silver, ["PAIRING_DATE", "BASE"], ["RLV", P.ASSIGNMENT_CODE])
    wide = wide.withColumnRenamed("RLV", "RLV_SCR").where(F.col("RLV_SCR") > 0)
    return wide.select(
        F.lit(P.FA).alias("PAIRING_POSITION"),
        "PAIRING_DATE",
        "BASE",
        F.lit(P.FA_EQUIPMENT).alias("EQUIPMENT"),
        "ASN",
        "RLV_SCR",
        percent_2dp(F.col("ASN"), F.col("RLV_SCR")).alias("PERCENT_UTILIZATION"),
    )


def utilization_pilot(pilot_silver: DataFrame, params: P.RunParams = P.DEFAULT) -> DataFrame:
    """M3: per day, base, seat and equipment; SCR is the reserve count.
    ARC counts as SCR here, as the report follows the code fold."""
    pilot_silver = pilot_silver.withColumn("TRANSACTION_CODE", fold_code("TRANSACTION_CODE", *P.FOLDED_PILOT_CODE))
    keys = ["BASE", "PAIRING_DATE", "PAIRING_POSITION", "EQUIPMENT"]
    wide = pivot_codes(pilot_silver, keys, ["SCR", P.ASSIGNMENT_CODE]).withColumnRenamed("SCR", "RLV_SCR")
    wide = wide.where(flag_rule_keep("PAIRING_DATE", "EQUIPMENT", params.flag_date, P.FLAGGED_EQUIPMENT))
    wide = wide.where(F.col("RLV_SCR") > 0)
    return wide.select(
        "PAIRING_POSITION",
        "PAIRING_DATE",
        "BASE",
        "EQUIPMENT",
        "ASN",
        "RLV_SCR",
        percent_2dp(F.col("ASN"), F.col("RLV_SCR")).alias("PERCENT_UTILIZATION"),
    )
