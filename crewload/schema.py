"""Schemas of the crew tables (column names the source reads)."""

from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType


def _s(*fields):
    return StructType([StructField(n, t, True) for n, t in fields])


S, D, L = StringType(), DateType(), LongType()

TXN = _s(
    ("TXN_SEQ", L), ("CREW_INDICATOR", S), ("CREW_ID", S), ("TRANSACTION_CODE", S), ("PAIRING_NO", S),
    ("PAIRING_DATE", D), ("TO_DATE", D), ("PAIRING_POSITION", S), ("BID_PERIOD", S), ("BASE", S),
    ("UPDATE_DATE", D), ("UPDATE_TIME", S),
)

SCHED = _s(
    ("SCHED_SEQ", L), ("CREW_ID", S), ("EFFECTIVE_FROM_DATE", D), ("EFFECTIVE_TO_DATE", D), ("EQUIPMENT", S),
    ("PAIRING_POSITION", S), ("BID_DATE", S), ("UPDATE_DATE", D), ("UPDATE_TIME", S), ("BASE", S), ("BID_TYPE", S),
)

SILVER = _s(
    ("CREW_INDICATOR", S), ("CREW_ID", S), ("TRANSACTION_CODE", S), ("PAIRING_DATE", D),
    ("PAIRING_POSITION", S), ("BID_PERIOD", S), ("BASE", S), ("EQUIPMENT", S),
)
