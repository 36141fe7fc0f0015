import datetime as dt
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[*]")
        .appName("crewload-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="crewload-test-ckpt-"))
    yield s


def D(day, month=12, year=2024):
    return dt.date(year, month, day)


def txn_rows(spark, rows, crew="C1", indicator="FA", base="HNL", position="FA"):
    """rows: (code, pairing_date, to_date, pairing_no, stamp 'YYYY-MM-DD HH:MM:SS')
    plus optional dict of overrides as a 6th element. TXN_SEQ is the list order."""
    from crewload.schema import TXN

    out = []
    for i, r in enumerate(rows, start=1):
        code, pd_, td, pno, stamp = r[:5]
        extra = r[5] if len(r) > 5 else {}
        ud, ut = (stamp.split(" ") if stamp else (None, None))
        rec = {
            "TXN_SEQ": i,
            "CREW_INDICATOR": indicator,
            "CREW_ID": crew,
            "TRANSACTION_CODE": code,
            "PAIRING_NO": pno,
            "PAIRING_DATE": pd_,
            "TO_DATE": td,
            "PAIRING_POSITION": position,
            "BID_PERIOD": pd_.strftime("%Y-%m") if pd_ else None,
            "BASE": base,
            "UPDATE_DATE": dt.date.fromisoformat(ud) if ud else None,
            "UPDATE_TIME": ut,
        }
        rec.update(extra)
        out.append(tuple(rec[f.name] for f in TXN.fields))
    return spark.createDataFrame(out, TXN)


def days(df, col="PAIRING_DATE"):
    return sorted(r[col].day for r in df.select(col).collect())
