
import datetime as dt

from conftest import D, days, txn_rows
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from crewload import params as P
from crewload.functions.dates import backfill_cutoff, incremental_cutoff
from crewload.functions.predicates import not_in_keep_null, percent_2dp, percent_half_even
from crewload.operators import joins
from crewload.operators.dedup import first_per_key, latest_per_key
from crewload.operators.expand import pad_days
from crewload.plans import fa, pilot, reconcile as rc

RUN = P.RunParams(run_date=dt.date(2024, 12, 20))
RUN_BF = RUN.with_(last_bid_period="2024-12")


def test_n1_append_guard_matches_null_keys(spark):
    sch = StructType([StructField("a", StringType()), StructField("b", StringType())])
    batch = spark.createDataFrame([("x", None), ("y", "1")], sch)
    target = spark.createDataFrame([("x", None)], sch)
    out = joins.append_guard(batch, target).collect()
    assert [tuple(r) for r in out] == [("y", "1")]


def test_n2_not_in_keeps_null(spark):
    df = spark.createDataFrame([("1",), ("10",), ("7",), (None,)], "CREW_ID string")
    kept = sorted((r[0] or "NULL") for r in df.where(not_in_keep_null("CREW_ID", P.PLACEHOLDER_CREW_IDS)).collect())
    assert kept == ["7", "NULL"]


def test_n3_null_stamp_fails_cutoff_and_sorts_last(spark):
    rows = [
        ("RLV", D(5), D(5), None, None),
        ("RLV", D(6), D(6), None, "2024-11-01 00:00:00"),
    ]
    out = fa.fa_silver(txn_rows(spark, rows), RUN_BF, backfill=True)
    assert days(out) == [6]
    df = spark.createDataFrame([(1, None, "a"), (2, "2024-01-01 00:00:00", "b")], "q long, s string, v string")
    first = first_per_key(df.withColumn("k", F.lit(1)), ["k"], [F.col("s").asc_nulls_last(), F.col("q")])
    assert first.first()["v"] == "b"
    latest = latest_per_key(df.withColumn("k", F.lit(1)), ["k"], "s", "q")
    assert latest.first()["v"] == "b"


def test_n4_first_is_earliest_stamp_then_sequence(spark):
    rows = [
        ("RLV", D(5), D(5), None, "2024-11-02 00:00:00", {"BASE": "LAX"}),
        ("RLV", D(5), D(5), None, "2024-11-01 00:00:00", {"BASE": "SEA"}),
        ("RLV", D(5), D(5), None, "2024-11-01 00:00:00", {"BASE": "HNL"}),
    ]
    out = fa.fa_silver(txn_rows(spark, rows), RUN_BF, backfill=True).collect()
    assert [r["BASE"] for r in out] == ["SEA"]


def test_n5_flag_date_literal_is_inert(spark):
    assert P.FLAG_DATE_LITERAL == dt.date(1975, 6, 13)
    assert P.DEFAULT.flag_date == P.FLAG_DATE_LITERAL
    assert P.DEFAULT.with_(flag_date_intent=True).flag_date == dt.date(2024, 5, 1)


def test_n6_percent_half_even_and_zero(spark):
    df = spark.createDataFrame([(1, 8), (3, 8), (5, 8), (1, 0), (0, 3)], "a long, b long")
    got = [r[0] for r in df.select(percent_half_even(F.col("a"), F.col("b"))).collect()]
    # 12.5 -> 12, 37.5 -> 38, 62.5 -> 62 (ties to even); zero reserve -> NULL
    assert got == [12.0, 38.0, 62.0, None, 0.0]
    got2 = [r[0] for r in df.select(percent_2dp(F.col("a"), F.col("b"))).collect()]
    assert got2 == [12.5, 37.5, 62.5, None, 0.0]


def test_n9_incremental_cutoff_month_clamps(spark):
    df = spark.createDataFrame(
        [(dt.date(2024, 3, 24),), (dt.date(2024, 3, 15),), (dt.date(2024, 1, 3),), (dt.date(2024, 2, 28),)], "d date"
    )
    got = [r[0] for r in df.select(incremental_cutoff(F.col("d"), 7, 25)).collect()]
    # run+7 = 31 Mar -> Feb; 22 Mar -> Feb; 10 Jan -> Dec of the year before; 6 Mar -> Feb
    assert got == ["2024-02-25 00:00:00", "2024-02-25 00:00:00", "2023-12-25 00:00:00", "2024-02-25 00:00:00"]
    bp = spark.createDataFrame([("2024-03",), ("2024-01",)], "BID_PERIOD string")
    assert [r[0] for r in bp.select(backfill_cutoff("BID_PERIOD", 24)).collect()] == [
        "2024-02-24 00:00:00",
        "2023-12-24 00:00:00",
    ]


def test_n10_pad_is_one_day_and_fills_inside_group(spark):
    sch = "g string, DATE date, name string, v string, q long"
    ends = spark.createDataFrame(
        [("a", D(1), "PAIRING_DATE", "x", 1), ("a", D(4), "TO_DATE", None, 2), ("b", D(1), "PAIRING_DATE", None, 3), ("b", D(2), "TO_DATE", "y", 4)],
        sch,
    )
    out = pad_days(ends, ["g"], ["v"], [F.col("q")]).orderBy("g", "DATE").collect()
    assert [(r["g"], r["DATE"].day, r["name"], r["v"]) for r in out] == [
        ("a", 1, "PAIRING_DATE", "x"),
        ("a", 2, None, "x"),
        ("a", 3, None, "x"),
        ("a", 4, "TO_DATE", "x"),
        ("b", 1, "PAIRING_DATE", None),  # not filled from group a (N8)
        ("b", 2, "TO_DATE", "y"),
    ]


def test_n11_reused_pairing_bridges_gap(spark):
    rows = [
        ("ASN", D(2), D(3), "7", st := "2024-11-01 08:00:00"),
        ("ASN", D(8), D(9), "7", st),
    ]
    out = fa.fa_silver(txn_rows(spark, rows), RUN_BF, backfill=True)
    assert days(out) == list(range(2, 10))


def test_n12_null_to_date_is_dropped(spark):
    rows = [("ASN", D(2), None, "7", "2024-11-01 08:00:00"), ("ASN", D(5), D(5), "8", "2024-11-01 08:00:00")]
    out = fa.fa_silver(txn_rows(spark, rows), RUN_BF, backfill=True)
    assert days(out) == [5]


def test_n14_guard_is_not_an_upsert(spark):
    sch = "CREW_ID string, PAIRING_DATE date, BASE string"
    target = spark.createDataFrame([("c", D(1), "HNL")], sch)
    batch = spark.createDataFrame([("c", D(1), "LAX"), ("d", D(1), "HNL"), ("d", D(1), "HNL")], sch)
    out = joins.append_guard(batch, target)
    assert out.count() == 3


def test_n15_incremental_keeps_whole_asn_day_unless_switched(spark):
    rows = [
        ("ASN", D(3, 3), D(3, 3), "7", "2024-01-10 08:00:00"),
        ("FLP", D(3, 3), D(3, 3), None, "2024-01-10 08:00:01"),
    ]
    df = txn_rows(spark, rows)
    literal = sorted(r[0] for r in fa.fa_silver(df, P.DEFAULT, backfill=False).select("TRANSACTION_CODE").collect())
    assert literal == ["ASN", "FLP"]
    intent = fa.fa_silver(df, P.DEFAULT.with_(asn_rows_only=True), backfill=False)
    assert [r[0] for r in intent.select("TRANSACTION_CODE").collect()] == ["ASN"]


def test_pilot_rules_717_base_arc_fold_and_33y(spark):
    from crewload.schema import SCHED

    rows = [
        ("ARC", D(10, 3), D(10, 3), None, "2024-03-01 08:00:00"),
        ("ASN", D(11, 3), D(11, 3), "5", "2024-03-01 08:00:01"),
    ]
    hist = txn_rows(spark, rows, crew="9", indicator="P", base="LAX", position="CA")
    sched = spark.createDataFrame(
        [(1, "9", D(1, 3), D(31, 3), "717", "CA", "2024-03", D(1, 2), "12:00:00", "LAX", "O")], SCHED
    )
    inc = pilot.pilot_silver(hist, sched, P.DEFAULT, backfill=False).collect()
    assert sorted((r["TRANSACTION_CODE"], r["BASE"], r["EQUIPMENT"]) for r in inc) == [
        ("ASN", "HNL", "717"),
        ("SCR", "HNL", "717"),
    ]
    bf = pilot.pilot_silver(hist, sched, P.DEFAULT, backfill=True).collect()
    # the backfill folds "ACR" (never present): ARC stays, and no base override
    assert sorted((r["TRANSACTION_CODE"], r["BASE"]) for r in bf) == [("ARC", "LAX"), ("ASN", "LAX")]
    sched33 = sched.withColumn("EQUIPMENT", F.lit("33Y"))
    assert pilot.pilot_silver(hist, sched33, P.DEFAULT, backfill=False).count() == 0


def test_schedule_latest_version_wins(spark):
    from crewload.schema import SCHED

    sched = spark.createDataFrame(
        [
            (1, "9", D(1, 3), D(31, 3), "717", "CA", "2024-03", D(1, 2), "12:00:00", "LAX", "O"),
            (2, "9", D(1, 3), D(31, 3), "789", "CA", "2024-03", D(2, 2), "12:00:00", "LAX", "O"),
            (3, "9", D(1, 3), D(31, 3), "330", "CA", "2024-03", D(2, 2), "12:00:00", "LAX", "O"),
        ],
        SCHED,
    )
    out = pilot.latest_schedule(sched, P.DEFAULT, backfill=False).collect()
    assert [r["EQUIPMENT"] for r in out] == ["330"]  # latest stamp, then highest SCHED_SEQ


def test_w2_position_counts_rows_in_update_order(spark):
    rows = [
        ("RLV", D(5), D(5), None, "2024-11-01 08:00:00"),
        ("FLP", D(5), D(5), None, "2024-11-01 08:00:01"),
        ("RSV", D(5), D(5), None, "2024-11-01 08:00:02"),
        ("SNO", D(5), D(5), None, "2024-11-01 08:00:03"),
    ]
    r = rc.reconcile(txn_rows(spark, rows), RUN)
    pos = rc.reserve_position(r.rows).collect()
    assert [x["last_rlv_pos"] for x in pos] == [3]
    assert days(rc.released_after_reserve(r.flags)) == [5]


def test_p5_optional_pilot_cutoff(spark):
    from crewload.schema import SCHED

    rows = [
        ("SCR", D(10, 3), D(10, 3), None, "2024-02-20 23:59:59"),
        ("SCR", D(11, 3), D(11, 3), None, "2024-02-21 00:00:00"),
        ("ASN", D(12, 3), D(12, 3), "5", "2024-03-01 08:00:00"),
    ]
    hist = txn_rows(spark, rows, crew="9", indicator="P", base="LAX", position="CA")
    sched = spark.createDataFrame(
        [(1, "9", D(1, 3), D(31, 3), "330", "CA", "2024-03", D(1, 2), "12:00:00", "LAX", "O")], SCHED
    )
    plain = pilot.pilot_silver(hist, sched, P.DEFAULT, backfill=False)
    assert days(plain) == [10, 11, 12]
    cut = pilot.pilot_silver(hist, sched, P.DEFAULT.with_(pilot_cutoff_day=21), backfill=False)
    assert days(cut) == [10, 12]  # cutoff 2024-02-21 00:00:00, strict; ASN rows unaffected


def test_sort_key_orders_stamps_then_sequence(spark):
    from pyspark.sql import functions as F

    from crewload.operators.groups import sort_key

    top = 2**63 - 1
    ascending = [
        ("0001-01-01 00:00:00", None), ("0001-01-01 00:00:00", -top - 1), ("0001-01-01 00:00:00", top),
        ("2024-02-29 23:59:59", 1), ("2024-03-01 00:00:00", 0), ("9999-12-31 23:59:59", top), (None, 1), ("8:00", 2), (None, 3),
    ]
    rows = [(i, s, q) for i, (s, q) in enumerate(ascending)]
    df = spark.createDataFrame(rows, "i int, update_dt string, TXN_SEQ long")
    assert [r.i for r in df.orderBy(sort_key()).collect()] == list(range(len(rows)))
    assert df.where(sort_key().isNull()).count() == 0
