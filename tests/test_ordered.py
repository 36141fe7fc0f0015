"""Whole-table order: dense ids, running sums, the ungrouped fill."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from crewload.operators import ordered


def rows_of(spark, values):
    return spark.createDataFrame([(i, k, v) for i, (k, v) in enumerate(values)], "i long, k string, v long")


@pytest.fixture(scope="module")
def some(spark):
    rng = np.random.default_rng(5)
    keys = [None, "a", "b", "hot", "hot", "hot", "z", ""]
    return [(keys[rng.integers(0, 8)], None if rng.random() < 0.6 else int(rng.integers(0, 100))) for _ in range(700)]


def test_dense_ids_match_a_dense_rank(spark, some):
    got = ordered.dense_ids(rows_of(spark, some), ["k", "v"]).collect()
    keys = sorted({*some}, key=lambda x: (x[0] is None, x[0] or "", x[1] is None, x[1] or 0))
    place = {k: n for n, k in enumerate(keys, 1)}
    assert len(got) == len(some) and all(r.temp_id == place[(r.k, r.v)] for r in got)


def test_running_sum_matches_a_cumulative_sum(spark, some):
    got = ordered.running_sum(rows_of(spark, some), [F.col("i")], "v").orderBy("i").collect()
    assert [r.before for r in got] == list(np.cumsum([0] + [v or 0 for _, v in some])[:-1])


@pytest.mark.parametrize("within", [[], ["g"]])
def test_fill_matches_a_loop(spark, some, within):
    df = rows_of(spark, some).withColumn("g", F.floor(F.col("i") / 90))
    got = ordered.fill_down_all(df, ["k", "v"], [F.col("g"), F.col("i")], within).orderBy("i").collect()
    last, group = [None, None], None
    for r, old in zip(got, some, strict=True):
        if within and r.g != group:
            last, group = [None, None], r.g
        last = [b if b is not None else a for a, b in zip(last, old, strict=True)]
        assert [r.k, r.v] == last


def test_empty_tables(spark):
    none = rows_of(spark, [])
    assert ordered.dense_ids(none, ["k"]).collect() == []
    assert ordered.running_sum(none, [F.col("i")], "v").collect() == []
    assert ordered.fill_down_all(none, ["k"], [F.col("i")]).collect() == []


def test_no_single_partition_window(spark, some):
    df = rows_of(spark, some)
    for out in (
        ordered.dense_ids(df, ["k"]),
        ordered.running_sum(df, [F.col("i")], "v"),
        ordered.fill_down_all(df, ["v"], [F.col("i")]),
    ):
        text = out._jdf.queryExecution().executedPlan().toString()
        assert "Window" in text and "SinglePartition" not in text
