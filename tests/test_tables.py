"""The guarded append's pruning, and where staged tables live."""

import threading

import pytest
from conftest import D
from crewload import session
from crewload.schema import SILVER
from crewload.session import scratch_path, stage, staging_scope
from crewload.sinks import tables


def silver_rows(spark, rows):
    return spark.createDataFrame([("FA", crew, "RLV", day, "FA", period, "HNL", "NA") for crew, day, period in rows], SILVER)


def test_guard_opens_only_the_batch_periods(spark):
    path = scratch_path(spark, "pruned")
    old = [("a", D(1, 1), "2024-01"), ("b", D(2, 2), "2024-02"), ("c", None, None), ("d", D(3, 3), "2024-03")]
    tables.write_overwrite(silver_rows(spark, old), path)
    batch = stage(silver_rows(spark, [*old[1:3], ("e", D(3, 2), "2024-02")]), "batch")
    rows = tables.guarded_rows(batch, tables.read_silver(spark, path), tables.batch_ranges(batch))
    text = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(isnull(BID_PERIOD" in text and text.count("LeftAnti") == 1
    assert [r.CREW_ID for r in rows.collect()] == ["e"]


def test_second_append_of_null_and_reversed_days_adds_nothing(spark):
    path = scratch_path(spark, "repeat")
    tables.write_overwrite(silver_rows(spark, []), path)
    batch = silver_rows(spark, [("a", None, "2024-02"), ("b", D(1, 2), None), ("c", D(9, 1), "2024-02")])
    assert [tables.append_guarded(spark, batch, path) for _ in range(2)] == [3, 0]


def test_cluster_session_without_shared_folder_is_refused():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_scopes_of_two_threads_are_apart(spark):
    inner: list[str] = []

    def other():
        with staging_scope(spark) as paths:
            stage(spark.range(3), "other")
            inner.extend(paths)

    with staging_scope(spark) as mine:
        kept = stage(spark.range(5), "mine")
        t = threading.Thread(target=other)
        t.start()
        t.join()
        assert len(mine) == len(inner) == 1 and kept.count() == 5
