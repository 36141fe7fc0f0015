"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import contextlib
import contextvars
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job wants whatever the cluster size: AQE re-plans joins and
# partition counts from runtime sizes and splits skewed join partitions.
# Broadcast joins are chosen only from *measured* sizes: the plan-time guess
# (compressed file bytes, which can be far below the in-memory size) is
# switched off, and AQE broadcasts a side once its shuffle output is known
# to be under the runtime threshold.
SQL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(
    master: str = "local[8]", shuffle_partitions: int = 8, app: str = "crewload", conf: dict | None = None
) -> SparkSession:
    b = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("CREWLOAD_DRIVER_MEMORY", "16g"))
    )
    for k, v in {**SQL_DEFAULTS, **(conf or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``
    as the session sees it); create a private one only when a local session
    has none (tests, local runs). A cluster session without one is refused:
    a folder of one machine is not seen by the executors."""
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session has no SparkContext
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf and (sc is None or not (sc.master == "local" or sc.master.startswith("local["))):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    path = conf or tempfile.mkdtemp(prefix="crewload-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(path)
        return sc.getCheckpointDir() or path
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh table location under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/crewload/{name}-{uuid.uuid4().hex[:12]}"


#: Open staging scopes of this thread (or task), innermost last.
_SCOPES: contextvars.ContextVar[tuple[list[str], ...]] = contextvars.ContextVar("crewload_scopes", default=())


@contextlib.contextmanager
def staging_scope(spark: SparkSession):
    """Delete every table staged inside the ``with`` block when it ends.

    Use it around jobs that *finish* inside the block (writes, counts);
    DataFrames returned out of the block must not read staged tables.
    """
    paths: list[str] = []
    token = _SCOPES.set((*_SCOPES.get(), paths))
    try:
        yield paths
    finally:
        _SCOPES.reset(token)
        for p in paths:
            delete_path(spark, p)


def delete_path(spark: SparkSession, path: str) -> None:
    """Recursive delete through the cluster's file system client."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def stage(df, name: str = "stage"):
    """Materialise a result that several branches (or a later write) read.

    Column pruning gives each branch a different plan, so Spark would scan
    and shuffle the source once per branch. Instead the rows are written
    once as a Parquet table in the cluster's shared checkpoint folder and
    read back: the lineage is cut there (a lost executor recomputes from the
    table, not from the source), and each reader reads only its columns.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    if _SCOPES.get():
        _SCOPES.get()[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)
