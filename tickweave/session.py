"""Spark session helpers: local sessions for tests/bench, and the reliable checkpoint folder."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "tickweave") -> SparkSession:
    """Session with the settings every operator here assumes.

    On a cluster the master, partition counts and ``spark.checkpoint.dir`` come from
    ``spark-submit``; only local runs (tests, bench) pass ``master``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = (builder
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.parquet.compression.codec", "zstd")
               .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if master and master.startswith("local"):
        builder = (builder.config("spark.driver.memory", "8g")
                   .config("spark.sql.warehouse.dir",
                           tempfile.mkdtemp(prefix="tickweave-wh-", dir=os.environ.get("TMPDIR", "/tmp"))))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only where the session has none.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that is always used.
    A machine-local temporary folder is created only for a local master (tests, bench).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) for this cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tickweave-ckpt-", dir=os.environ.get("TMPDIR", "/tmp")))
    return sc.getCheckpointDir()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the checkpoint folder for written intermediate tables and stream state."""
    base = ensure_checkpoint_dir(spark)
    return base.rstrip("/") + "/" + name


@contextmanager
def stream_shuffles(spark: SparkSession) -> Iterator[int]:
    """Streaming queries started inside shuffle into a partition a core at most.

    A micro-batch is bounded in rows and adaptive execution doesn't merge the partitions of
    stateful ones: each costs a task, a state store and a commit in every micro-batch,
    however few keys there are. A query copies the settings when it is started."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    n = min(int(before), max(2, spark.sparkContext.defaultParallelism))
    spark.conf.set(name, str(n))
    try:
        yield n
    finally:
        spark.conf.set(name, before)


TARGET_PARTITION_BYTES = 128 * 1024 * 1024


def tune_partitions(spark: SparkSession, *frames, target_bytes: int = TARGET_PARTITION_BYTES,
                    minimum: int | None = None, maximum: int = 200_000) -> int:
    """Size shuffles for the inputs at hand: ``spark.sql.shuffle.partitions`` = estimated
    input bytes / ``target_bytes``.

    Uses Catalyst's size estimate of each frame (file sizes and column widths, no job).
    AQE still coalesces small partitions and splits skewed ones at run time; this sets the
    starting count so no partition has to hold more than about ``target_bytes`` before spill.
    ``minimum`` defaults to the cluster's default parallelism.
    """
    from tickweave.operators.series import estimated_bytes
    total = sum(estimated_bytes(f) for f in frames)
    lo = minimum if minimum is not None else spark.sparkContext.defaultParallelism
    n = max(lo, min(maximum, -(-total // target_bytes)))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n
