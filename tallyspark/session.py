"""Session preparation.

Everything in this package assumes UTC session time (the reference's
timestamps are UTC and ``date(ts)`` is taken in UTC). ``prepare`` pins that
and turns on adaptive execution; it never overrides a cluster-provided
checkpoint directory.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


# Suggested settings for a large cluster (100 TB class). Shuffle width is
# left to AQE: start wide, coalesce to ~256 MB partitions at runtime, and
# split skewed join partitions. Apply with ``build_session(extra=CLUSTER_CONF)``
# or the cluster's defaults.
CLUSTER_CONF = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.compression.codec": "zstd",
}


# Spark's default share of a task in a scan and behind a shuffle, and ours where
# the session has that one: compressed JSON is some ten times as large in the sort
# behind the scan, shuffled keys and numbers thirty to seventy times in those behind the shuffle.
_TASK_SHARES = {
    "spark.sql.files.maxPartitionBytes": ("134217728b", "32m"),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": ("67108864b", "8m"),
}


def prepare(spark: SparkSession) -> SparkSession:
    for k, (default, ours) in _TASK_SHARES.items():
        if spark.conf.get(k) == default:
            spark.conf.set(k, ours)
    for k, v in _RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


# Source bytes per shuffle partition to start from: the rows that a shuffle
# carries are some 12 times their source files, so this is about 100 MB of them.
SOURCE_BYTES_PER_PARTITION = 8 << 20


def shuffle_width(spark: SparkSession) -> int:
    """The number of partitions that a shuffle starts with."""
    return int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
               or spark.conf.get("spark.sql.shuffle.partitions"))


def size_shuffles(spark: SparkSession, source_bytes: int) -> None:
    """Lets shuffles start with partitions that grow with the source, so that a
    task's share of a sort or an aggregate doesn't; AQE joins small ones again.
    Only ever raises the number."""
    wanted = -(-source_bytes // SOURCE_BYTES_PER_PARTITION)
    if wanted > shuffle_width(spark):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(wanted))


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_steps = {"open": 0, "before": "false"}
_steps_lock = threading.Lock()


@contextmanager
def steps(spark: SparkSession) -> Iterator[None]:
    """A job of written steps: the shuffle files of a write are removed when it has ended, not when
    the driver next collects its garbage. For writes, whose plan nobody runs again. Threads
    and inner steps may overlap: the last one to end puts the setting back."""
    with _steps_lock:
        if not _steps["open"]:
            _steps["before"] = spark.conf.get(SHUFFLE_CLEANUP, "false")
            spark.conf.set(SHUFFLE_CLEANUP, "true")
        _steps["open"] += 1
    try:
        yield
    finally:
        with _steps_lock:
            _steps["open"] -= 1
            if not _steps["open"]:
                spark.conf.set(SHUFFLE_CLEANUP, _steps["before"])


def build_session(master: str | None = None, app: str = "tallyspark",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster, use the session the platform gives
    you and call ``prepare`` on it."""
    master = master or os.environ.get("SPARK_MASTER", "local[*]")
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in _RUNTIME_CONF.items():
        b = b.config(k, v)
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written tables.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir). Only
    when neither is set *and* the master is local (local runs, tests) a private
    folder is made and registered, so later calls agree on it. On a cluster a
    machine-local folder would be invisible to executors, so an unset
    directory is an error there.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        d = jdir.get() if jdir.isDefined() else None
    if not d:
        master = spark.sparkContext.master or ""
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: point it at a folder shared by "
                               "the driver and all executors (e.g. on the cluster file system)")
        d = tempfile.mkdtemp(prefix="tallyspark-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
        spark.conf.set("spark.checkpoint.dir", d)
    return d


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, never-used location under the shared folder; it is removed when
    the driver ends (a lazy result may read it until then)."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    app = spark.sparkContext.applicationId
    if app not in _fresh:
        _fresh[app] = []
        atexit.register(_remove, spark, _fresh[app])
    _fresh[app].append(path)
    return path


_fresh: dict[str, list[str]] = {}


def _remove(spark: SparkSession, paths: list[str]) -> None:
    if spark.sparkContext._jsc is None:  # the session has ended: nothing can be deleted through it
        return
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
