"""Session settings and the shared folder used for checkpoints and written tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Settings every job relies on.  They can be changed on a running session, so
# they also apply when the session was built by somebody else.  Cluster sizing
# (executors, shuffle partitions, memory) is left to whoever starts the session.
RUNTIME_SETTINGS = {
    # Timestamps in the event log are UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A key holding a large share of the rows is split at run time, even when
    # the split costs one more exchange for the aggregate that follows.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    for name, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def local_session(cores: str = "8", shuffle_partitions: int = 8, folder: str | None = None) -> SparkSession:
    """Session for tests and for the benchmark on one machine; ``folder`` is the shared folder."""
    builder = SparkSession.builder.master(f"local[{cores}]")
    if folder or "spark.checkpoint.dir" not in SparkConf().toDebugString():
        builder = builder.config("spark.checkpoint.dir", folder or tempfile.mkdtemp(prefix="basketry-"))
    spark = (
        builder
        .appName("basketry")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: the one named in ``spark.checkpoint.dir``.

    Without that setting there is no folder to fall back on: a machine-local one
    would not survive the loss of an executor.  Tables written there stay, but for those of
    a ``scratch`` block; give the folder a retention rule.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors when building the session")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def new_path(spark: SparkSession, name: str) -> str:
    """Fresh path below the shared folder; never one that is already in use."""
    return f"{shared_dir(spark).rstrip('/')}/basketry/{name}-{uuid.uuid4().hex}"


# Folders written in the open ``scratch`` blocks of this thread, the innermost last.
_scratch: ContextVar[tuple[list[str], ...]] = ContextVar("scratch", default=())

#: Shuffle files go when their query ends, not when the driver happens to collect its garbage.
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df, name: str, outlives: int = 0):
    """Write a table to the shared folder and read it back, cutting the lineage.

    In a ``scratch`` block the table is deleted at its end, or at the end of the block that many further out.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    blocks = _scratch.get()
    if len(blocks) > outlives:
        blocks[-1 - outlives].append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """A step whose tables and shuffle files are gone when it ends; what is read later must outlive it.

    It belongs to one thread: tables written by others stay.  Every query inside runs once.
    """
    paths: list[str] = []
    token = _scratch.set((*_scratch.get(), paths))
    before = spark.conf.get(FILE_CLEANUP, None)
    spark.conf.set(FILE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(FILE_CLEANUP, before) if before is not None else spark.conf.unset(FILE_CLEANUP)
        _scratch.reset(token)
        context = spark.sparkContext
        for path in paths:
            place = context._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)
