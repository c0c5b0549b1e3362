"""Session settings and the shared folder for tables that cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Semantics the jobs rely on; each can be set on a running session.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # The JVM never compiles a longer method; Spark then builds projections of short ones instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A task that writes few partitions keeps their files open instead of sorting its rows by partition first.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    # Landed and staged tables are mostly hexadecimal digests and record texts: half the bytes of Spark's default, and no slower.
    "spark.sql.parquet.compression.codec": "zstd",
}

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the semantics depend on; sizing is left to the cluster."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(name: str = "feedmark", cores: int | str = "*") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("FEEDMARK_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session may fall back on a folder of its own: on a cluster a machine-local
    path would be lost with its machine.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"{CHECKPOINT_DIR} must name a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="feedmark-")
    spark.conf.set(CHECKPOINT_DIR, folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


_SCRATCH: list[list[str]] = []  # folders staged in each open ``scratch``, the innermost last


def stage(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The lineage is cut in a way that survives executor loss, the plan is not computed again by
    each consumer, and Catalyst sees the true size of the table when it picks a join. Inside ``scratch`` the table
    goes with it, unless it is to ``keep``.
    """
    path = new_folder(df.sparkSession, name)
    if _SCRATCH and not keep:
        _SCRATCH[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a job that runs inside go at its end, not when the driver happens to collect its garbage.

    For writes, whose plan runs once: one that ran again would have to redo its shuffles.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are removed at the end: what is still to be read of them must be written by then."""
    _SCRATCH.append([])
    try:
        yield
    finally:
        for folder in _SCRATCH.pop():
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
