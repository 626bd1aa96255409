"""Session settings and staging in the shared folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

# SQL settings every job of this package expects. All can be changed at run time.
SQL_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more shuffle further up.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Size-checked broadcast only; no job of this package uses a broadcast hint.
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    # Rows take several times the room of the parquet they came from; check that size.
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
}

# Settings that only a new session can take.
START_SETTINGS = {
    # No call-site capture per expression: wide projections are built in half the time.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build(app: str = "guestbook", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_SETTINGS, **START_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the package's SQL settings to a session somebody else built."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it."""
    configured = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    return _local_dir(spark.sparkContext.applicationId)


@cache
def _local_dir(application_id: str) -> str:
    return tempfile.mkdtemp(prefix=f"guestbook-{application_id}-")


# Folders made for each session, by its number in the JVM.
_FOLDERS: dict[int, list[str]] = {}


def _made(spark: SparkSession) -> list[str]:
    return _FOLDERS.setdefault(spark._jsparkSession.hashCode(), [])


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A folder of its own in the shared folder, for what lasts no longer than the run."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _made(spark).append(path)
    return path


# Whether a plan's shuffle files go when it has run, instead of when the driver's JVM next collects its garbage.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_SPARING = threading.Lock()


@contextmanager
def _sparing(spark: SparkSession) -> Iterator[None]:
    """One at a time, so that the disk holds the shuffles of one write."""
    with _SPARING:
        before = spark.conf.get(_DROP_SHUFFLES, "false")
        spark.conf.set(_DROP_SHUFFLES, "true")
        try:
            yield
        finally:
            spark.conf.set(_DROP_SHUFFLES, before)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the files.

    Unlike a cache this survives lost executors without recomputing anything, and
    later readers still prune columns and push filters down.
    """
    path = fresh_dir(df.sparkSession, f"stage-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_spare(df: DataFrame, label: str) -> DataFrame:
    """``stage`` for frames that fill disks: the files are packed harder, and the shuffles of the write go when it ends."""
    path = fresh_dir(df.sparkSession, f"stage-{label}")
    with _sparing(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_staged(spark: SparkSession) -> int:
    """Delete the session's staged frames and scratch folders, once the tables made of them are written."""
    cleared, made = 0, _made(spark)
    while made:
        folder = spark._jvm.org.apache.hadoop.fs.Path(made.pop())
        system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        cleared += bool(system.delete(folder, True))
    return cleared
