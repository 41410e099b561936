"""Session construction and the shared folder that jobs may write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from rollcall.sources.files import delete_path

_WRITTEN: list[str] = []


def build_session(app: str = "rollcall", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is designed for.

    Adaptive execution coalesces small shuffles and splits skewed join
    partitions; RocksDB keeps streaming state off the JVM heap.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        # sessions are merged inside each task before they are shuffled by key
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    It has to be reachable from every executor. Without the setting the folder
    set on the context is taken. Only a local-mode session that names none gets a
    temporary one; on a cluster that is an error.
    """
    root = (
        spark.conf.get("spark.checkpoint.dir", None)
        or spark.sparkContext.getCheckpointDir()
        or spark.conf.get("rollcall.local.checkpoint.dir", None)
    )
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="rollcall-")
        spark.conf.set("rollcall.local.checkpoint.dir", root)
    return root.rstrip("/")


def shared_path(spark: SparkSession, purpose: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{checkpoint_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written to the shared folder once and read from there.

    Later steps see the same rows however often a task is run, do not repeat the
    work before this point, and read only the columns they need.
    """
    path = shared_path(df.sparkSession, purpose)
    df.write.parquet(path)
    _WRITTEN.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Delete what ``written`` has left in the shared folder, once no result needs it any more."""
    count = len(_WRITTEN)
    while _WRITTEN:
        delete_path(spark, _WRITTEN.pop())
    return count
