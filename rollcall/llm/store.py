"""Rows kept in the shared folder between steps of an iteration, and deleted when the next step has its own."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from rollcall.session import shared_path
from rollcall.sources.files import delete_path


class Kept:
    """The rows of a DataFrame, written once below ``spark.checkpoint.dir``."""

    def __init__(self, df: DataFrame, purpose: str):
        self.spark, self.path = df.sparkSession, shared_path(df.sparkSession, purpose)
        df.write.parquet(self.path)
        self.rows = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        delete_path(self.spark, self.path)


def forget_shuffles(spark: SparkSession) -> None:
    """Have the shuffle files of ended jobs deleted now.

    Spark deletes them when the driver has forgotten the job's plan, which an idle
    driver does late; an operator of several large jobs would hold all of them.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextmanager
def small_batches(spark: SparkSession, size: int = 1 << 20) -> Iterator[None]:
    """Jobs that run in here send rows to Python in Arrow batches of about ``size`` bytes, not of 10,000 rows.

    Ten thousand texts are tens of MB, held by the JVM outside its heap and by the worker.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
