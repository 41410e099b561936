"""Stored events as a stream of several micro-batches in a given order, and what each micro-batch did."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from rollcall.sources.files import delete_path


def time_slice(events: DataFrame, slices: int, time: str = "event_ts") -> Column:
    """Number of the equal part of the events' time span, from 0, that a row lies in; null without a time.

    One narrow scan finds the span, one row of it reaches the driver.
    """
    low, high = events.agg(F.min(F.unix_micros(time)), F.max(F.unix_micros(time))).first()
    if low is None:
        return F.lit(None).cast("int")
    return F.floor((F.unix_micros(time) - F.lit(low)) / F.lit((high - low + 1) / slices)).cast("int")


def write_slices(events: DataFrame, number: Column, slices: int, path: str, files: int = 1) -> None:
    """Slice after slice of the events as ``files`` Parquet files each, so that later slices are newer files.

    The events are read once and laid out by slice; each slice is then written by
    ``files`` tasks. Files without rows make up for tasks that got none. Rows whose
    number is null or not below ``slices`` are refused when they are laid out.
    """
    spark, parts = events.sparkSession, f"{path.rstrip('/')}-parts"
    placed = events.withColumn("_slice", F.when(
        number.between(0, slices - 1), number).otherwise(F.raise_error(F.lit("a row belongs to no slice"))).cast("int"))
    placed.write.partitionBy("_slice").parquet(parts)
    laid = spark.read.schema(placed.schema).parquet(parts)
    none = spark.createDataFrame([], events.schema)
    for k in range(slices):
        laid.filter(F.col("_slice") == k).drop("_slice").repartition(files).write.mode("append").parquet(path)
        for _ in range((k + 1) * files - len(spark.read.schema(events.schema).parquet(path).inputFiles())):
            none.repartition(1).write.mode("append").parquet(path)
    delete_path(spark, parts)


def read_slices(spark: SparkSession, schema, path: str, files: int = 1) -> DataFrame:
    """The written slices as a stream, oldest first, one slice a micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def replayed(events: DataFrame, number: Column, slices: int, path: str, files: int | None = None) -> DataFrame:
    """A stream with one micro-batch per slice of stored events; by default a file of a slice for each task that runs at a time."""
    files = files or events.sparkSession.sparkContext.defaultParallelism
    write_slices(events, number, slices, path, files)
    return read_slices(events.sparkSession, events.schema, path, files)


PROGRESS = "batch_id long, rows_in long, groups_updated long, groups_late long, groups_held long"


def progress(query: StreamingQuery) -> DataFrame:
    """One row per micro-batch of a query that the session remembers.

    ``groups_late`` counts the groups of that batch's rows behind the watermark, which
    were left out; ``groups_held`` those in state after it. The session keeps the
    last ``spark.sql.streaming.numRecentProgressUpdates`` batches (100 by default).
    """
    rows = []
    for p in query.recentProgress:
        state = p["stateOperators"]
        rows.append((p["batchId"], p["numInputRows"], *(
            sum(s[figure] for s in state) for figure in ("numRowsUpdated", "numRowsDroppedByWatermark", "numRowsTotal"))))
    return SparkSession.active().createDataFrame(rows, PROGRESS)
