"""Streaming sinks.

Delivery is at least once plus idempotent writes: progress is recorded in the
checkpoint only after a micro-batch has been written, and a repeated micro-batch
replaces what its first attempt wrote. The last, partly filled batch is written too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from rollcall.operators.windows import keep_first
from rollcall.sources.files import path_exists


def _trigger(writer, interval: str | None):
    """A processing-time trigger, or with None: work off what is there and stop."""
    return writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)


def to_memory(stream: DataFrame, name: str, mode: str = "complete", interval: str | None = "5 seconds",
              checkpoint: str | None = None) -> StreamingQuery:
    """A table in driver memory, for looking at small results."""
    writer = stream.writeStream.outputMode(mode).format("memory").queryName(name)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    return _trigger(writer, interval).start()


def to_console(stream: DataFrame, mode: str = "update", interval: str | None = "10 seconds") -> StreamingQuery:
    writer = stream.writeStream.outputMode(mode).format("console").option("truncate", False)
    return _trigger(writer, interval).start()


def to_parquet(stream: DataFrame, path: str, checkpoint: str, interval: str | None = "5 seconds") -> StreamingQuery:
    """Append rows to Parquet files."""
    writer = (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return _trigger(writer, interval).start()


def for_each_batch(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
                   mode: str = "append", interval: str | None = "5 seconds") -> StreamingQuery:
    """Hand every micro-batch to ``write(batch, batch_id)``."""
    writer = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
    )
    return _trigger(writer, interval).start()


class BatchLog:
    """Rows of micro-batches in one folder per stream and batch; the row written last per key is the state.

    Writing costs the size of the batch, not of the table, and writing a batch of
    a stream again replaces its folder. Batches of other streams, or of a stream
    begun anew with another checkpoint, have folders of their own and come later
    by the time of their first writing, which is noted once and before any row. So
    a batch replayed after a failure does not pass what others wrote meanwhile.
    """

    def __init__(self, spark: SparkSession, root: str, keys: list[str], newest: list[str] | None = None):
        """``newest`` names columns whose larger value wins inside one batch."""
        self.spark, self.root, self.keys, self.newest = spark, root.rstrip("/"), keys, newest or []

    def _arrival(self, batch_id: int, stream: str) -> str:
        """When this batch was first to be written."""
        note, kind = f"{self.root}/_arrivals/{stream}-{batch_id}", "at string"
        known = self.spark.read.schema(kind).parquet(note).collect() if path_exists(self.spark, note) else []
        if known:
            return known[0]["at"]
        now = datetime.now(timezone.utc).isoformat(timespec="microseconds")
        self.spark.createDataFrame([(now,)], kind).coalesce(1).write.mode("overwrite").parquet(note)
        return now

    def write(self, batch: DataFrame, batch_id: int, stream: str = "s0") -> None:
        arrived = F.lit(self._arrival(batch_id, stream))
        batch.withColumn("_arrived", arrived).write.mode("overwrite").parquet(f"{self.root}/stream={stream}/batch={batch_id}")

    def read(self) -> DataFrame:
        """The newest row of each key."""
        if not path_exists(self.spark, self.root):
            raise ValueError(f"nothing written to {self.root}")
        rows = self.spark.read.option("basePath", self.root).parquet(self.root)
        own = ("_arrived", "stream", "batch")
        rest = [c for c in rows.columns if c not in (*self.keys, *self.newest, *own)]
        order: list[Column] = [F.desc(c) for c in ("_arrived", "batch", *self.newest, *rest)]
        return keep_first(rows, self.keys, order).drop(*own)

    def compact(self, into: str) -> "BatchLog":
        """A new log at ``into`` whose batch -1 holds the state so far."""
        folded = BatchLog(self.spark, into, self.keys, self.newest)
        folded.write(self.read(), -1)
        return folded


def stream_id(checkpoint: str) -> str:
    """A name for the stream that records its progress in ``checkpoint``."""
    return "s" + hashlib.sha256(checkpoint.encode()).hexdigest()[:16]


def upsert_events(stream: DataFrame, log: BatchLog, checkpoint: str, interval: str | None = "5 seconds") -> StreamingQuery:
    """Events into a log keyed by event id, last write wins, with the time of writing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        log.write(batch.withColumn("processed_at", F.current_timestamp()), batch_id, stream_id(checkpoint))

    return for_each_batch(stream, write, checkpoint, "append", interval)


def update_table(stream: DataFrame, log: BatchLog, checkpoint: str, interval: str | None = "5 seconds") -> StreamingQuery:
    """A running aggregate in update mode, kept as the newest row per group."""
    return for_each_batch(stream, lambda b, i: log.write(b, i, stream_id(checkpoint)), checkpoint, "update", interval)


def finish(query: StreamingQuery, seconds: int = 600) -> StreamingQuery:
    """Wait for a query that ends by itself; a failure in it is raised here."""
    if not query.awaitTermination(seconds):
        query.stop()
        raise TimeoutError(f"stream did not end within {seconds} s")
    return query
