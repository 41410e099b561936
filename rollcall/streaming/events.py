"""Event sources and per-event columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from rollcall.functions.scalar import flag, is_true, parse_timestamp, partition_number
from rollcall.operators.splits import with_position_within
from rollcall.schemas import EVENT

LATE_HOUR = 10  # Fixed value: a check-in from this hour on is late.
LATE_SECONDS = 60  # Fixed value: an event older than this on arrival is late.
COUNTED_TYPE = "CHECK_IN"  # Fixed value: event type of a check-in.


def read_event_stream(
    spark: SparkSession, folder: str, schema: T.StructType = EVENT, files_per_trigger: int | None = 1
) -> DataFrame:
    """JSON-lines files of a folder as a stream, a few files at a time."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(folder)


def enrich_events(events: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Event time, hour, check-in and lateness columns."""
    timed = events.withColumn("event_ts", parse_timestamp("timestamp"))
    return timed.withColumns(
        {
            "hour": F.hour("event_ts"),
            "is_checkin": flag(F.col("event_type") == COUNTED_TYPE),
            "is_late": is_true((F.col("event_type") == COUNTED_TYPE) & (F.hour("event_ts") >= LATE_HOUR)),
            "processed_at": processed_at if processed_at is not None else F.current_timestamp(),
        }
    )


def lag_seconds(event: str = "event_ts", processed: str = "processing_time") -> Column:
    return F.unix_micros(F.col(processed)) / 1e6 - F.unix_micros(F.col(event)) / 1e6


def late_events(events: DataFrame, seconds: float = LATE_SECONDS) -> DataFrame:
    """Events that arrived more than ``seconds`` after they happened."""
    return events.filter(lag_seconds() > seconds)


def late_event_count(events: DataFrame, seconds: float = LATE_SECONDS) -> DataFrame:
    late = F.count_if(is_true(lag_seconds() > seconds))
    return events.agg(F.count(F.lit(1)).alias("consumed"), late.alias("late_events"))


def partition_offsets(
    events: DataFrame, partitions: int, key: str = "employee_id", order: list[str] | None = None
) -> DataFrame:
    """Partition of each event by its key, and its 0-based offset there in event order.

    There are far fewer partitions than tasks, so offsets are counted in ordered
    blocks; the events of one key stay in order inside their partition.
    """
    order = order or ["event_ts", "event_id"]
    keyed = events.withColumn("partition", partition_number(key, partitions))
    placed = with_position_within(keyed, ["partition"], [F.col(c) for c in order], "offset")
    return placed.withColumn("offset", F.col("offset") - 1)


def keyed_layout(events: DataFrame, partitions: int, key: str = "employee_id", order: str = "event_ts") -> DataFrame:
    """Events of a key together in one task's output, in event order."""
    return events.repartition(partitions, F.col(key)).sortWithinPartitions(key, order)
