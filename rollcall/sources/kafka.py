"""Kafka source and sink. The connector package has to be on the class path;
the record formats work on any rows of the same shape."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from rollcall.functions.scalar import parse_timestamp, row_json
from rollcall.schemas import EVENT

TOPIC = "attendance-events"  # Fixed value: topic name.


def read_topic(
    spark: SparkSession,
    servers: str,
    topic: str = TOPIC,
    starting: str = "latest",
    per_trigger: int | None = None,
    fail_on_loss: bool = False,
) -> DataFrame:
    """Unparsed records of a topic as a stream."""
    settings = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_loss).lower(),
    }
    if per_trigger:
        settings["maxOffsetsPerTrigger"] = str(per_trigger)
    return spark.readStream.format("kafka").options(**settings).load()


def parse_records(records: DataFrame, schema: T.StructType = EVENT) -> DataFrame:
    """Key, JSON payload and position of each record as columns.

    The payload has an employee id of its own, so the record key is called
    ``key_employee_id``.
    """
    event = records.withColumn("_event", F.from_json(F.col("value").cast("string"), schema))
    fields = [F.col(f"_event.{name}") for name in schema.fieldNames()]
    return event.select(
        F.col("key").cast("string").alias("key_employee_id"),
        *fields,
        parse_timestamp("_event.timestamp").alias("event_ts"),
        "partition",
        "offset",
        F.col("timestamp").alias("kafka_ts"),
    )


def to_records(events: DataFrame, key: str = "employee_id") -> DataFrame:
    """(key, value): the employee as key, the whole row as JSON."""
    return events.select(F.col(key).cast("string").alias("key"), row_json(events).alias("value"))


# Delivery settings of the producer.
PRODUCER_OPTIONS = {
    "kafka.acks": "all",
    "kafka.retries": "3",
    "kafka.batch.size": "16384",
    "kafka.linger.ms": "10",
    "kafka.compression.type": "gzip",
}


def write_topic(events: DataFrame, servers: str, topic: str = TOPIC) -> None:
    """Send a batch of events, one partition per key."""
    (
        to_records(events)
        .write.format("kafka")
        .options(**PRODUCER_OPTIONS)
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )
