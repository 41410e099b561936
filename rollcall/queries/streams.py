"""Queries that run as real streams over the events table and return the final table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollcall.operators.aggregates import rows, value_counts
from rollcall.queries import views as V
from rollcall.queries.common import wall_time
from rollcall.queries.registry import query
from rollcall.session import shared_path
from rollcall.sources.kafka import parse_records, to_records
from rollcall.streaming import events as E
from rollcall.streaming import replay, sinks, windows as T


def _event_stream(spark: SparkSession, d: str) -> DataFrame:
    """The events table as a stream of check-in events."""
    schema = V.table(spark, d, "events").schema
    # the file source takes a folder or a pattern; the pattern fits this one table
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{d}/events.parque[t]")
    return V.events_to_ev(raw)


def _appended(spark: SparkSession, stream: DataFrame) -> DataFrame:
    path = shared_path(spark, "stream")
    sinks.finish(sinks.to_parquet(stream, f"{path}/data", f"{path}/checkpoint", interval=None))
    return spark.read.schema(stream.schema).parquet(f"{path}/data")


def _updated(spark: SparkSession, stream: DataFrame, keys: list[str]) -> DataFrame:
    path = shared_path(spark, "stream")
    log = sinks.BatchLog(spark, f"{path}/data", keys)
    sinks.finish(sinks.update_table(stream, log, f"{path}/checkpoint", interval=None))
    return log.read()


SLICES = 6


def _replayed(spark: SparkSession, d: str, held: int = 0) -> DataFrame:
    """The events as a stream of ``SLICES`` micro-batches by time; of those that took a multiple of
    seven seconds to arrive, each comes ``held`` micro-batches later (at the latest in the last)."""
    events = V.ev(spark, d)
    number = replay.time_slice(events, SLICES)
    lag = F.floor((F.unix_micros("processing_time") - F.unix_micros("event_ts")) / 1_000_000)
    late = F.least(number + F.when(lag % 7 == 0, held).otherwise(0), F.lit(SLICES - 1))
    return replay.replayed(events, late, SLICES, f"{shared_path(spark, 'replay')}/in")


# the same slices; a row is left out if its window had ended at the watermark of the micro-batch before the last one
_SLICES = f"""
    s AS (SELECT *, CAST(floor((epoch_us(event_ts) - lo) / ((hi - lo + 1) / {SLICES}.0)) AS INTEGER) AS slice,
                 time_bucket(INTERVAL 1 HOUR, event_ts) AS window_start
          FROM ev, (SELECT min(epoch_us(event_ts)) AS lo, max(epoch_us(event_ts)) AS hi FROM ev) span),
    b AS (SELECT *, least({SLICES - 1}, slice + CASE WHEN floor((epoch_us(processing_time) - epoch_us(event_ts)) / 1000000) % 7 = 0
                                                THEN 2 ELSE 0 END) AS batch FROM s),
    marks AS (SELECT n.batch, max(b.event_ts) - INTERVAL 10 MINUTE AS mark
              FROM (SELECT DISTINCT batch FROM b) n JOIN b ON b.batch <= n.batch - 2 GROUP BY n.batch),
    r AS (SELECT b.*, coalesce(window_start + INTERVAL 1 HOUR <= mark, false) AS late FROM b LEFT JOIN marks USING (batch))"""


_PLAIN = ["event_id", "employee_id", "event_type", "timestamp", "department"]


@query(
    "t01_enrich",
    """SELECT event_id, employee_id, event_type, timestamp, department, event_ts, hour(event_ts) AS hour,
              CASE WHEN event_type = 'CHECK_IN' THEN 1 ELSE 0 END AS is_checkin,
              event_type = 'CHECK_IN' AND hour(event_ts) >= 10 AS is_late FROM ev""",
)
def t01(spark: SparkSession, d: str) -> DataFrame:
    enriched = E.enrich_events(V.ev(spark, d).select(*_PLAIN))
    return wall_time(enriched.drop("processed_at"), "event_ts")


_EXACT = """
    SELECT time_bucket(INTERVAL 5 MINUTE, event_ts) AS window_start,
           time_bucket(INTERVAL 5 MINUTE, event_ts) + INTERVAL 5 MINUTE AS window_end, department, event_type,
           count(*) AS event_count, count(DISTINCT employee_id) AS unique_employees FROM ev GROUP BY ALL"""


@query("t02_activity_exact", _EXACT)
def t02(spark: SparkSession, d: str) -> DataFrame:
    return wall_time(T.activity_exact(V.ev(spark, d), delay=None), "window_start", "window_end")


@query(
    "t02_activity_exact_stream",
    f"""SELECT * FROM ({_EXACT}) WHERE window_end <= (SELECT max(event_ts) - INTERVAL 10 MINUTE FROM ev)""",
)
def t02b(spark: SparkSession, d: str) -> DataFrame:
    # append mode: the windows that the watermark has closed
    return wall_time(_appended(spark, T.activity_exact(_event_stream(spark, d))), "window_start", "window_end")


@query("t02_activity_stream")
def t02c(spark: SparkSession, d: str) -> DataFrame:
    keys = ["window_start", "window_end", "department", "event_type"]
    return wall_time(_updated(spark, T.activity(_event_stream(spark, d)), keys), "window_start", "window_end")


def _stored_sketches(spark: SparkSession, d: str) -> DataFrame:
    """Sketches of five-minute windows as the stream stored them: the newest of each window."""
    keys = ["window_start", "window_end", "department", "event_type"]
    return _updated(spark, T.activity_sketches(_event_stream(spark, d)), keys)


def _near(sketched: DataFrame, exact: DataFrame, keys: list[str]) -> DataFrame:
    """Whether the sketched count is within five percent (or one) of the exact one, with the exact figures."""
    off = F.abs(F.col("unique_employees") - F.col("employees"))
    return exact.join(sketched, keys).select(
        *keys, "event_count", "employees", (off <= F.greatest(0.05 * F.col("employees"), F.lit(1.0))).alias("within_five_percent"))


@query(
    "t02_sketched_windows_stream",
    f"""SELECT window_start, window_end, department, event_type, event_count, unique_employees AS employees,
               true AS within_five_percent FROM ({_EXACT})""",
)
def t02d(spark: SparkSession, d: str) -> DataFrame:
    keys = ["window_start", "window_end", "department", "event_type"]
    exact = T.activity_exact(V.ev(spark, d), delay=None).withColumnRenamed("unique_employees", "employees").drop("event_count")
    estimates = _stored_sketches(spark, d).withColumn("unique_employees", F.hll_sketch_estimate("employees")).drop("employees")
    return wall_time(_near(estimates, exact, keys), "window_start", "window_end")


@query(
    "t02_merged_days_stream",
    """SELECT date_trunc('day', event_ts)::TIMESTAMP AS window_start, date_trunc('day', event_ts)::TIMESTAMP + INTERVAL 1 DAY AS window_end,
              department, count(*) AS event_count, count(DISTINCT employee_id) AS employees, true AS within_five_percent
       FROM ev GROUP BY ALL""",
)
def t02e(spark: SparkSession, d: str) -> DataFrame:
    keys = ["window_start", "window_end", "department"]
    merged = T.merge_sketches(_stored_sketches(spark, d), "1 day", ("department",))
    exact = T.activity_exact(V.ev(spark, d).withColumn("event_type", F.lit("")), "1 day", None)
    exact = exact.withColumnRenamed("unique_employees", "employees").drop("event_type", "event_count")
    return wall_time(_near(merged, exact, keys), "window_start", "window_end")


@query(
    "t03_department_counts_stream",
    """SELECT time_bucket(INTERVAL 1 MINUTE, event_ts) AS window_start,
              time_bucket(INTERVAL 1 MINUTE, event_ts) + INTERVAL 1 MINUTE AS window_end, department,
              count(*) AS events FROM ev GROUP BY ALL""",
)
def t03(spark: SparkSession, d: str) -> DataFrame:
    keys = ["window_start", "window_end", "department"]
    return wall_time(_updated(spark, T.department_counts(_event_stream(spark, d)), keys), "window_start", "window_end")


@query(
    "t04_append_raw_stream",
    """SELECT event_id, employee_id, event_type, timestamp, department, event_ts, hour(event_ts) AS hour,
              CASE WHEN event_type = 'CHECK_IN' THEN 1 ELSE 0 END AS is_checkin,
              event_type = 'CHECK_IN' AND hour(event_ts) >= 10 AS is_late FROM ev""",
)
def t04(spark: SparkSession, d: str) -> DataFrame:
    enriched = E.enrich_events(_event_stream(spark, d).select(*_PLAIN))
    return wall_time(_appended(spark, enriched).drop("processed_at"), "event_ts")


@query(
    "s14_records_stream",
    "SELECT employee_id AS key_employee_id, event_id, employee_id, event_type, department, event_ts FROM ev",
)
def s14(spark: SparkSession, d: str) -> DataFrame:
    plain = _event_stream(spark, d).select(*_PLAIN)
    records = to_records(plain).withColumns(
        {"timestamp": F.current_timestamp(), "partition": F.lit(0), "offset": F.lit(0).cast("bigint")}
    )
    parsed = parse_records(records).select(
        "key_employee_id", "event_id", "employee_id", "event_type", "department", "event_ts"
    )
    return wall_time(_appended(spark, parsed), "event_ts")


@query(
    "s15_to_records",
    """SELECT employee_id AS key, '{"event_id":"' || event_id || '","employee_id":"' || employee_id
              || '","event_type":"' || event_type || '"}' AS value FROM ev""",
)
def s15(spark: SparkSession, d: str) -> DataFrame:
    return to_records(V.ev(spark, d).select("event_id", "employee_id", "event_type"))


@query(
    "t06_late_events",
    """SELECT count(*) AS consumed, count(*) FILTER (processing_time - event_ts > INTERVAL 60 SECOND) AS late_events FROM ev""",
)
def t06(spark: SparkSession, d: str) -> DataFrame:
    return E.late_event_count(V.ev(spark, d))


@query(
    "t06_late_events_stream",
    "SELECT event_id, department FROM ev WHERE processing_time - event_ts > INTERVAL 60 SECOND",
)
def t06b(spark: SparkSession, d: str) -> DataFrame:
    return _appended(spark, E.late_events(_event_stream(spark, d)).select("event_id", "department"))


@query(
    "t07_processing_time_counts",
    """SELECT time_bucket(INTERVAL 10 SECOND, processing_time) AS window_start,
              time_bucket(INTERVAL 10 SECOND, processing_time) + INTERVAL 10 SECOND AS window_end,
              department || ':' || event_type AS key, count(*) AS events FROM ev GROUP BY ALL""",
)
def t07(spark: SparkSession, d: str) -> DataFrame:
    return wall_time(T.processing_time_counts(V.ev(spark, d)), "window_start", "window_end")


@query(
    "t08_sliding_counts",
    """SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, department, count(*) AS events
       FROM (SELECT department, time_bucket(INTERVAL 1 MINUTE, event_ts) - to_minutes(i) AS window_start
             FROM ev, (SELECT unnest([0, 1, 2, 3, 4]) AS i) m) GROUP BY ALL""",
)
def t08(spark: SparkSession, d: str) -> DataFrame:
    return wall_time(T.sliding_counts(V.ev(spark, d), delay=None), "window_start", "window_end")


_SESSIONS = """
    WITH m AS (SELECT *, CASE WHEN event_ts - lag(event_ts) OVER w <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh
               FROM ev WINDOW w AS (PARTITION BY employee_id ORDER BY event_ts, event_id)),
         s AS (SELECT *, sum(fresh) OVER (PARTITION BY employee_id ORDER BY event_ts, event_id) AS n FROM m)
    SELECT min(event_ts) AS window_start, max(event_ts) + INTERVAL 30 MINUTE AS window_end, employee_id,
           count(*) AS events FROM s GROUP BY employee_id, n"""


@query("t09_sessions", _SESSIONS)
def t09(spark: SparkSession, d: str) -> DataFrame:
    return wall_time(T.session_table(V.ev(spark, d)), "window_start", "window_end")


@query(
    "t09_sessions_stream",
    f"SELECT * FROM ({_SESSIONS}) WHERE window_end <= (SELECT max(event_ts) - INTERVAL 10 MINUTE FROM ev)",
)
def t09b(spark: SparkSession, d: str) -> DataFrame:
    return wall_time(_appended(spark, T.sessions(_event_stream(spark, d))), "window_start", "window_end")


@query(
    "t10_closed_windows_stream",
    """SELECT * FROM (SELECT time_bucket(INTERVAL 5 MINUTE, event_ts) AS window_start,
              time_bucket(INTERVAL 5 MINUTE, event_ts) + INTERVAL 5 MINUTE AS window_end, department, count(*) AS events
       FROM ev GROUP BY ALL) WHERE window_end <= (SELECT max(event_ts) - INTERVAL 10 MINUTE FROM ev)""",
)
def t10(spark: SparkSession, d: str) -> DataFrame:
    counts = T.department_counts(_event_stream(spark, d), "5 minutes", "10 minutes")
    return wall_time(_appended(spark, counts), "window_start", "window_end")


@query(
    "t10_late_rows_stream",
    f"""WITH {_SLICES}
    SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, department, count(*) AS events FROM r WHERE NOT late
    AND window_start + INTERVAL 1 HOUR <= (SELECT max(event_ts) - INTERVAL 10 MINUTE FROM ev) GROUP BY ALL""",
)
def t10b(spark: SparkSession, d: str) -> DataFrame:
    counts = T.department_counts(_replayed(spark, d, held=2), "1 hour", "10 minutes")
    return wall_time(_appended(spark, counts), "window_start", "window_end")


@query(
    "t10_replay_progress",
    f"""WITH {_SLICES}
    SELECT CAST(batch AS BIGINT) AS batch_id, count(*) AS rows_in,
           count(DISTINCT (window_start, department)) FILTER (late) AS groups_late FROM r GROUP BY batch""",
)
def t10c(spark: SparkSession, d: str) -> DataFrame:
    counts = T.department_counts(_replayed(spark, d, held=2), "1 hour", "10 minutes")
    path = shared_path(spark, "stream")
    done = sinks.finish(sinks.to_parquet(counts, f"{path}/data", f"{path}/checkpoint", interval=None))
    return replay.progress(done).filter("rows_in > 0").select("batch_id", "rows_in", "groups_late")


@query(
    "t07_arrival_windows_stream",
    """SELECT * FROM (SELECT time_bucket(INTERVAL 10 SECOND, processing_time) AS window_start,
              time_bucket(INTERVAL 10 SECOND, processing_time) + INTERVAL 10 SECOND AS window_end,
              department || ':' || event_type AS key, count(*) AS events FROM ev GROUP BY ALL)
       WHERE window_end <= (SELECT max(processing_time) - INTERVAL 10 MINUTE FROM ev)""",
)
def t07b(spark: SparkSession, d: str) -> DataFrame:
    counts = T.processing_time_counts(_replayed(spark, d), delay="10 minutes")
    return wall_time(_appended(spark, counts), "window_start", "window_end")


@query("t11_drop_repeats_stream", "SELECT event_id, employee_id, event_type FROM ev")
def t11(spark: SparkSession, d: str) -> DataFrame:
    twice = _event_stream(spark, d).unionByName(_event_stream(spark, d))
    return _appended(spark, T.drop_repeats(twice).select("event_id", "employee_id", "event_type"))


@query("t11_repeats_of_the_batch_before", "SELECT event_id, employee_id, event_type FROM ev")
def t11b(spark: SparkSession, d: str) -> DataFrame:
    events = V.ev(spark, d)
    # every event comes again in the micro-batch after its own
    number = replay.time_slice(events, SLICES)
    twice = events.withColumn("at", number).unionByName(events.withColumn("at", number + 1))
    stream = replay.replayed(twice, F.col("at"), SLICES + 1, f"{shared_path(spark, 'replay')}/in")
    return _appended(spark, T.drop_repeats(stream).select("event_id", "employee_id", "event_type"))


@query(
    "s19_upsert_events_stream",
    """SELECT event_id, employee_id, event_type, timestamp,
              CASE WHEN department = 'Research' THEN department ELSE upper(department) END AS department, true AS stamped
       FROM ev""",
)
def s19(spark: SparkSession, d: str) -> DataFrame:
    path = shared_path(spark, "upsert")
    log = sinks.BatchLog(spark, f"{path}/data", ["event_id"], ["timestamp"])
    stream = _event_stream(spark, d).select(*_PLAIN)
    upper = stream.withColumn("department", F.upper("department"))
    sinks.finish(sinks.upsert_events(upper, log, f"{path}/first", interval=None))
    # another stream with a checkpoint of its own, also from batch 0: its rows win, the others stay
    again = stream.filter("department = 'Research'")
    sinks.finish(sinks.upsert_events(again, log, f"{path}/second", interval=None))
    # the first stream's batch is replayed after a failure: it keeps its place before the second stream's
    first = V.ev(spark, d).select(*_PLAIN).withColumns(
        {"department": F.upper("department"), "processed_at": F.current_timestamp()})
    log.write(first, 0, sinks.stream_id(f"{path}/first"))
    return log.read().withColumn("stamped", F.col("processed_at").isNotNull()).drop("processed_at")


@query("t12_every_batch_committed", "SELECT department, count(*) AS stored FROM ev GROUP BY department")
def t12(spark: SparkSession, d: str) -> DataFrame:
    path = shared_path(spark, "commit")
    log = sinks.BatchLog(spark, f"{path}/data", ["event_id"])
    stream = _event_stream(spark, d).select("event_id", "department")
    sinks.finish(sinks.for_each_batch(stream, log.write, f"{path}/checkpoint", interval=None))
    # started again from the checkpoint: nothing is left to do
    sinks.finish(sinks.for_each_batch(stream, log.write, f"{path}/checkpoint", interval=None))
    return log.read().groupBy("department").agg(rows().alias("stored"))


@query(
    "t13_newest_windows",
    """SELECT time_bucket(INTERVAL 5 MINUTE, event_ts) AS window_start,
              time_bucket(INTERVAL 5 MINUTE, event_ts) + INTERVAL 5 MINUTE AS window_end, department, count(*) AS events
       FROM ev GROUP BY ALL ORDER BY window_start DESC, department LIMIT 20""",
)
def t13(spark: SparkSession, d: str) -> DataFrame:
    counts = T.department_counts(_event_stream(spark, d), "5 minutes", "10 minutes")
    state = _updated(spark, counts, ["window_start", "window_end", "department"])
    return wall_time(T.newest_windows(state), "window_start", "window_end")


@query(
    "t14_keyed_order",
    """SELECT employee_id, CAST(('0x' || substr(md5(employee_id), 1, 8))::BIGINT % 3 AS INTEGER) AS partition,
              1 AS partitions, true AS in_order, count(*) AS events FROM ev GROUP BY employee_id""",
)
def t14(spark: SparkSession, d: str) -> DataFrame:
    placed = E.partition_offsets(V.ev(spark, d).select("event_id", "employee_id", "event_ts"), 3)
    # in order: the earliest and the latest event have the smallest and the largest offset
    first = F.min(F.struct("event_ts", "event_id", "offset"))["offset"] == F.min("offset")
    last = F.max(F.struct("event_ts", "event_id", "offset"))["offset"] == F.max("offset")
    return placed.groupBy("employee_id").agg(
        F.min("partition").alias("partition"),
        (F.max("partition") - F.min("partition") + 1).alias("partitions"),
        (first & last).alias("in_order"),
        rows().alias("events"),
    )


@query(
    "t14_keyed_layout",
    "SELECT employee_id, 1 AS tasks, true AS in_order, count(*) AS events FROM ev GROUP BY employee_id",
)
def t14_layout(spark: SparkSession, d: str) -> DataFrame:
    # the layout itself: a key lies in one task, and every event after the key's one before
    laid = E.keyed_layout(V.ev(spark, d).select("event_id", "employee_id", "event_ts"), 3)
    placed = laid.withColumns({"task": F.spark_partition_id(), "place": F.monotonically_increasing_id()})
    by_place, by_time = F.struct("place", "event_ts"), F.struct("event_ts", "place")
    first = F.min(by_place)["event_ts"].eqNullSafe(F.min(by_time)["event_ts"])
    last = F.max(by_place)["event_ts"].eqNullSafe(F.max(by_time)["event_ts"])
    return placed.groupBy("employee_id").agg(
        F.count_distinct("task").cast("int").alias("tasks"), (first & last).alias("in_order"), rows().alias("events")
    )


@query("t15_event_types", "SELECT event_type, count(*) AS count FROM ev GROUP BY event_type")
def t15(spark: SparkSession, d: str) -> DataFrame:
    return value_counts(V.ev(spark, d), "event_type", by_name=True)


@query("s13_json_stream", "SELECT department, event_type, count(*) AS events FROM ev GROUP BY ALL")
def s13(spark: SparkSession, d: str) -> DataFrame:
    path = shared_path(spark, "jsonstream")
    events = V.ev(spark, d).select(*_PLAIN)
    events.repartition(4, "event_id").write.json(f"{path}/in")
    stream = E.enrich_events(E.read_event_stream(spark, f"{path}/in"))
    stored = _appended(spark, stream.select("department", "event_type", "event_ts"))
    return stored.groupBy("department", "event_type").agg(rows().alias("events"))
