"""Streams over JSON files written in a chosen order, beside the same functions on a table."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from rollcall.schemas import EVENT
from rollcall.session import shared_path
from rollcall.sources.kafka import parse_records, to_records
from rollcall.streaming import events as E
from rollcall.streaming import replay, sinks, windows as T


def event(i, when, who="E1", kind="CHECK_IN", dept="People"):
    return {"event_id": f"ev{i}", "employee_id": who, "event_type": kind, "timestamp": when, "department": dept,
            "location": "Cork", "device_id": "D1", "source": "mobile", "latitude": 1.5, "longitude": 2.5}


@pytest.fixture
def folder(tmp_path):
    """Writes each list of events as one file; files are read in the order written."""
    count = iter(range(1000))

    def put(*batches):
        for batch in batches:
            n = next(count)
            path = tmp_path / f"{n:04d}.json"
            path.write_text("\n".join(json.dumps(e) for e in batch))
            import os

            os.utime(path, (1_700_000_000 + n, 1_700_000_000 + n))
        return str(tmp_path)

    return put


def appended(spark, stream, path=None):
    path = path or shared_path(spark, "test")
    sinks.finish(sinks.to_parquet(stream, f"{path}/data", f"{path}/checkpoint", None), 120)
    return spark.read.schema(stream.schema).parquet(f"{path}/data")


def test_enrichment(spark):
    rows = [event(1, "2024-01-01T09:59:59"), event(2, "2024-01-01T10:00:00"), event(3, "2024-01-01T11:00:00", kind="CHECK_OUT"),
            event(4, "soon")]
    df = E.enrich_events(spark.createDataFrame(rows, EVENT)).select("event_id", "hour", "is_checkin", "is_late")
    assert rows_of(df) == [("ev1", 9, 1, False), ("ev2", 10, 1, True), ("ev3", 11, 0, False), ("ev4", None, 1, False)]


def test_append_stream_equals_batch(spark, folder):
    path = folder([event(1, "2024-01-01T09:00:00")], [event(2, "2024-01-01T10:30:00.250"), event(3, "bad")])
    stored = appended(spark, E.enrich_events(E.read_event_stream(spark, path)))
    batch = E.enrich_events(spark.read.schema(EVENT).json(path))
    assert rows_of(stored.drop("processed_at")) == rows_of(batch.drop("processed_at"))
    assert stored.filter("processed_at IS NULL").count() == 0


def test_late_events_are_dropped_after_the_watermark(spark, folder):
    path = folder(
        [event(1, "2024-01-01T09:00:00"), event(2, "2024-01-01T09:01:00", who="E2")],
        [event(3, "2024-01-01T09:30:00")],
        [event(7, "2024-01-01T09:31:00")],  # the watermark of one batch filters the next but one
        [event(4, "2024-01-01T09:02:00"), event(5, "2024-01-01T09:26:00")],  # too late; late but in time
        [event(6, "2024-01-01T10:30:00")],
    )
    stream = E.enrich_events(E.read_event_stream(spark, path))
    got = appended(spark, T.activity_exact(stream)).orderBy("window_start").collect()
    assert [(r.window_start.strftime("%H:%M"), r.event_count, r.unique_employees) for r in got] == [
        ("09:00", 2, 2), ("09:25", 1, 1), ("09:30", 2, 1)
    ]


def test_update_mode_keeps_the_newest_count(spark, folder):
    path = folder([event(1, "2024-01-01T09:00:10")], [event(2, "2024-01-01T09:00:20")], [event(3, "2024-01-01T09:01:00", dept="IT")])
    root = shared_path(spark, "test")
    log = sinks.BatchLog(spark, f"{root}/data", ["window_start", "window_end", "department"])
    counts = T.department_counts(E.enrich_events(E.read_event_stream(spark, path)))
    sinks.finish(sinks.update_table(counts, log, f"{root}/checkpoint", None), 120)
    got = sorted((r.window_start.strftime("%H:%M"), r.department, r.events) for r in log.read().collect())
    assert got == [("09:00", "People", 2), ("09:01", "IT", 1)]
    newest = T.newest_windows(log.read(), 1).first()
    assert newest.department == "IT"
    assert rows_of(log.compact(f"{root}/folded").read()) == rows_of(log.read())


def test_stream_counts_equal_batch_counts(spark, folder):
    start = datetime(2024, 1, 1, 9)
    batches = [[event(10 * b + i, (start + timedelta(minutes=3 * b, seconds=7 * i)).isoformat(), who=f"E{i % 3}",
                      dept="People" if i % 2 else "IT") for i in range(8)] for b in range(4)]
    path = folder(*batches)
    root = shared_path(spark, "test")
    table = E.enrich_events(spark.read.schema(EVENT).json(path))
    stream = E.enrich_events(E.read_event_stream(spark, path))
    for n, (make, keys) in enumerate([
        (T.activity, ["window_start", "window_end", "department", "event_type"]),
        (T.sliding_counts, ["window_start", "window_end", "department"]),
    ]):
        log = sinks.BatchLog(spark, f"{root}/data{n}", keys)
        sinks.finish(sinks.update_table(make(stream), log, f"{root}/checkpoint{n}", None), 120)
        want = make(table, delay=None)
        assert rows_of(log.read().select(want.columns)) == rows_of(want)
    exact = {tuple(r)[:4]: r.unique_employees for r in T.activity_exact(table, delay=None).collect()}
    assert exact == {tuple(r)[:4]: r.unique_employees for r in T.activity(table, delay=None).collect()}


def test_repeated_events_are_dropped(spark, folder):
    path = folder([event(1, "2024-01-01T09:00:00"), event(1, "2024-01-01T09:00:00")], [event(1, "2024-01-01T09:00:00"), event(2, "2024-01-01T09:03:00")])
    stream = E.enrich_events(E.read_event_stream(spark, path))
    assert rows_of(appended(spark, T.drop_repeats(stream).select("event_id"))) == [("ev1",), ("ev2",)]


def test_upsert_last_write_wins_and_short_batches_are_kept(spark, folder):
    path = folder([event(1, "2024-01-01T09:00:00"), event(2, "2024-01-01T09:00:00")], [event(1, "2024-01-01T09:05:00", kind="CHECK_OUT")])
    root = shared_path(spark, "test")
    log = sinks.BatchLog(spark, f"{root}/data", ["event_id"], ["timestamp"])
    for _ in range(2):  # started again from its checkpoint it has nothing to do
        stream = E.read_event_stream(spark, path)
        sinks.finish(sinks.upsert_events(stream, log, f"{root}/checkpoint", None), 120)
    got = {r.event_id: r.event_type for r in log.read().collect()}
    assert got == {"ev1": "CHECK_OUT", "ev2": "CHECK_IN"}
    assert log.read().filter("processed_at IS NULL").count() == 0
    # new files are picked up where the first run ended
    folder([event(3, "2024-01-01T09:06:00")])
    sinks.finish(sinks.upsert_events(E.read_event_stream(spark, path), log, f"{root}/checkpoint", None), 120)
    assert log.read().count() == 3


def test_a_repeated_batch_replaces_the_first_attempt(spark):
    log = sinks.BatchLog(spark, shared_path(spark, "test"), ["k"])
    log.write(spark.createDataFrame([(1, "half")], "k int, v string"), 0)
    log.write(spark.createDataFrame([(1, "all"), (2, "all")], "k int, v string"), 0)
    assert rows_of(log.read()) == [(1, "all"), (2, "all")]


def test_a_replayed_batch_keeps_its_place(spark):
    log = sinks.BatchLog(spark, shared_path(spark, "test"), ["k"])
    log.write(spark.createDataFrame([(1, "a"), (2, "a")], "k int, v string"), 5, "sa")
    log.write(spark.createDataFrame([(1, "b")], "k int, v string"), 0, "sb")
    log.write(spark.createDataFrame([(1, "a"), (2, "a"), (3, "a")], "k int, v string"), 5, "sa")
    assert rows_of(log.read()) == [(1, "b"), (2, "a"), (3, "a")]
    log.write(spark.createDataFrame([(1, "c")], "k int, v string"), 6, "sa")
    assert (1, "c") in rows_of(log.read())


def test_sessions_stream(spark, folder):
    path = folder(
        [event(1, "2024-01-01T09:00:00"), event(2, "2024-01-01T09:20:00")],
        [event(3, "2024-01-01T09:49:59"), event(4, "2024-01-01T10:20:00")],
        [event(5, "2024-01-01T13:00:00")],
    )
    got = appended(spark, T.sessions(E.enrich_events(E.read_event_stream(spark, path)))).orderBy("window_start").collect()
    assert [(r.events, r.window_start.strftime("%H:%M"), r.window_end.strftime("%H:%M:%S")) for r in got] == [
        (3, "09:00", "10:19:59"), (1, "10:20", "10:50:00")
    ]


def test_memory_and_console_sinks(spark, folder):
    path = folder([event(1, "2024-01-01T09:00:00"), event(2, "2024-01-01T09:01:00")])
    counts = T.department_counts(E.enrich_events(E.read_event_stream(spark, path)), "5 minutes", "10 minutes")
    query = sinks.to_memory(counts, "live_counts", "complete", "1 second")
    query.processAllAvailable()
    query.stop()
    assert spark.table("live_counts").first().events == 2
    sinks.finish(sinks.to_console(counts, "update", None), 120)


def test_record_round_trip(spark):
    events = spark.createDataFrame([event(1, "2024-01-01T09:00:00"), event(2, "later", who=None)], EVENT)
    records = to_records(events).selectExpr(
        "CAST(key AS BINARY) AS key", "CAST(value AS BINARY) AS value", "current_timestamp() AS timestamp", "1 AS partition", "7L AS offset"
    )
    parsed = parse_records(records)
    assert "key_employee_id" in parsed.columns and parsed.columns.count("employee_id") == 1
    assert rows_of(parsed.select(events.columns)) == rows_of(events)
    broken = records.limit(1).withColumn("value", F.lit("{").cast("binary"))
    assert parse_records(broken).first().event_id is None


def test_late_count(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 1, 9), datetime(2024, 1, 1, 9, 1)), (datetime(2024, 1, 1, 9), datetime(2024, 1, 1, 9, 1, 0, 1)), (None, datetime(2024, 1, 1))],
        "event_ts timestamp, processing_time timestamp",
    )
    assert tuple(E.late_event_count(df).first()) == (3, 1)
    assert E.late_events(df).count() == 1


def test_keyed_layout_keeps_an_employee_in_one_task(spark):
    df = spark.createDataFrame([(f"E{i % 7}", i) for i in range(100)], "employee_id string, event_ts int").repartition(5)
    placed = E.keyed_layout(df, 3).withColumn("task", F.spark_partition_id())
    assert placed.groupBy("employee_id").agg(F.count_distinct("task").alias("n")).filter("n > 1").count() == 0


def check_ins(spark, n, minutes=1):
    """One check-in a minute from nine o'clock, arriving ten seconds later."""
    start = datetime(2024, 1, 1, 9)
    rows = [(f"ev{i}", f"E{i % 5}", "CHECK_IN", "People", start + timedelta(minutes=minutes * i),
             start + timedelta(minutes=minutes * i, seconds=10)) for i in range(n)]
    return spark.createDataFrame(
        rows, "event_id string, employee_id string, event_type string, department string, event_ts timestamp, processing_time timestamp")


def test_watermark_moves_over_replayed_batches(spark, tmp_path):
    events = check_ins(spark, 60)
    # six batches of ten minutes; minute 3 comes with the fourth, when its window has long been closed
    number = F.when(F.col("event_id") == "ev3", 3).otherwise(replay.time_slice(events, 6))
    stream = replay.replayed(events, number, 6, f"{tmp_path}/in")
    counts = T.department_counts(stream, "5 minutes", "5 minutes")
    done = sinks.finish(sinks.to_parquet(counts, f"{tmp_path}/out", f"{tmp_path}/checkpoint", interval=None))
    got = {r.window_start.minute: r.events for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {0: 4, **dict.fromkeys(range(5, 50, 5), 5)}
    steps = replay.progress(done).orderBy("batch_id").collect()
    assert [r.rows_in for r in steps[:6]] == [9, 10, 10, 11, 10, 10] and [r.groups_late for r in steps[:6]] == [0, 0, 0, 1, 0, 0]


def test_arrival_windows_keep_bounded_state(spark, tmp_path):
    events = check_ins(spark, 400)
    stream = replay.replayed(events, replay.time_slice(events, 20), 20, f"{tmp_path}/in")
    counts = T.processing_time_counts(stream, delay="1 minute")
    done = sinks.finish(sinks.to_parquet(counts, f"{tmp_path}/out", f"{tmp_path}/checkpoint", interval=None))
    steps = replay.progress(done).filter("rows_in > 0").collect()
    assert len(steps) == 20 and max(r.groups_held for r in steps) <= 42  # two batches of twenty windows
    assert spark.read.parquet(f"{tmp_path}/out").count() == 398


def test_slices_of_nothing_and_of_rows_without_a_time(spark, tmp_path):
    none = check_ins(spark, 5).limit(0)
    stream = replay.replayed(none, replay.time_slice(none, 3), 3, f"{tmp_path}/none")
    done = sinks.finish(sinks.to_parquet(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint", interval=None))
    assert replay.progress(done).filter("rows_in > 0").count() == 0
    timeless = check_ins(spark, 5).unionByName(check_ins(spark, 1).withColumn("event_ts", F.lit(None).cast("timestamp")))
    with pytest.raises(Exception, match="belongs to no slice"):
        replay.write_slices(timeless, replay.time_slice(timeless, 3), 3, f"{tmp_path}/timeless")


def test_slices_are_read_once_and_written_by_several_tasks(spark, tmp_path):
    """Each slice is one micro-batch of several files, also where it has fewer rows than files."""
    events, seen = check_ins(spark, 90), spark.sparkContext.accumulator(0)

    def passed(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    number = F.when(F.col("event_ts") < "2024-01-01 09:02:00", 1).otherwise(replay.time_slice(events, 3) + 1)
    replay.write_slices(events.mapInArrow(passed, events.schema), number, 4, f"{tmp_path}/in", 3)
    assert seen.value == 90 and len(spark.read.parquet(f"{tmp_path}/in").inputFiles()) >= 12
    files = spark.read.parquet(f"{tmp_path}/in").groupBy(F.input_file_name().alias("f")).count().count()
    assert files == 9
    stream = replay.read_slices(spark, events.schema, f"{tmp_path}/in", 3)
    done = sinks.finish(sinks.to_parquet(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint", interval=None))
    steps = {r.batch_id: r.rows_in for r in replay.progress(done).filter("rows_in > 0").collect()}
    assert steps == {1: 30, 2: 30, 3: 30} and spark.read.parquet(f"{tmp_path}/out").distinct().count() == 90


def test_sketches_merge_to_longer_windows(spark):
    events = check_ins(spark, 120).unionByName(check_ins(spark, 120).withColumn("event_type", F.lit("CHECK_OUT")))
    stored = T.activity_sketches(events, delay=None)
    hours = T.merge_sketches(stored, "1 hour", ("department",)).collect()
    assert sorted((r.window_start.hour, r.event_count, r.unique_employees) for r in hours) == [(9, 120, 5), (10, 120, 5)]
    assert [tuple(r) for r in T.merge_sketches(stored, None, ()).collect()] == [(240, 5)]
    many = spark.range(50_000).selectExpr(
        "timestamp'2024-01-01' + make_interval(0, 0, 0, 0, 0, id % 1440) AS event_ts", "cast(id % 20000 AS string) AS employee_id",
        "'A' AS event_type", "'People' AS department")
    day = T.merge_sketches(T.activity_sketches(many, delay=None), "1 day").first()
    assert day.event_count == 50_000 and abs(day.unique_employees - 20_000) < 1_000
