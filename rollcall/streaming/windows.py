"""Windowed counts over event time or processing time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def _flat(df: DataFrame) -> DataFrame:
    """Window start and end as two columns in front."""
    rest = [c for c in df.columns if c != "window"]
    return df.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest)


def _watermarked(events: DataFrame, time: str, delay: str | None) -> DataFrame:
    return events.withWatermark(time, delay) if delay else events


def activity(
    events: DataFrame, width: str = "5 minutes", delay: str | None = "10 minutes", time: str = "event_ts"
) -> DataFrame:
    """Events and approximate distinct employees per window, department and type.

    An exact distinct count cannot run in one step on a stream; see ``activity_exact``.
    """
    counted = _watermarked(events, time, delay).groupBy(F.window(time, width), "department", "event_type")
    return _flat(
        counted.agg(
            F.count(F.lit(1)).alias("event_count"),
            F.approx_count_distinct("employee_id").alias("unique_employees"),
        )
    )


def activity_sketches(
    events: DataFrame, width: str = "5 minutes", delay: str | None = "10 minutes", time: str = "event_ts", log2_size: int = 12
) -> DataFrame:
    """Events and a distinct-count sketch of the employees per window, department and type, to be stored.

    Sketches of windows can be merged, which their counts cannot. One has at most
    2**log2_size counters (a standard error of about 1.04 / 2**(log2_size / 2)), however
    many employees there are. Null employees are not counted.
    """
    counted = _watermarked(events, time, delay).groupBy(F.window(time, width), "department", "event_type")
    return _flat(counted.agg(
        F.count(F.lit(1)).alias("event_count"), F.hll_sketch_agg("employee_id", log2_size).alias("employees")))


def merge_sketches(sketches: DataFrame, width: str | None = None, keys: tuple[str, ...] = ("department", "event_type")) -> DataFrame:
    """Events and distinct employees of longer windows, or of other groups, from stored sketches alone.

    ``width`` has to be a multiple of the stored windows' width; None takes all
    windows together. Keys left out are merged over.
    """
    groups = [F.col(k) for k in keys]
    if width:
        groups = [F.window("window_start", width), *groups]
    merged = sketches.groupBy(*groups).agg(
        F.sum("event_count").alias("event_count"), F.hll_sketch_estimate(F.hll_union_agg("employees")).alias("unique_employees"))
    return _flat(merged) if width else merged


def activity_exact(
    events: DataFrame, width: str = "5 minutes", delay: str | None = "10 minutes", time: str = "event_ts"
) -> DataFrame:
    """The same with an exact distinct count, for append mode.

    Counts per employee first and then adds up, so a department in which very
    much happens is spread over its employees before it is brought together.
    """
    per_employee = (
        _watermarked(events, time, delay)
        .groupBy(F.window(time, width), "department", "event_type", "employee_id")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return _flat(
        per_employee.groupBy("window", "department", "event_type").agg(
            F.sum("_n").alias("event_count"), F.count("employee_id").alias("unique_employees")
        )
    )


def department_counts(
    events: DataFrame, width: str = "1 minute", delay: str | None = "2 minutes", time: str = "event_ts"
) -> DataFrame:
    """Events per tumbling window and department."""
    counted = _watermarked(events, time, delay).groupBy(F.window(time, width), "department")
    return _flat(counted.agg(F.count(F.lit(1)).alias("events")))


def sliding_counts(
    events: DataFrame,
    width: str = "5 minutes",
    slide: str = "1 minute",
    delay: str | None = "10 minutes",
    time: str = "event_ts",
) -> DataFrame:
    """Events per overlapping window and department."""
    counted = _watermarked(events, time, delay).groupBy(F.window(time, width, slide), "department")
    return _flat(counted.agg(F.count(F.lit(1)).alias("events")))


def session_table(
    events: DataFrame, gap_minutes: int = 30, time: str = "event_ts", key: str = "employee_id"
) -> DataFrame:
    """The sessions of a stored table, like ``sessions`` but for keys with any number of events.

    Events of a key in the same minute always belong together, so they are reduced
    to one row per minute before the shuffle; the window sorts at most 1,440 rows
    per key and day.
    """
    minutes = events.groupBy(F.col(key), F.date_trunc("minute", time).alias("_minute")).agg(
        F.min(time).alias("_first"), F.max(time).alias("_last"), F.count(F.lit(1)).alias("_n")
    )
    w = Window.partitionBy(key).orderBy("_minute")
    pause = F.unix_micros("_first") - F.unix_micros(F.lag("_last").over(w))
    fresh = F.when(pause <= gap_minutes * 60_000_000, F.lit(0)).otherwise(F.lit(1))
    numbered = minutes.withColumn("_fresh", fresh).withColumn("_session", F.sum("_fresh").over(w))
    gap = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(gap_minutes))
    return (
        numbered.groupBy(key, "_session")
        .agg(
            F.min("_first").alias("window_start"),
            (F.max("_last") + gap).alias("window_end"),
            F.sum("_n").alias("events"),
        )
        .select("window_start", "window_end", key, "events")
    )


def sessions(
    events: DataFrame,
    gap: str = "30 minutes",
    delay: str | None = "10 minutes",
    time: str = "event_ts",
    key: str = "employee_id",
) -> DataFrame:
    """Runs of events of one key with no pause longer than ``gap``, on a stream."""
    counted = _watermarked(events, time, delay).groupBy(F.session_window(time, gap).alias("window"), key)
    return _flat(counted.agg(F.count(F.lit(1)).alias("events")))


def processing_time_counts(
    events: DataFrame, seconds: int = 10, time: str = "processing_time", delay: str | None = None
) -> DataFrame:
    """Events per window of arrival time and ``department:event_type``.

    On a stream ``delay`` closes windows so long after their end, and their state goes.
    """
    label: Column = F.concat_ws(":", "department", "event_type").alias("key")
    counted = _watermarked(events, time, delay).groupBy(F.window(time, f"{seconds} seconds"), label)
    return _flat(counted.agg(F.count(F.lit(1)).alias("events")))


def newest_windows(counts: DataFrame, k: int = 20) -> DataFrame:
    """The rows of the latest windows of a running count."""
    keys = [c for c in ("department", "event_type") if c in counts.columns]
    return counts.orderBy(F.desc("window_start"), *keys).limit(k)


def drop_repeats(events: DataFrame, delay: str = "10 minutes", time: str = "event_ts") -> DataFrame:
    """First arrival of each event id; ids are remembered for the watermark's length."""
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark(["event_id"])
