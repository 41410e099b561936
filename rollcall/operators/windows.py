"""Window operators: running and moving figures, ranks, lags, keep-first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rollcall.functions.scalar import flag, parse_date, status_is, year_month
from rollcall.operators.splits import (
    BLOCKS,
    large_and_other,
    running_sum,
    split_points,
    with_position,
    with_position_within,
)

CHUNK_ROWS = 1_000_000  # numbered rows of one key that a moving average takes together

WORKED = ["Present", "Late", "Work-From-Home"]  # Fixed values: statuses with hours at work.


def worked_rows(att: DataFrame) -> DataFrame:
    return att.filter(F.col("status").isin(WORKED))


def running_total(
    df: DataFrame, value: str, keys: list[str], order: list[str], name: str, blocks: int = BLOCKS
) -> DataFrame:
    """Running sum of ``value`` per key. ``order`` has to end in a unique column.

    Ordinary keys use a plain window. A key too large for one task is summed in
    ordered blocks, each starting from the total of the blocks before it.
    """
    return running_sum(df, value, keys, [F.col(c) for c in order], name, blocks)


def _chunked_average(
    numbered: DataFrame, value: str, rows: int, name: str, keys: list[str], chunk_rows: int
) -> DataFrame:
    """Moving average over ``_pos``-numbered rows in chunks of bounded size.

    The last ``rows - 1`` rows of a chunk are also sent to the next one, where
    they fill the frames of its first rows and are dropped afterwards.
    """
    chunk_rows = max(chunk_rows, rows)
    slot = (F.col("_pos") - 1) % chunk_rows
    home = ((F.col("_pos") - 1 - slot) / chunk_rows).cast("bigint")
    copies = F.when(slot > chunk_rows - rows, F.array(home, home + 1)).otherwise(F.array(home))
    spread = numbered.withColumn("_home", home).withColumn("_chunk", F.explode(copies))
    w = Window.partitionBy(*keys, "_chunk").orderBy("_pos").rowsBetween(-(rows - 1), 0)
    return (
        spread.withColumn(name, F.avg(value).over(w))
        .filter(F.col("_home") == F.col("_chunk"))
        .drop("_home", "_chunk", "_pos")
    )


def moving_average(
    df: DataFrame,
    value: str,
    keys: list[str],
    order: list[str],
    name: str,
    rows: int = 7,
    blocks: int = BLOCKS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Mean of ``value`` over the last ``rows`` rows (not days) of a key."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-(rows - 1), 0)
    points = split_points(df, keys, [F.col(c) for c in order], blocks)
    if points is None:
        return df.withColumn(name, F.avg(value).over(w))
    large, other = large_and_other(df, keys, points)
    numbered = with_position_within(large, keys, [F.col(c) for c in order], "_pos", blocks, points)
    split = _chunked_average(numbered, value, rows, name, keys, chunk_rows)
    return other.withColumn(name, F.avg(value).over(w)).unionByName(split.select(*df.columns, name))


def moving_average_days(
    df: DataFrame, value: str, keys: list[str], date: str, name: str, days: int = 7
) -> DataFrame:
    """Mean over the last ``days`` calendar days of a key, one row per key and day.

    Rows are summed per day first, so a key has at most one row per calendar day.
    """
    daily = df.groupBy(*keys, date).agg(F.sum(value).alias("_sum"), F.count(value).alias("_n"))
    w = Window.partitionBy(*keys).orderBy(F.unix_date(date)).rangeBetween(-(days - 1), 0)
    return daily.withColumn(name, F.try_divide(F.sum("_sum").over(w), F.sum("_n").over(w))).drop("_sum", "_n")


def rolling_mean(
    df: DataFrame,
    value: str,
    rows: int = 7,
    order: list[str] | None = None,
    partition_by: list[str] | None = None,
    blocks: int = BLOCKS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Rolling mean over the whole table in date order, as ``<value>_rolling_<rows>d``.

    ``order`` has to end in a unique column. Without ``partition_by`` the table
    is one single series; it is numbered in blocks and averaged in chunks.
    """
    order = order or ["date", "attendance_id"]
    name = f"{value}_rolling_{rows}d"
    if partition_by:
        return moving_average(df, value, partition_by, order, name, rows, blocks, chunk_rows)
    nulls_last = [x for c in order for x in (F.col(c).isNull(), F.col(c))]
    numbered = with_position(df, [x.alias(f"_{i}") for i, x in enumerate(nulls_last)], "_pos", blocks)
    return _chunked_average(numbered, value, rows, name, [], chunk_rows)


def running_hours(att: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """Running total of hours per employee over worked days."""
    rows = worked_rows(att).select("attendance_id", "employee_id", "date", "hours_worked")
    return running_total(
        rows, "hours_worked", ["employee_id"], ["date", "attendance_id"], "cumulative_hours", blocks
    )


def weekly_average_hours(att: DataFrame, blocks: int = BLOCKS, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Seven-row moving average of hours per employee over worked days."""
    rows = worked_rows(att).select("attendance_id", "employee_id", "date", "hours_worked")
    return moving_average(
        rows, "hours_worked", ["employee_id"], ["date", "attendance_id"], "rolling_7day_avg", 7, blocks, chunk_rows
    )


def present_days(emp: DataFrame, att: DataFrame) -> DataFrame:
    """Present days per employee; employees without any record count 0.

    Attendance is reduced to one row per employee before it is joined.
    """
    counts = (
        att.filter(F.col("status") == "Present").groupBy("employee_id").agg(F.count(F.lit(1)).alias("_n"))
    )
    return emp.join(counts, "employee_id", "left").select(
        "employee_id", "name", "department", F.coalesce("_n", F.lit(0)).alias("present_days")
    )


def rank_by_count(df: DataFrame, group: str, measure: str, name: str) -> DataFrame:
    """RANK by a descending count within a group.

    Ranks need only how many rows have each (group, measure), so the window
    runs over that histogram. Counts that add up to N rows have at most
    sqrt(2N) different values, however many rows the group has.
    """
    hist = df.groupBy(group, measure).agg(F.count(F.lit(1)).alias("_n"))
    above = (
        Window.partitionBy(group).orderBy(F.desc(measure)).rowsBetween(Window.unboundedPreceding, -1)
    )
    ranks = hist.select(
        F.col(group).alias("_g"),
        F.col(measure).alias("_m"),
        (F.coalesce(F.sum("_n").over(above), F.lit(0)) + 1).alias(name),
    )
    on = F.col(group).eqNullSafe(F.col("_g")) & F.col(measure).eqNullSafe(F.col("_m"))
    return df.join(ranks, on).drop("_g", "_m")


def ntile(df: DataFrame, tiles: int, order: list[Column], name: str) -> DataFrame:
    """NTILE over the whole table in ascending order, from exact positions and the row count."""
    placed = with_position(df, order, "_pos")
    total = placed.agg(F.count(F.lit(1))).scalar()
    size = F.floor(total / tiles).cast("bigint")
    extra = total % tiles
    wide = extra * (size + 1)  # rows in the tiles that hold one more
    tile = F.when(
        F.col("_pos") <= wide, F.floor((F.col("_pos") - 1) / (size + 1)) + 1
    ).otherwise(extra + F.floor((F.col("_pos") - wide - 1) / F.greatest(size, F.lit(1))) + 1)
    return placed.withColumn(name, tile.cast("int")).drop("_pos")


def rank_in_department(emp: DataFrame, att: DataFrame) -> DataFrame:
    return rank_by_count(present_days(emp, att), "department", "present_days", "dept_rank")


def performance_quartile(emp: DataFrame, att: DataFrame) -> DataFrame:
    order = [F.negative("present_days").alias("less"), F.col("employee_id")]
    return ntile(present_days(emp, att), 4, order, "performance_quartile")


def month_over_month(att: DataFrame) -> DataFrame:
    """Change of present days against the employee's previous month; 0 for the first.

    The window sees one row per employee and calendar month.
    """
    present = F.count_if(status_is("Present")).alias("present_days")
    months = att.groupBy("employee_id", year_month("date").alias("ym")).agg(present)
    earlier = F.lag("present_days").over(Window.partitionBy("employee_id").orderBy("ym"))
    change = F.when(F.col("prev_month").isNull(), 0).otherwise(F.col("present_days") - F.col("prev_month"))
    return months.withColumn("prev_month", earlier).withColumn("mom_change", change)


def share_of_total(df: DataFrame, count: str, name: str) -> DataFrame:
    """Add each row's percentage of the column total. For aggregated rows."""
    total = df.agg(F.sum(count)).scalar()
    return df.withColumn(name, F.lit(100.0) * F.col(count) / total)


def top_rows(df: DataFrame, group: str, order: list[Column], k: int = 3) -> DataFrame:
    """The first ``k`` rows of each group; an entity may appear more than once.

    Spark keeps only ``k`` rows per group and task before the shuffle.
    """
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= k)


def top_rows_by_hours(att: DataFrame, k: int = 3) -> DataFrame:
    order = [F.col("hours_worked").desc_nulls_last(), F.col("attendance_id").asc()]
    rows = att.filter(F.col("department").isNotNull())
    return top_rows(rows, "department", order, k).select(
        "department", "rn", "attendance_id", "employee_id", "hours_worked"
    )


def monthly_present_rate(att: DataFrame) -> DataFrame:
    """Share of present rows per month; dates may be text, unreadable ones are left out."""
    dated = att.select(parse_date("date").alias("date"), "status").filter(F.col("date").isNotNull())
    return (
        dated.groupBy(year_month("date").alias("month"))
        .agg(F.avg(flag(status_is("Present"))).alias("rate"))
    )


def monthly_rate_change(att: DataFrame) -> DataFrame:
    """Present rate per month and its change; the window sees one row per calendar month."""
    w = Window.orderBy("month")
    return monthly_present_rate(att).withColumn("change", F.col("rate") - F.lag("rate").over(w))


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    Each task keeps one row per key before the shuffle, so a key with many
    copies does not meet in one task. Null keys are equal to each other.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
