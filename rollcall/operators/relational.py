"""Projection, filter, join, order and set operators."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from rollcall.functions.scalar import ColumnLike, as_col, hash_fraction_below, is_true, is_weekend
from rollcall.schemas import WORKDAYS


# --- projection and filter -----------------------------------------------------

def existing(df: DataFrame, columns: list[str]) -> list[str]:
    """Those of ``columns`` that the table has, in the given order."""
    return [c for c in columns if c in df.columns]


def department_staff(emp: DataFrame, department: str) -> DataFrame:
    """Employees of a department, best paid first."""
    return (
        emp.filter(F.col("department") == department)
        .select("employee_id", "name", "designation", "salary")
        .orderBy(F.desc("salary"), "employee_id")
    )


def in_month_of(df: DataFrame, as_of: date, column: str = "date") -> DataFrame:
    """Rows of the calendar month of ``as_of``, as a range so that it can be pushed down."""
    first = as_of.replace(day=1)
    following = date(first.year + first.month // 12, first.month % 12 + 1, 1)
    return df.filter((F.col(column) >= F.lit(first)) & (F.col(column) < F.lit(following)))


def since_days(df: DataFrame, as_of: date, days: int = 30, column: str = "date") -> DataFrame:
    """Rows dated ``days`` before ``as_of`` or later."""
    return df.filter(F.col(column) >= F.date_sub(F.lit(as_of), days))


def nan_as_null(df: DataFrame) -> DataFrame:
    """NaN in floating-point columns becomes null."""
    changed = {
        c: F.nanvl(F.col(c), F.lit(None).cast(t)) for c, t in df.dtypes if t in ("double", "float")
    }
    return df.withColumns(changed) if changed else df


def above_average(df: DataFrame, column: str) -> DataFrame:
    """Rows above the mean of the whole table, by a scalar subquery."""
    return df.filter(F.col(column) > df.agg(F.avg(column)).scalar())


def filter_by(df: DataFrame, **wanted: object) -> DataFrame:
    """Conjunction of equality filters; ``None`` and ``"All"`` put no condition."""
    for column, value in wanted.items():
        if value is not None and value != "All":
            df = df.filter(F.col(column) == F.lit(value))
    return df


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def latest_values(df: DataFrame, column: str, k: int = 6) -> DataFrame:
    """The ``k`` largest distinct values."""
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    return values.orderBy(F.desc(column)).limit(k)


def sample_rows(df: DataFrame, key: str, fraction: float, seed: int = 0) -> DataFrame:
    """About ``fraction`` of the rows, chosen by a digest of the key."""
    return df.filter(hash_fraction_below(key, fraction, seed))


def blank_out(df: DataFrame, column: str, key: str, fraction: float, seed: int = 0) -> DataFrame:
    """Null a column in about ``fraction`` of the rows."""
    hit = hash_fraction_below(key, fraction, seed)
    return df.withColumn(column, F.when(~hit, F.col(column)))


def make_dirty(att: DataFrame, key: str = "attendance_id") -> DataFrame:
    """Attendance with 5% of the hours and 2% of the statuses missing."""
    return blank_out(blank_out(att, "hours_worked", key, 0.05, 1), "status", key, 0.02, 2)


# --- joins ---------------------------------------------------------------------

def with_employee(att: DataFrame, emp: DataFrame, how: str = "inner") -> DataFrame:
    """Attendance rows with the name of the employee."""
    return att.join(emp.select("employee_id", "name"), "employee_id", how)


def enrich(att: DataFrame, emp: DataFrame, dept: DataFrame) -> DataFrame:
    """Attendance with employee attributes and the head of the department (left joins)."""
    people = emp.select("employee_id", "name", "designation", "salary", "join_date", "is_active")
    heads = dept.select(F.col("department_name").alias("department"), "head")
    return att.join(people, "employee_id", "left").join(heads, "department", "left")


def above_average_overtime(emp: DataFrame, att: DataFrame) -> DataFrame:
    """Employees whose mean overtime is above the mean over all records."""
    stats = att.groupBy("employee_id").agg(F.avg("overtime_hours").alias("avg_overtime"))
    overall = att.agg(F.avg("overtime_hours")).scalar()
    return (
        stats.filter(F.col("avg_overtime") > overall)
        .join(emp.select("employee_id", "name", "department"), "employee_id")
        .select("employee_id", "name", "department", "avg_overtime")
    )


def staff_blocks(managers: DataFrame, staff: int) -> DataFrame:
    """(manager_id, blocks) of managers of more than ``staff`` employees: about ``staff`` of them a block.

    At most employees / ``staff`` rows, from counts combined before they move.
    """
    size = F.count(F.lit(1))
    large = managers.groupBy("manager_id").agg(size.alias("_size")).filter(F.col("_size") > staff)
    return large.select("manager_id", F.ceil(F.col("_size") / staff).cast("int").alias("_blocks"))


def absent_while_manager_present(emp: DataFrame, att: DataFrame, staff: int = 20_000) -> DataFrame:
    """(employee, date, manager) where the employee is absent and the manager present.

    There is one record per employee and date in sound data. Where there are more,
    ``matches`` tells how many pairs of records stand behind the row, instead of
    listing every pair: both sides are counted per employee and date first.

    A manager of more than ``staff`` employees would bring all of them together on
    each date. Such staff are dealt over blocks by a digest of the employee, and
    only those managers' own days, one row each, are repeated per block.
    """
    absent = (
        att.filter(F.col("status") == "Absent")
        .groupBy(F.col("employee_id").alias("emp_id"), "date")
        .agg(F.count(F.lit(1)).alias("_absent"))
    )
    managers = emp.filter(F.col("manager_id").isNotNull()).select(
        F.col("employee_id").alias("emp_id"), "manager_id"
    )
    blocks = staff_blocks(managers, staff)
    split = F.coalesce("_blocks", F.lit(1))
    dealt = managers.join(blocks, "manager_id", "left").select(
        "emp_id", "manager_id", F.pmod(F.xxhash64("emp_id"), split).cast("int").alias("_block")
    )
    present = (
        att.filter(F.col("status") == "Present")
        .groupBy(F.col("employee_id").alias("manager_id"), "date")
        .agg(F.count(F.lit(1)).alias("_present"))
        .join(blocks, "manager_id", "left")
        .withColumn("_block", F.explode(F.sequence(F.lit(0), split - 1)))
    )
    return (
        absent.join(dealt, "emp_id")
        .join(present, ["manager_id", "date", "_block"])
        .select(
            "emp_id",
            "date",
            "manager_id",
            F.lit("Present").alias("manager_status"),
            (F.col("_absent") * F.col("_present")).alias("matches"),
        )
    )


def latest_absences_while_manager_present(emp: DataFrame, att: DataFrame, k: int = 100) -> DataFrame:
    return absent_while_manager_present(emp, att).orderBy(F.desc("date"), "emp_id").limit(k)


def orphans(df: DataFrame, column: str, ref: DataFrame, ref_column: str) -> DataFrame:
    """Rows whose key is not in the reference column; a null key is an orphan too."""
    known = ref.select(F.col(ref_column).alias(column)).distinct()
    return df.join(known, column, "left_anti")


def complete_categories(df: DataFrame, column: str, categories: list[str]) -> DataFrame:
    """One row per category in the given order; those without data get nulls."""
    wanted = df.sparkSession.createDataFrame(
        list(enumerate(categories)), f"_order int, {column} string"
    )
    return wanted.join(df, column, "left").orderBy("_order").drop("_order")


def weekday_spine(emp: DataFrame, start: date, end: date) -> DataFrame:
    """One row per employee and weekday between two dates, generated per employee row."""
    days = F.explode(F.sequence(F.lit(start), F.lit(end)))
    return emp.select("employee_id", days.alias("date")).filter(~is_weekend("date"))


def missing_days(emp: DataFrame, att: DataFrame, start: date, end: date) -> DataFrame:
    """Weekdays in a period on which an employee has no record."""
    seen = att.filter(F.col("date").between(F.lit(start), F.lit(end))).select("employee_id", "date")
    return weekday_spine(emp, start, end).join(seen.distinct(), ["employee_id", "date"], "left_anti")


# --- order, set operations -------------------------------------------------------

def preview(df: DataFrame, n: int, key: list[str]) -> DataFrame:
    """The first ``n`` rows by key; Spark keeps ``n`` rows per task."""
    return df.orderBy(*key).limit(n)


def append_rows(df: DataFrame, more: DataFrame) -> DataFrame:
    """Bag union by column name; columns missing on one side become null."""
    return df.unionByName(more, allowMissingColumns=True)


def differences(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """Rows that occur more often on one side, with ``side`` and ``copies``.

    A signed count per distinct row: one shuffle, combined before it, instead of
    two bag subtractions.
    """
    signed = left.select(*columns, F.lit(1).alias("_sign")).unionByName(
        right.select(*columns, F.lit(-1).alias("_sign"))
    )
    net = signed.groupBy(*columns).agg(F.sum("_sign").alias("_net")).filter(F.col("_net") != 0)
    side = F.when(F.col("_net") > 0, F.lit("left")).otherwise(F.lit("right"))
    return net.withColumn("side", side).withColumn("copies", F.abs("_net")).drop("_net")


def contains(c: ColumnLike, part: str) -> Column:
    """Substring test in which null does not contain anything."""
    return is_true(as_col(c).contains(part))
