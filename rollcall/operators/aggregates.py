"""Aggregations over attendance.

Functions named after a report keep null groups out, as dataframe libraries do,
and read an empty sum as 0; those written for SQL tables keep a null group and
null sums. ``digits=None`` returns unrounded figures.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from rollcall.functions.scalar import (
    flag,
    month_start,
    percent,
    round_to,
    status_is,
    weekday_number,
    year_month,
)
from rollcall.operators.quantiles import column_quantiles
from rollcall.operators.relational import complete_categories, in_month_of, since_days
from rollcall.operators.windows import share_of_total
from rollcall.schemas import WORKDAYS

TARGET_RATE = 85.0  # Fixed value: attendance rate aimed at, percent.


def rows() -> Column:
    return F.count(F.lit(1))


def count_status(value: str) -> Column:
    return F.count_if(status_is(value))


def filled_sum(c: str) -> Column:
    return F.coalesce(F.sum(c), F.lit(0.0))


def known(df: DataFrame, *keys: str) -> DataFrame:
    """Rows in which every grouping key is known."""
    for k in keys:
        df = df.filter(F.col(k).isNotNull())
    return df


# --- distributions ---------------------------------------------------------------

def status_distribution(att: DataFrame, digits: int | None = 2) -> DataFrame:
    counts = att.groupBy("status").agg(rows().alias("total_records"))
    shared = share_of_total(counts, "total_records", "percentage")
    return shared.withColumn("percentage", round_to(F.col("percentage"), digits)).orderBy(
        F.desc("total_records"), F.col("status").asc_nulls_first()
    )


def value_counts(df: DataFrame, column: str, name: str = "count", by_name: bool = False) -> DataFrame:
    """Rows per known value, most frequent first, or sorted by value."""
    counts = known(df, column).groupBy(column).agg(rows().alias(name))
    return counts.orderBy(column) if by_name else counts.orderBy(F.desc(name), column)


def top_employees_by_hours(emp: DataFrame, att: DataFrame, as_of: date, k: int = 10) -> DataFrame:
    """Employees with the most hours in the month of ``as_of``.

    Summed per employee before the join, so the join sees one row per employee.
    """
    totals = in_month_of(att, as_of).groupBy("employee_id").agg(
        F.sum("hours_worked").alias("total_hours"), F.count("attendance_id").alias("working_days")
    )
    return (
        totals.join(emp.select("employee_id", "name", "department"), "employee_id")
        .select("employee_id", "name", "department", "total_hours", "working_days")
        .orderBy(F.col("total_hours").desc_nulls_last(), "employee_id")
        .limit(k)
    )


def departments_below_rate(att: DataFrame, limit: float = 80.0, digits: int | None = 2) -> DataFrame:
    present = F.sum(flag(status_is("Present")))
    return (
        att.groupBy("department")
        .agg(rows().alias("total_records"), present.alias("present_count"))
        .withColumn(
            "attendance_pct", round_to(percent(F.col("present_count"), F.col("total_records")), digits)
        )
        .filter(F.col("attendance_pct") < limit)
        .orderBy("attendance_pct", F.col("department").asc_nulls_first())
    )


def daily_presence(att: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    """Distinct employees present and their mean hours per day of the last days."""
    recent = since_days(att.filter(F.col("status") == "Present"), as_of, days)
    return (
        recent.groupBy("date")
        .agg(
            F.count_distinct("employee_id").alias("employees_present"),
            F.avg("hours_worked").alias("avg_hours"),
        )
        .orderBy(F.desc("date"))
    )


def absences_by_weekday(att: DataFrame) -> DataFrame:
    """Absences per department, one column per working day."""
    counts = [
        F.count_if(F.col("day_of_week") == d).alias(d.lower()) for d in WORKDAYS
    ]
    return (
        att.filter(F.col("status") == "Absent")
        .groupBy("department")
        .agg(*counts)
        .orderBy(F.col("department").asc_nulls_first())
    )


# --- summaries ---------------------------------------------------------------------

def employee_summary(att: DataFrame, digits: int | None = 2) -> DataFrame:
    return (
        known(att, "employee_id")
        .groupBy("employee_id")
        .agg(
            F.count("date").alias("total_days"),
            count_status("Present").alias("present_days"),
            count_status("Absent").alias("absent_days"),
            count_status("Late").alias("late_days"),
            count_status("Work-From-Home").alias("wfh_days"),
            filled_sum("hours_worked").alias("total_hours"),
            F.avg("hours_worked").alias("avg_hours"),
            filled_sum("overtime_hours").alias("total_overtime"),
        )
        .withColumn(
            "attendance_pct",
            round_to(percent(F.col("present_days"), F.col("total_days")), digits, half_even=True),
        )
    )


def daily_summary(att: DataFrame) -> DataFrame:
    return (
        known(att, "date")
        .groupBy("date")
        .agg(
            F.count_distinct("employee_id").alias("total_employees"),
            count_status("Present").alias("present_count"),
            count_status("Absent").alias("absent_count"),
            count_status("Late").alias("late_count"),
            count_status("Work-From-Home").alias("wfh_count"),
            F.avg("hours_worked").alias("avg_hours"),
            filled_sum("overtime_hours").alias("total_overtime"),
        )
    )


def monthly_summary(att: DataFrame) -> DataFrame:
    return (
        known(att, "employee_id", "date")
        .groupBy("employee_id", year_month("date").alias("year_month"))
        .agg(
            F.count("date").alias("working_days"),
            count_status("Present").alias("present"),
            count_status("Absent").alias("absent"),
            filled_sum("hours_worked").alias("hours_worked"),
            filled_sum("overtime_hours").alias("overtime"),
        )
    )


def department_summary(att: DataFrame, digits: int | None = 2) -> DataFrame:
    """Present share is of all rows, those without a status included."""
    share = percent(count_status("Present"), rows())
    return (
        known(att, "department")
        .groupBy("department")
        .agg(
            F.count_distinct("employee_id").alias("headcount"),
            round_to(share, digits, half_even=True).alias("avg_attendance_pct"),
            filled_sum("hours_worked").alias("total_hours"),
            F.avg("overtime_hours").alias("avg_overtime"),
        )
    )


def department_attendance(att: DataFrame, digits: int | None = 2) -> DataFrame:
    """The stored department summary (a null department is a group of its own)."""
    return att.groupBy("department").agg(
        rows().alias("total_records"),
        F.sum(flag(status_is("Present"))).alias("present"),
        round_to(F.avg("hours_worked"), digits).alias("avg_hours"),
        F.sum("overtime_hours").alias("total_overtime"),
    )


def monthly_trend(att: DataFrame, digits: int | None = 2) -> DataFrame:
    return (
        att.groupBy(year_month("date").alias("month"))
        .agg(
            F.count_distinct("employee_id").alias("active_employees"),
            F.sum(flag(status_is("Present"))).alias("present_count"),
            round_to(F.avg("hours_worked"), digits).alias("avg_hours"),
        )
        .orderBy(F.col("month").asc_nulls_first())
    )


def monthly_present(att: DataFrame) -> DataFrame:
    return (
        att.groupBy(year_month("date").alias("month"))
        .agg(F.sum(flag(status_is("Present"))).alias("present_count"))
        .orderBy(F.col("month").asc_nulls_first())
    )


def department_status_counts(att: DataFrame, k: int = 20) -> DataFrame:
    return (
        att.groupBy("department", "status")
        .agg(rows().alias("count"))
        .orderBy(
            F.col("department").asc_nulls_first(), F.desc("count"), F.col("status").asc_nulls_first()
        )
        .limit(k)
    )


def department_month_rates(att: DataFrame, digits: int | None = 2) -> DataFrame:
    return (
        known(att, "department", "date")
        .groupBy("department", F.year("date").alias("year"), F.month("date").alias("month"))
        .agg(F.count("employee_id").alias("total"), count_status("Present").alias("present"))
        .withColumn(
            "attendance_pct",
            round_to(percent(F.col("present"), F.col("total")), digits, half_even=True),
        )
        .orderBy("department", "year", "month")
    )


def department_month_rates_warehouse(att: DataFrame, digits: int | None = 2) -> DataFrame:
    """The same rates keyed by the first day of the month, newest month first."""
    return (
        att.groupBy("department", month_start("date").alias("month"))
        .agg(rows().alias("total"), count_status("Present").alias("present"))
        .withColumn(
            "attendance_pct", round_to(percent(F.col("present"), F.col("total")), digits)
        )
        .orderBy(F.desc("month"), "attendance_pct", "department")
    )


def top_overtime(att: DataFrame, k: int = 10) -> DataFrame:
    """Employees with the most overtime, over records that have some."""
    return (
        known(att.filter(F.col("overtime_hours") > 0), "employee_id")
        .groupBy("employee_id")
        .agg(F.sum("overtime_hours").alias("total_ot"), rows().alias("records"))
        .orderBy(F.desc("total_ot"), "employee_id")
        .limit(k)
    )


def top_overtime_names(emp: DataFrame, att: DataFrame, k: int = 5) -> DataFrame:
    totals = att.groupBy("employee_id").agg(F.sum("overtime_hours").alias("total_ot"))
    return (
        totals.join(emp.select("employee_id", "name", "department"), "employee_id")
        .orderBy(F.col("total_ot").desc_nulls_last(), "employee_id")
        .limit(k)
        .select("name", "department", "total_ot")
    )


def absence_by_day_number(att: DataFrame, digits: int | None = 2) -> DataFrame:
    absent = known(att.filter(F.col("status") == "Absent"), "date")
    counts = absent.groupBy(weekday_number("date").alias("day_num")).agg(rows().alias("absent_count"))
    shared = share_of_total(counts, "absent_count", "pct")
    return shared.withColumn("pct", round_to(F.col("pct"), digits, half_even=True)).orderBy("day_num")


def late_by_department(att: DataFrame, digits: int | None = 2) -> DataFrame:
    return (
        known(att, "department")
        .groupBy("department")
        .agg(
            count_status("Late").alias("late_count"),
            round_to(F.avg("hours_worked"), digits, half_even=True).alias("avg_hours"),
        )
        .orderBy(F.desc("late_count"), "department")
    )


def wfh_by_month(att: DataFrame) -> DataFrame:
    return (
        known(att.filter(F.col("status") == "Work-From-Home"), "date")
        .groupBy(F.year("date").alias("year"), F.month("date").alias("month"))
        .agg(rows().alias("count"))
        .orderBy("year", "month")
    )


def hours_by_department(att: DataFrame) -> DataFrame:
    return (
        known(att, "department")
        .groupBy("department")
        .agg(F.avg("hours_worked").alias("avg_hours"))
        .orderBy(F.col("avg_hours").desc_nulls_last(), "department")
    )


def hours_per_row_by_department(att: DataFrame) -> DataFrame:
    """Hours divided by all rows of the department, those without hours included."""
    return (
        known(att, "department")
        .groupBy("department")
        .agg(
            F.try_divide(filled_sum("hours_worked"), rows()).alias("avg_hours"),
            rows().alias("total_rows"),
        )
        .orderBy(F.desc("avg_hours"), "department")
    )


def _overtime(emp: DataFrame, att: DataFrame) -> DataFrame:
    worked = att.filter(F.col("overtime_hours") > 0).select("employee_id", "overtime_hours")
    return worked.join(emp.select("employee_id", "department"), "employee_id")


def overtime_by_department(emp: DataFrame, att: DataFrame) -> DataFrame:
    """Mean, maximum and sketched median of positive overtime per department of the employee."""
    return (
        _overtime(emp, att)
        .groupBy("department")
        .agg(
            F.avg("overtime_hours").alias("avg_overtime"),
            F.max("overtime_hours").alias("max_overtime"),
            F.approx_percentile("overtime_hours", 0.5).alias("median_overtime"),
        )
        .orderBy(F.desc("avg_overtime"), "department")
    )


def overtime_by_department_exact(emp: DataFrame, att: DataFrame) -> DataFrame:
    """The same with the exact median: a bracket per department, then the values inside it.

    No department's values meet in one place, however many of the records it has.
    """
    value = F.col("_v")
    found = column_quantiles(
        _overtime(emp, att), ["overtime_hours"], [0.5], ["department"],
        {"avg_overtime": F.avg(value), "max_overtime": F.max(value)},
    )
    return found.select(
        "department", "avg_overtime", "max_overtime", F.col("p50").alias("median_overtime")
    ).orderBy(F.desc("avg_overtime"), "department")


# --- dashboard figures ---------------------------------------------------------------

def kpis(all_rows: DataFrame, filtered: DataFrame, digits: int | None = 1) -> DataFrame:
    """Headline figures of a filtered view; the headcount is of the unfiltered data."""
    headcount = all_rows.agg(F.count_distinct("employee_id")).scalar()
    rate = round_to(F.lit(100.0) * F.avg(flag(status_is("Present"))), digits, half_even=True)
    return (
        filtered.agg(
            rate.alias("attendance_rate"),
            round_to(F.avg("hours_worked"), digits, half_even=True).alias("avg_hours"),
            filled_sum("overtime_hours").cast("bigint").alias("total_overtime"),
            count_status("Absent").alias("absent_records"),
        )
        .withColumn("total_employees", headcount)
        .withColumn("vs_target", F.col("attendance_rate") - F.lit(TARGET_RATE))
    )


def daily_kpi(clean: DataFrame, run_date: date, only_date: date | None = None, digits: int | None = 2) -> DataFrame:
    """One KPI record; covers the whole table unless ``only_date`` is given."""
    if only_date is not None:
        clean = clean.filter(F.col("date") == F.lit(only_date))
    return clean.agg(
        F.lit(run_date.isoformat()).alias("date"),
        rows().alias("total_records"),
        round_to(F.lit(100.0) * F.avg("is_present"), digits, half_even=True).alias("present_pct"),
        round_to(F.avg("hours_worked"), digits, half_even=True).alias("avg_hours"),
        round_to(filled_sum("overtime_hours"), digits, half_even=True).alias("total_overtime"),
    )


def _rate(digits: int | None) -> Column:
    return round_to(F.lit(100.0) * F.avg(flag(status_is("Present"))), digits, half_even=True)


def monthly_rate(att: DataFrame, digits: int | None = 1) -> DataFrame:
    return (
        known(att, "date")
        .groupBy(year_month("date").alias("month"))
        .agg(_rate(digits).alias("attendance_pct"))
        .orderBy("month")
    )


def department_month_matrix(att: DataFrame, months: list[str], digits: int | None = 1) -> DataFrame:
    """Present rate per department, one column per listed month."""
    return (
        known(att, "department", "date")
        .groupBy("department")
        .pivot("month", months)
        .agg(_rate(digits))
        .orderBy("department")
    )


def overtime_totals(att: DataFrame) -> DataFrame:
    return (
        known(att, "department")
        .groupBy("department")
        .agg(filled_sum("overtime_hours").alias("overtime_hours"))
        .orderBy(F.desc("overtime_hours"), "department")
    )


def weekday_rates(att: DataFrame, digits: int | None = 1) -> DataFrame:
    """Present rate Monday to Friday in calendar order; a day without rows stays, empty."""
    rates = (
        att.filter(F.col("day_of_week").isin(WORKDAYS))
        .groupBy("day_of_week")
        .agg(_rate(digits).alias("attendance_pct"))
    )
    return complete_categories(rates, "day_of_week", WORKDAYS)


def request_report(log: DataFrame, digits: int | None = 2) -> DataFrame:
    """Totals and latency of a request log; an empty log gives no row."""
    ok = F.count_if(F.col("status_code").between(200, 299))
    return log.agg(
        rows().alias("total_requests"),
        ok.alias("successful"),
        round_to(F.avg("latency_ms"), digits, half_even=True).alias("avg_latency_ms"),
        F.max("latency_ms").alias("max_latency_ms"),
        F.min("latency_ms").alias("min_latency_ms"),
    ).filter(F.col("total_requests") > 0)


def approx_distinct(df: DataFrame, key: str, value: str, rsd: float = 0.05) -> DataFrame:
    """Distinct values per key by a sketch of relative deviation ``rsd``; rows (key, approx), null values not counted."""
    return df.groupBy(key).agg(F.approx_count_distinct(value, rsd).alias("approx"))
