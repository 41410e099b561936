"""Star schema over attendance: four dimensions and the fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollcall.functions.scalar import (
    budget_tier,
    date_key,
    day_name,
    flag,
    is_weekend,
    iso_week,
    lookup,
    month_name,
    parse_date,
    salary_band,
    status_is,
)
from rollcall.operators.splits import with_position

# The shifts with their keys and times.
SHIFT_ROWS = [
    (1, "Morning", "06:00", "14:00"),
    (2, "Afternoon", "14:00", "22:00"),
    (3, "Night", "22:00", "06:00"),
]


def dim_date(att: DataFrame, column: str = "date") -> DataFrame:
    """One row per date that occurs."""
    days = att.select(parse_date(column).alias("full_date")).dropna().distinct()
    d = F.col("full_date")
    return days.select(
        date_key(d).alias("date_key"),
        "full_date",
        day_name(d).alias("day_of_week"),
        F.dayofmonth(d).alias("day_num"),
        iso_week(d).alias("week_num"),
        F.month(d).alias("month_num"),
        month_name(d).alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        is_weekend(d).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
    )


def dim_employee(emp: DataFrame) -> DataFrame:
    """Employees with a surrogate key in employee order, salary band and open validity."""
    chosen = emp.select(
        "employee_id", "name", "department", "designation", "location", "salary",
        salary_band("salary").alias("salary_band"),
        parse_date("join_date").alias("effective_from"),
        F.lit(None).cast("date").alias("effective_to"),
        F.lit(True).alias("is_current"),
    )
    return with_position(chosen, [F.col("employee_id")], "emp_key")


def dim_department(dept: DataFrame) -> DataFrame:
    chosen = dept.select(
        F.col("department_name").alias("department"), "head", "budget",
        budget_tier("budget").alias("budget_tier"),
    )
    return with_position(chosen, [F.col("department")], "dept_key")


def dim_shift(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        SHIFT_ROWS, "shift_key int, shift_name string, start_time string, end_time string"
    )


def fact_attendance(att: DataFrame, employees: DataFrame, departments: DataFrame) -> DataFrame:
    """Attendance with the four dimension keys and four status flags.

    The date key is computed from the date and the shift key from its three fixed
    names, so only the employee and department keys need a join. The fact key is
    the attendance id, already unique per record.
    """
    shift_keys = {name: key for key, name, _, _ in SHIFT_ROWS}
    emp_keys = employees.select("employee_id", "emp_key")
    dept_keys = departments.select("department", "dept_key")
    return (
        att.join(emp_keys, "employee_id", "left").join(dept_keys, "department", "left")
        .select(
            F.col("attendance_id").alias("fact_id"),
            date_key(parse_date("date")).alias("date_key"),
            "emp_key",
            "dept_key",
            lookup("shift", shift_keys).cast("int").alias("shift_key"),
            "status",
            "hours_worked",
            "overtime_hours",
            flag(status_is("Present")).alias("is_present"),
            flag(status_is("Absent")).alias("is_absent"),
            flag(status_is("Late")).alias("is_late"),
            flag(status_is("Work-From-Home")).alias("is_wfh"),
        )
    )


def star_schema(att: DataFrame, emp: DataFrame, dept: DataFrame) -> dict[str, DataFrame]:
    employees, departments = dim_employee(emp), dim_department(dept)
    return {
        "dim_date": dim_date(att),
        "dim_employee": employees,
        "dim_department": departments,
        "dim_shift": dim_shift(att.sparkSession),
        "fact_attendance": fact_attendance(att, employees, departments),
    }
