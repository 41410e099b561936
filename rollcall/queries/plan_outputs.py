"""Every output table of the batch plans as a query of its own, beside the SQL of what it should hold."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollcall.plans import batch
from rollcall.queries import aggregates, modelling, statistics, windows  # noqa: F401  their SQL is used here
from rollcall.queries import views as V
from rollcall.queries.common import six_digit_columns
from rollcall.queries.registry import REFERENCE_SQL, query
from rollcall.schemas import TABLES
from rollcall.session import shared_path
from rollcall.sources.writers import write_csv

Plan = Callable[[SparkSession, str], dict[str, DataFrame]]


def _suite(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return batch.attendance_suite(V.att(spark, d), shared_path(spark, "suite"))


def _analysis(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return batch.analysis(V.att(spark, d), shared_path(spark, "analysis"))


def _samples(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return batch.sample_queries(V.emp(spark, d), V.att(spark, d))


def _star(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return batch.load_star_schema(V.att(spark, d), V.emp(spark, d), V.dept(spark, d), shared_path(spark, "star"))


def _output(name: str, plan: Plan, key: str, like: str, rounded: str | None = None, cut: tuple[str, ...] = ()) -> None:
    """Output ``key`` of a plan, which equals query ``like``, with a column ``rounded`` half-even to two digits there,
    and columns whose last bits depend on the order of addition ``cut`` to six digits here."""
    query(name)(lambda spark, d: six_digit_columns(plan(spark, d)[key], *cut))
    sql = REFERENCE_SQL[like]
    REFERENCE_SQL[name] = f"SELECT * REPLACE (round_even({rounded}, 2) AS {rounded}) FROM ({sql})" if rounded else sql


_output("g03_statistics", _analysis, "statistics", "n06_column_statistics", cut=("std", "variance"))
_output("g05_dim_date", _star, "dim_date", "m01_dim_date")
_output("g05_dim_employee", _star, "dim_employee", "m02_dim_employee")
_output("g05_dim_department", _star, "dim_department", "m03_dim_department")
_output("g05_fact_attendance", _star, "fact_attendance", "m05_fact_attendance")
_output("g06_by_department", _samples, "Attendance by department", "a13_department_status_counts")
_output("g06_top_overtime", _samples, "Top 5 overtime employees", "a15_top_overtime_names")
_output("g06_monthly_trend", _samples, "Monthly attendance trend", "a12_monthly_present")
_output("g07_status_distribution", _suite, "status_distribution", "a01_status_counts")
_output("g07_hours_by_department", _suite, "hours_by_department", "a19_hours_by_department")
_output("g07_monthly_rates", _suite, "monthly_rates", "a14_department_month_rates", "attendance_pct")
_output("g07_top_overtime", _suite, "top_overtime", "a15_top_overtime")
_output("g07_absence_by_day", _suite, "absence_by_day", "a16_absence_by_day", "pct")
_output("g07_top_rows", _suite, "top_rows", "w07_top_rows_by_hours")


@query(
    "g07_late_by_department",
    """SELECT department, count(*) FILTER (status = 'Late') AS late_count, round_even(avg(coalesce(hours_worked, 0)), 2) AS avg_hours
       FROM att WHERE department IS NOT NULL GROUP BY department""",
)
def g07_late(spark: SparkSession, d: str) -> DataFrame:
    # over the stored features, where empty hours are 0
    return _suite(spark, d)["late_by_department"]


@query(
    "g03_outliers",
    """SELECT count(*) FILTER (hours_worked < q1 - 1.5 * (q3 - q1) OR hours_worked > q3 + 1.5 * (q3 - q1)) AS outliers,
              count(*) AS "rows", q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper
       FROM att, (SELECT quantile_cont(hours_worked, 0.25) AS q1, quantile_cont(hours_worked, 0.75) AS q3 FROM att) q GROUP BY q1, q3""",
)
def g03_outliers(spark: SparkSession, d: str) -> DataFrame:
    return _analysis(spark, d)["outliers"]


@query(
    "g03_profile",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) FILTER ({c} IS NULL) AS nulls, count(*) AS row_count FROM att"""
        for c in ("attendance_id", "employee_id", "date", "status", "hours_worked", "overtime_hours", "department", "shift")),
)
def g03_profile(spark: SparkSession, d: str) -> DataFrame:
    profile = _analysis(spark, d)["profile"].select("column", "nulls", "row_count")
    return profile.filter(profile["column"].isin(
        "attendance_id", "employee_id", "date", "status", "hours_worked", "overtime_hours", "department", "shift"))


@query(
    "g02_summary_of_csv_folder",
    f"SELECT * REPLACE (CAST(employee_id AS VARCHAR) AS employee_id, round_even(attendance_pct, 2) AS attendance_pct) FROM ({REFERENCE_SQL['g02_merge_and_summarize']})",
)
def g02_summary(spark: SparkSession, d: str) -> DataFrame:
    root = shared_path(spark, "merge")
    for name, df in (("attendance", V.att_raw(spark, d)), ("employees", V.emp(spark, d)), ("departments", V.dept(spark, d))):
        columns = [(F.col(f.name) if f.name in df.columns else F.lit(None)).cast("string").alias(f.name) for f in TABLES[name].fields]
        write_csv(df.select(*columns), f"{root}/in/{name}.csv")
    return batch.merge_and_summarize(spark, f"{root}/in", f"{root}/out")["summary"]
