"""Queries for aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollcall.operators import aggregates as A
from rollcall.operators.cleaning import daily_transform, dashboard_columns, feature_columns
from rollcall.operators.relational import filter_by
from rollcall.queries import views as V
from rollcall.queries.common import AS_OF, EV_AS_OF
from rollcall.queries.registry import query


@query(
    "a01_status_distribution",
    """SELECT status, count(*) AS total_records,
              CAST(100 AS DOUBLE) * count(*) / CAST(sum(count(*)) OVER () AS BIGINT) AS percentage
       FROM att GROUP BY status""",
)
def a01(spark: SparkSession, d: str) -> DataFrame:
    return A.status_distribution(V.att(spark, d), digits=None)


@query("a01_status_counts", "SELECT status, count(*) AS count FROM att WHERE status IS NOT NULL GROUP BY status")
def a01b(spark: SparkSession, d: str) -> DataFrame:
    return A.value_counts(V.att(spark, d), "status")


@query(
    "a02_top_employees_by_hours",
    """WITH july AS (SELECT employee_id, sum(hours_worked) AS total_hours, count(*) AS working_days FROM att
                     WHERE date BETWEEN DATE '2001-07-01' AND DATE '2001-07-31' GROUP BY employee_id)
       SELECT employee_id, name, department, total_hours, working_days FROM july JOIN emp USING (employee_id)
       ORDER BY total_hours DESC NULLS LAST, employee_id LIMIT 10""",
)
def a02(spark: SparkSession, d: str) -> DataFrame:
    return A.top_employees_by_hours(V.emp(spark, d), V.att(spark, d), AS_OF)


@query(
    "a03_departments_below_rate",
    """SELECT department, count(*) AS total_records, count(*) FILTER (status = 'Present') AS present_count,
              CAST(100 AS DOUBLE) * count(*) FILTER (status = 'Present') / count(*) AS attendance_pct
       FROM att GROUP BY department
       HAVING CAST(100 AS DOUBLE) * count(*) FILTER (status = 'Present') / count(*) < 80""",
)
def a03(spark: SparkSession, d: str) -> DataFrame:
    return A.departments_below_rate(V.att(spark, d), digits=None)


@query(
    "a04_daily_presence",
    """SELECT CAST(date AS VARCHAR) AS date, count(DISTINCT employee_id) AS employees_present,
              avg(hours_worked) AS avg_hours
       FROM att_ev WHERE status = 'Present' AND date >= DATE '2024-01-31' - INTERVAL 30 DAY GROUP BY date""",
)
def a04(spark: SparkSession, d: str) -> DataFrame:
    return A.daily_presence(V.att_ev(spark, d), EV_AS_OF)


@query(
    "a05_absences_by_weekday",
    """SELECT department, count(*) FILTER (day_of_week = 'Monday') AS monday,
              count(*) FILTER (day_of_week = 'Tuesday') AS tuesday,
              count(*) FILTER (day_of_week = 'Wednesday') AS wednesday,
              count(*) FILTER (day_of_week = 'Thursday') AS thursday,
              count(*) FILTER (day_of_week = 'Friday') AS friday
       FROM att WHERE status = 'Absent' GROUP BY department""",
)
def a05(spark: SparkSession, d: str) -> DataFrame:
    return A.absences_by_weekday(V.att(spark, d))


@query(
    "a06_employee_summary",
    """SELECT employee_id, count(date) AS total_days, count(*) FILTER (status = 'Present') AS present_days,
              count(*) FILTER (status = 'Absent') AS absent_days, count(*) FILTER (status = 'Late') AS late_days,
              count(*) FILTER (status = 'Work-From-Home') AS wfh_days,
              coalesce(sum(hours_worked), 0) AS total_hours, avg(hours_worked) AS avg_hours,
              coalesce(sum(overtime_hours), 0) AS total_overtime,
              CAST(100 AS DOUBLE) * count(*) FILTER (status = 'Present') / count(date) AS attendance_pct
       FROM att WHERE employee_id IS NOT NULL GROUP BY employee_id""",
)
def a06(spark: SparkSession, d: str) -> DataFrame:
    return A.employee_summary(V.att(spark, d), digits=None)


@query(
    "a07_daily_summary",
    """SELECT CAST(date AS VARCHAR) AS date, count(DISTINCT employee_id) AS total_employees,
              count(*) FILTER (status = 'Present') AS present_count,
              count(*) FILTER (status = 'Absent') AS absent_count,
              count(*) FILTER (status = 'Late') AS late_count,
              count(*) FILTER (status = 'Work-From-Home') AS wfh_count,
              avg(hours_worked) AS avg_hours, coalesce(sum(overtime_hours), 0) AS total_overtime
       FROM att_ev WHERE date IS NOT NULL GROUP BY date""",
)
def a07(spark: SparkSession, d: str) -> DataFrame:
    return A.daily_summary(V.att_ev(spark, d))


@query(
    "a08_monthly_summary",
    """SELECT employee_id, strftime(date, '%Y-%m') AS year_month, count(date) AS working_days,
              count(*) FILTER (status = 'Present') AS present, count(*) FILTER (status = 'Absent') AS absent,
              coalesce(sum(hours_worked), 0) AS hours_worked, coalesce(sum(overtime_hours), 0) AS overtime
       FROM att WHERE employee_id IS NOT NULL AND date IS NOT NULL GROUP BY ALL""",
)
def a08(spark: SparkSession, d: str) -> DataFrame:
    return A.monthly_summary(V.att(spark, d))


@query(
    "a09_department_summary",
    """SELECT department, count(DISTINCT employee_id) AS headcount,
              CAST(100 AS DOUBLE) * count(*) FILTER (status = 'Present') / count(*) AS avg_attendance_pct,
              coalesce(sum(hours_worked), 0) AS total_hours, avg(overtime_hours) AS avg_overtime
       FROM att WHERE department IS NOT NULL GROUP BY department""",
)
def a09(spark: SparkSession, d: str) -> DataFrame:
    return A.department_summary(V.att(spark, d), digits=None)


@query(
    "a10_department_attendance",
    """SELECT department, count(*) AS total_records, count(*) FILTER (status = 'Present') AS present,
              avg(hours_worked) AS avg_hours, sum(overtime_hours) AS total_overtime
       FROM att GROUP BY department""",
)
def a10(spark: SparkSession, d: str) -> DataFrame:
    return A.department_attendance(V.att(spark, d), digits=None)


@query(
    "a11_monthly_trend",
    """SELECT strftime(date, '%Y-%m') AS month, count(DISTINCT employee_id) AS active_employees,
              count(*) FILTER (status = 'Present') AS present_count, avg(hours_worked) AS avg_hours
       FROM att GROUP BY month""",
)
def a11(spark: SparkSession, d: str) -> DataFrame:
    return A.monthly_trend(V.att(spark, d), digits=None)


@query(
    "a12_monthly_present",
    """SELECT strftime(date, '%Y-%m') AS month, count(*) FILTER (status = 'Present') AS present_count
       FROM att GROUP BY month""",
)
def a12(spark: SparkSession, d: str) -> DataFrame:
    return A.monthly_present(V.att(spark, d))


@query(
    "a13_department_status_counts",
    """SELECT department, status, count(*) AS count FROM att GROUP BY department, status
       ORDER BY department NULLS FIRST, count DESC, status NULLS FIRST LIMIT 20""",
)
def a13(spark: SparkSession, d: str) -> DataFrame:
    return A.department_status_counts(V.att(spark, d))


@query(
    "a14_department_month_rates",
    """SELECT department, year(date) AS year, month(date) AS month, count(employee_id) AS total,
              count(*) FILTER (status = 'Present') AS present,
              CAST(100 AS DOUBLE) * count(*) FILTER (status = 'Present') / count(employee_id) AS attendance_pct
       FROM att WHERE department IS NOT NULL GROUP BY ALL""",
)
def a14(spark: SparkSession, d: str) -> DataFrame:
    return A.department_month_rates(feature_columns(V.att(spark, d)), digits=None)


@query(
    "a14_department_month_rates_warehouse",
    """SELECT department, CAST(CAST(date_trunc('month', date) AS DATE) AS VARCHAR) AS month, count(*) AS total,
              count(*) FILTER (status = 'Present') AS present,
              CAST(100 AS DOUBLE) * count(*) FILTER (status = 'Present') / count(*) AS attendance_pct
       FROM att GROUP BY ALL""",
)
def a14b(spark: SparkSession, d: str) -> DataFrame:
    return A.department_month_rates_warehouse(V.att(spark, d), digits=None)


@query(
    "a15_top_overtime",
    """SELECT employee_id, sum(overtime_hours) AS total_ot, count(*) AS records FROM att
       WHERE overtime_hours > 0 GROUP BY employee_id ORDER BY total_ot DESC, employee_id LIMIT 10""",
)
def a15(spark: SparkSession, d: str) -> DataFrame:
    return A.top_overtime(V.att(spark, d))


@query(
    "a15_top_overtime_names",
    """WITH t AS (SELECT employee_id, sum(overtime_hours) AS total_ot FROM att GROUP BY employee_id)
       SELECT name, department, total_ot FROM t JOIN emp USING (employee_id)
       ORDER BY total_ot DESC, employee_id LIMIT 5""",
)
def a15b(spark: SparkSession, d: str) -> DataFrame:
    return A.top_overtime_names(V.emp(spark, d), V.att(spark, d))


@query(
    "a16_absence_by_day",
    """SELECT isodow(date) - 1 AS day_num, count(*) AS absent_count,
              CAST(100 AS DOUBLE) * count(*) / CAST(sum(count(*)) OVER () AS BIGINT) AS pct
       FROM att WHERE status = 'Absent' GROUP BY day_num""",
)
def a16(spark: SparkSession, d: str) -> DataFrame:
    return A.absence_by_day_number(V.att(spark, d), digits=None)


@query(
    "a17_late_by_department",
    """SELECT department, count(*) FILTER (status = 'Late') AS late_count, avg(hours_worked) AS avg_hours
       FROM att WHERE department IS NOT NULL GROUP BY department""",
)
def a17(spark: SparkSession, d: str) -> DataFrame:
    return A.late_by_department(V.att(spark, d), digits=None)


@query(
    "a18_wfh_by_month",
    """SELECT year(date) AS year, month(date) AS month, count(*) AS count FROM att
       WHERE status = 'Work-From-Home' GROUP BY ALL""",
)
def a18(spark: SparkSession, d: str) -> DataFrame:
    return A.wfh_by_month(V.att(spark, d))


@query(
    "a19_hours_by_department",
    "SELECT department, avg(hours_worked) AS avg_hours FROM att WHERE department IS NOT NULL GROUP BY department",
)
def a19(spark: SparkSession, d: str) -> DataFrame:
    return A.hours_by_department(V.att(spark, d))


@query(
    "a20_hours_per_row",
    """SELECT department, coalesce(sum(hours_worked), 0) / count(*) AS avg_hours, count(*) AS total_rows
       FROM att WHERE department IS NOT NULL GROUP BY department""",
)
def a20(spark: SparkSession, d: str) -> DataFrame:
    return A.hours_per_row_by_department(V.att(spark, d))


@query(
    "a21_overtime_by_department_exact",
    """SELECT e.department, avg(a.overtime_hours) AS avg_overtime, max(a.overtime_hours) AS max_overtime,
              quantile_cont(a.overtime_hours, 0.5) AS median_overtime
       FROM att a JOIN emp e ON a.employee_id = e.employee_id WHERE a.overtime_hours > 0 GROUP BY e.department""",
)
def a21(spark: SparkSession, d: str) -> DataFrame:
    return A.overtime_by_department_exact(V.emp(spark, d), V.att(spark, d))


@query(
    "a21_overtime_by_department",
    """SELECT e.department, avg(a.overtime_hours) AS avg_overtime, max(a.overtime_hours) AS max_overtime,
              quantile_disc(a.overtime_hours, 0.5) AS median_overtime
       FROM att a JOIN emp e ON a.employee_id = e.employee_id WHERE a.overtime_hours > 0 GROUP BY e.department""",
)
def a21b(spark: SparkSession, d: str) -> DataFrame:
    return A.overtime_by_department(V.emp(spark, d), V.att(spark, d))


@query(
    "a24_kpis",
    """SELECT (SELECT count(DISTINCT employee_id) FROM att) AS total_employees,
              CAST(100 AS DOUBLE) * avg(CASE WHEN status = 'Present' THEN 1 ELSE 0 END) AS attendance_rate,
              avg(coalesce(hours_worked, 0)) AS avg_hours, CAST(trunc(sum(overtime_hours)) AS BIGINT) AS total_overtime,
              count(*) FILTER (status = 'Absent') AS absent_records,
              CAST(100 AS DOUBLE) * avg(CASE WHEN status = 'Present' THEN 1 ELSE 0 END) - 85 AS vs_target
       FROM att WHERE department = 'Accounts'""",
)
def a24(spark: SparkSession, d: str) -> DataFrame:
    base = dashboard_columns(V.att(spark, d))
    return A.kpis(base, filter_by(base, department="Accounts", month="All", status=None), digits=None)


@query(
    "a25_daily_kpi",
    """SELECT '2001-07-31' AS date, count(*) AS total_records,
              CAST(100 AS DOUBLE) * avg(CASE WHEN status = 'Present' THEN 1 ELSE 0 END) AS present_pct,
              avg(least(greatest(coalesce(hours_worked, 0), 0), 14)) AS avg_hours,
              sum(CASE WHEN overtime_hours > 4 THEN 4 ELSE overtime_hours END) AS total_overtime
       FROM att_raw WHERE employee_id IS NOT NULL AND TRY_CAST(date AS DATE) IS NOT NULL""",
)
def a25(spark: SparkSession, d: str) -> DataFrame:
    return A.daily_kpi(daily_transform(V.att_raw(spark, d)), AS_OF, digits=None)


@query(
    "a26_monthly_rate",
    """SELECT strftime(date, '%Y-%m') AS month,
              CAST(100 AS DOUBLE) * avg(CASE WHEN status = 'Present' THEN 1 ELSE 0 END) AS attendance_pct
       FROM att GROUP BY month""",
)
def a26(spark: SparkSession, d: str) -> DataFrame:
    return A.monthly_rate(V.att(spark, d), digits=None)


MONTHS = ["2001-02", "2001-03", "2001-04", "2001-05", "2001-06", "2001-07"]


@query(
    "a27_department_month_matrix",
    "SELECT department, "
    + ", ".join(
        f"CAST(100 AS DOUBLE) * avg(CASE WHEN status = 'Present' THEN 1 ELSE 0 END) "
        f"FILTER (strftime(date, '%Y-%m') = '{m}') AS \"{m}\""
        for m in MONTHS
    )
    + " FROM att WHERE department IS NOT NULL GROUP BY department",
)
def a27(spark: SparkSession, d: str) -> DataFrame:
    return A.department_month_matrix(dashboard_columns(V.att(spark, d)), MONTHS, digits=None)


@query(
    "a28_overtime_totals",
    """SELECT department, coalesce(sum(overtime_hours), 0) AS overtime_hours FROM att
       WHERE department IS NOT NULL GROUP BY department""",
)
def a28(spark: SparkSession, d: str) -> DataFrame:
    return A.overtime_totals(V.att(spark, d))


@query(
    "a29_weekday_rates",
    """SELECT day_of_week, CAST(100 AS DOUBLE) * avg(CASE WHEN status = 'Present' THEN 1 ELSE 0 END) AS attendance_pct
       FROM att WHERE isodow(date) < 6 GROUP BY day_of_week""",
)
def a29(spark: SparkSession, d: str) -> DataFrame:
    return A.weekday_rates(V.att(spark, d), digits=None)


@query(
    "a30_request_report",
    """WITH log AS (SELECT CASE event_type WHEN 'view' THEN 200 WHEN 'click' THEN 201 WHEN 'signup' THEN 299
                                WHEN 'purchase' THEN 302 ELSE 500 END AS status_code,
                           floor(value * 2) / 2 AS latency_ms FROM events)
       SELECT count(*) AS total_requests, count(*) FILTER (status_code BETWEEN 200 AND 299) AS successful,
              avg(latency_ms) AS avg_latency_ms, max(latency_ms) AS max_latency_ms, min(latency_ms) AS min_latency_ms
       FROM log""",
)
def a30(spark: SparkSession, d: str) -> DataFrame:
    kind = F.col("event_type")
    code = (
        F.when(kind == "view", 200).when(kind == "click", 201).when(kind == "signup", 299)
        .when(kind == "purchase", 302).otherwise(500)
    )
    log = V.table(spark, d, "events").select(
        code.alias("status_code"), (F.floor(F.col("value") * 2) / F.lit(2.0)).alias("latency_ms")
    )
    return A.request_report(log, digits=None)


@query(
    "a31_approx_distinct_employees",
    """SELECT CAST(date AS VARCHAR) AS date, count(DISTINCT employee_id) AS employees, true AS within_five_percent FROM att_ev GROUP BY 1""",
)
def a31(spark: SparkSession, d: str) -> DataFrame:
    rows = V.att_ev(spark, d)
    exact = rows.select("date", "employee_id").distinct().groupBy("date").agg(F.count("employee_id").alias("employees"))
    near = A.approx_distinct(rows, "date", "employee_id", rsd=0.01).withColumnRenamed("date", "_date")
    return exact.join(near, exact["date"].eqNullSafe(near["_date"])).select(
        "date", "employees", (F.abs(F.col("approx") - F.col("employees")) <= 0.05 * F.col("employees")).alias("within_five_percent"))
