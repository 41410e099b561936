"""Queries for cleaning, the star schema and the jobs built from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollcall.operators import cleaning as C
from rollcall.operators import warehouse as M
from rollcall.operators.aggregates import employee_summary, rows
from rollcall.operators.relational import differences
from rollcall.plans import batch
from rollcall.plans.daily import daily_run
from rollcall.queries import views as V
from rollcall.queries.common import AS_OF, union_all
from rollcall.queries.registry import query
from rollcall.session import shared_path

_DIM_DATE = """
    SELECT DISTINCT CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_key, CAST(date AS VARCHAR) AS full_date,
           dayname(date) AS day_of_week, day(date) AS day_num, week(date) AS week_num, month(date) AS month_num,
           monthname(date) AS month_name, quarter(date) AS quarter, year(date) AS year,
           isodow(date) >= 6 AS is_weekend, false AS is_holiday FROM att"""


@query("m01_dim_date", _DIM_DATE)
def m01(spark: SparkSession, d: str) -> DataFrame:
    return M.dim_date(V.att(spark, d))


_DIM_EMPLOYEE = """
    SELECT row_number() OVER (ORDER BY employee_id) AS emp_key, employee_id, name, department, designation, location,
           salary, CASE WHEN salary <= 0 THEN NULL WHEN salary <= 40000 THEN 'Junior' WHEN salary <= 80000 THEN 'Mid'
                        WHEN salary <= 150000 THEN 'Senior' ELSE 'Executive' END AS salary_band,
           CAST(join_date AS VARCHAR) AS effective_from, CAST(NULL AS VARCHAR) AS effective_to, true AS is_current FROM emp"""


@query("m02_dim_employee", _DIM_EMPLOYEE)
def m02(spark: SparkSession, d: str) -> DataFrame:
    return M.dim_employee(V.emp(spark, d))


_DIM_DEPARTMENT = """
    SELECT row_number() OVER (ORDER BY department_name) AS dept_key, department_name AS department, head, budget,
           CASE WHEN budget <= 0 THEN NULL WHEN budget <= 1000000 THEN 'Small' WHEN budget <= 3000000 THEN 'Medium'
                ELSE 'Large' END AS budget_tier FROM dept"""


@query("m03_dim_department", _DIM_DEPARTMENT)
def m03(spark: SparkSession, d: str) -> DataFrame:
    return M.dim_department(V.dept(spark, d))


_FACT = f"""
    WITH de AS ({_DIM_EMPLOYEE}), dd AS ({_DIM_DEPARTMENT})
    SELECT a.attendance_id AS fact_id, CAST(strftime(a.date, '%Y%m%d') AS INTEGER) AS date_key, de.emp_key, dd.dept_key,
           CASE a.shift WHEN 'Morning' THEN 1 WHEN 'Afternoon' THEN 2 WHEN 'Night' THEN 3 END AS shift_key,
           a.status, a.hours_worked, a.overtime_hours, CASE WHEN a.status = 'Present' THEN 1 ELSE 0 END AS is_present,
           CASE WHEN a.status = 'Absent' THEN 1 ELSE 0 END AS is_absent, CASE WHEN a.status = 'Late' THEN 1 ELSE 0 END AS is_late,
           CASE WHEN a.status = 'Work-From-Home' THEN 1 ELSE 0 END AS is_wfh
    FROM att a LEFT JOIN de ON a.employee_id = de.employee_id LEFT JOIN dd ON a.department = dd.department"""


@query("m05_fact_attendance", _FACT)
def m05(spark: SparkSession, d: str) -> DataFrame:
    employees, departments = M.dim_employee(V.emp(spark, d)), M.dim_department(V.dept(spark, d))
    return M.fact_attendance(V.att(spark, d), employees, departments)


@query(
    "j07_dimension_lookup",
    f"""WITH de AS ({_DIM_EMPLOYEE})
        SELECT s.shift_name, de.salary_band, count(*) AS records FROM att a
        JOIN de ON a.employee_id = de.employee_id
        JOIN (VALUES ('Morning'), ('Afternoon'), ('Night')) s(shift_name) ON a.shift = s.shift_name GROUP BY ALL""",
)
def j07(spark: SparkSession, d: str) -> DataFrame:
    employees, departments = M.dim_employee(V.emp(spark, d)), M.dim_department(V.dept(spark, d))
    fact = M.fact_attendance(V.att(spark, d), employees, departments)
    return (
        fact.groupBy("shift_key", "emp_key").agg(rows().alias("_n"))
        .join(M.dim_shift(spark), "shift_key")
        .join(employees.select("emp_key", "salary_band"), "emp_key")
        .groupBy("shift_name", "salary_band")
        .agg(F.sum("_n").alias("records"))
    )


_CLEAN = """
    attendance_id, employee_id, CAST(TRY_CAST(date AS DATE) AS VARCHAR) AS date, coalesce(status, 'Unknown') AS status,
    least(greatest(coalesce(hours_worked, 0), 0), 14) AS hours_worked,
    CASE WHEN overtime_hours > 4 THEN 4 WHEN overtime_hours < 0 THEN 0 ELSE overtime_hours END AS overtime_hours,
    CASE WHEN status = 'Present' THEN 1 ELSE 0 END AS is_present"""
_READABLE = "FROM att_raw WHERE employee_id IS NOT NULL AND TRY_CAST(date AS DATE) IS NOT NULL"
_SCORE = "least(greatest(coalesce(hours_worked, 0) / 8, 0), 1.5) AS productivity_score"
_BASE = ["attendance_id", "employee_id", "date", "status", "hours_worked", "overtime_hours", "is_present"]


@query(
    "m06_etl_clean",
    f"""SELECT {_CLEAN}, strftime(TRY_CAST(date AS DATE), '%Y-%m') AS year_month,
               isodow(TRY_CAST(date AS DATE)) >= 6 AS is_weekend, {_SCORE} {_READABLE}""",
)
def m06(spark: SparkSession, d: str) -> DataFrame:
    cleaned = C.etl_clean(V.att_raw(spark, d), digits=None)
    return cleaned.select(*_BASE, "year_month", "is_weekend", "productivity_score")


@query(
    "m07_elt_clean",
    """SELECT * EXCLUDE (notes) REPLACE (
                  coalesce(status, 'Unknown') AS status,
                  CASE WHEN hours_worked > 14 THEN 14 WHEN hours_worked > 0 THEN hours_worked ELSE 0 END AS hours_worked,
                  CASE WHEN overtime_hours > 4 THEN 4 WHEN overtime_hours > 0 THEN overtime_hours ELSE 0 END AS overtime_hours),
              CAST(coalesce(status = 'Present', false) AS INTEGER) AS is_present,
              CASE WHEN hours_worked > 12 THEN 1.5 WHEN hours_worked > 0 THEN hours_worked / 8 ELSE 0 END AS productivity_score
       FROM att_raw WHERE employee_id IS NOT NULL AND date IS NOT NULL""",
)
def m07(spark: SparkSession, d: str) -> DataFrame:
    return C.elt_clean(V.att_raw(spark, d), digits=None)


@query(
    "m08_etl_elt_differences",
    """SELECT 'left' AS side, count(*) AS "rows" FROM att_raw
       WHERE employee_id IS NOT NULL AND date <> 'not-a-date' AND overtime_hours IS NULL
       UNION ALL SELECT 'right', count(*) FROM att_raw
       WHERE employee_id IS NOT NULL AND (date = 'not-a-date' OR overtime_hours IS NULL)""",
)
def m08(spark: SparkSession, d: str) -> DataFrame:
    raw = V.att_raw(spark, d)
    shared = ["attendance_id", "employee_id", "status", "hours_worked", "overtime_hours", "is_present"]
    found = differences(C.etl_clean(raw), C.elt_clean(raw), shared)
    return found.groupBy("side").agg(F.sum("copies").alias("rows"))


_FIRST = """SELECT *, row_number() OVER (PARTITION BY employee_id, date ORDER BY attendance_id) AS rn FROM att_raw"""
_FILLED = """least(greatest(coalesce(hours_worked, CASE coalesce(status, 'Unknown') WHEN 'Present' THEN 8 WHEN 'Late' THEN 7
    WHEN 'Half-Day' THEN 4 WHEN 'Work-From-Home' THEN 8 ELSE 0 END), 0), 14) AS hours_worked"""
_ATT_CLEAN = f"""SELECT attendance_id, employee_id, TRY_CAST(date AS DATE) AS date, department,
        coalesce(status, 'Unknown') AS status, {_FILLED},
        CASE WHEN overtime_hours > 4 THEN 4 ELSE overtime_hours END AS overtime_hours
    FROM ({_FIRST}) WHERE rn = 1 AND TRY_CAST(date AS DATE) IS NOT NULL"""


@query("m09_clean_attendance", f"SELECT * REPLACE (CAST(date AS VARCHAR) AS date) FROM ({_ATT_CLEAN})")
def m09(spark: SparkSession, d: str) -> DataFrame:
    return C.clean_attendance(V.att_raw(spark, d)).select(
        "attendance_id", "employee_id", "date", "department", "status", "hours_worked", "overtime_hours"
    )


_EMP_CLEAN = """SELECT employee_id, name, trim(lower(email)) AS email, designation, is_active,
    CASE WHEN salary < 10000 THEN 10000 WHEN salary > 500000 THEN 500000 ELSE salary END AS salary, join_date FROM emp"""


@query("m10_clean_employees", f"SELECT * REPLACE (CAST(join_date AS VARCHAR) AS join_date) FROM ({_EMP_CLEAN})")
def m10(spark: SparkSession, d: str) -> DataFrame:
    emp = V.emp(spark, d)
    return C.clean_employees(emp.unionByName(emp)).select(
        "employee_id", "name", "email", "designation", "is_active", "salary", "join_date"
    )


_MERGED = f"""
    SELECT a.*, e.name, e.designation, e.salary, e.join_date, e.is_active, p.head, isodow(a.date) >= 6 AS is_weekend,
           month(a.date) AS month, year(a.date) AS year, week(a.date) AS week
    FROM ({_ATT_CLEAN}) a LEFT JOIN ({_EMP_CLEAN}) e ON a.employee_id = e.employee_id
    LEFT JOIN dept p ON a.department = p.department_name"""


def _merged(spark: SparkSession, d: str) -> DataFrame:
    frames = {"attendance": V.att_raw(spark, d), "employees": V.emp(spark, d), "departments": V.dept(spark, d)}
    return C.merge_datasets(frames).drop("day_of_week", "shift", "check_in", "check_out", "location", "notes")


@query(
    "m11_merge_datasets",
    f"SELECT * REPLACE (CAST(date AS VARCHAR) AS date, CAST(join_date AS VARCHAR) AS join_date) FROM ({_MERGED})",
)
def m11(spark: SparkSession, d: str) -> DataFrame:
    return _merged(spark, d)


@query(
    "m12_feature_columns",
    """SELECT attendance_id, CAST(TRY_CAST(date AS DATE) AS VARCHAR) AS date, month(TRY_CAST(date AS DATE)) AS month,
              year(TRY_CAST(date AS DATE)) AS year, isodow(TRY_CAST(date AS DATE)) - 1 AS day_num,
              coalesce(hours_worked, 0) AS hours_worked, coalesce(overtime_hours, 0) AS overtime_hours,
              coalesce(status, 'Unknown') AS status, CASE WHEN status = 'Present' THEN 1 ELSE 0 END AS is_present,
              CASE WHEN coalesce(hours_worked, 0) > 12 THEN 1.5 ELSE coalesce(hours_worked, 0) / 8 END AS productivity_score
       FROM att_raw""",
)
def m12(spark: SparkSession, d: str) -> DataFrame:
    return C.feature_columns(V.att_raw(spark, d), digits=None).select(
        "attendance_id", "date", "month", "year", "day_num", "hours_worked", "overtime_hours", "status",
        "is_present", "productivity_score",
    )


@query(
    "m13_daily_transform",
    f"""SELECT {_CLEAN}, month(TRY_CAST(date AS DATE)) AS month, year(TRY_CAST(date AS DATE)) AS year {_READABLE}""",
)
def m13(spark: SparkSession, d: str) -> DataFrame:
    return C.daily_transform(V.att_raw(spark, d)).select(*_BASE, "month", "year")


@query(
    "m14_dashboard_columns",
    """SELECT attendance_id, CAST(TRY_CAST(date AS DATE) AS VARCHAR) AS date, coalesce(status, 'Unknown') AS status,
              coalesce(hours_worked, 0) AS hours_worked, CASE WHEN status = 'Present' THEN 1 ELSE 0 END AS is_present,
              strftime(TRY_CAST(date AS DATE), '%Y-%m') AS month, week(TRY_CAST(date AS DATE)) AS week,
              year(TRY_CAST(date AS DATE)) AS year FROM att_raw""",
)
def m14(spark: SparkSession, d: str) -> DataFrame:
    return C.dashboard_columns(V.att_raw(spark, d)).select(
        "attendance_id", "date", "status", "hours_worked", "is_present", "month", "week", "year"
    )


# --- jobs ------------------------------------------------------------------------------

@query(
    "g01_batch_ingest",
    """SELECT CAST(4 AS BIGINT) AS files_processed, (SELECT count(*) FROM dept) + (SELECT count(*) FROM emp)
              + (SELECT count(*) FROM att_raw) + (SELECT count(*) FROM leaves) AS rows_ingested, CAST(0 AS BIGINT) AS files_failed""",
)
def g01(spark: SparkSession, d: str) -> DataFrame:
    root = shared_path(spark, "ingest")
    suffix = root[-12:]
    tables = {"departments": V.dept, "employees": V.emp, "attendance": V.att_raw, "leaves": V.leaves}
    results = []
    for name, view in tables.items():
        df = view(spark, d)
        stored = f"{name}_{suffix}"
        assert batch.quality.schema_gate(df, name)
        results.append(batch.ingest_table(df, stored, path=f"{root}/{name}"))
    return batch.ingest_report(spark, results).drop("seconds")


@query(
    "g02_merge_and_summarize",
    f"""SELECT employee_id, count(date) AS total_days, count(*) FILTER (status = 'Present') AS present_days,
               count(*) FILTER (status = 'Absent') AS absent_days, count(*) FILTER (status = 'Late') AS late_days,
               count(*) FILTER (status = 'Work-From-Home') AS wfh_days, sum(hours_worked) AS total_hours,
               avg(hours_worked) AS avg_hours, coalesce(sum(overtime_hours), 0) AS total_overtime,
               CAST(100 AS DOUBLE) * count(*) FILTER (status = 'Present') / count(date) AS attendance_pct
        FROM ({_MERGED}) WHERE employee_id IS NOT NULL GROUP BY employee_id""",
)
def g02(spark: SparkSession, d: str) -> DataFrame:
    return employee_summary(_merged(spark, d), digits=None)


@query(
    "g03_analysis",
    """SELECT department, coalesce(sum(hours_worked), 0) / count(*) AS avg_hours, count(*) AS total_rows
       FROM att WHERE department IS NOT NULL GROUP BY department""",
)
def g03(spark: SparkSession, d: str) -> DataFrame:
    return batch.analysis(V.att(spark, d), shared_path(spark, "analysis"))["department_hours"]


@query(
    "g04_daily_run",
    f"""SELECT 'loaded' AS status, (SELECT count(*) FROM att_raw) AS row_count, count(*) AS stored,
               count(*) FILTER (status = 'Present') AS present {_READABLE}""",
)
def g04(spark: SparkSession, d: str) -> DataFrame:
    root = shared_path(spark, "daily")
    raw = V.att_raw(spark, d).drop("notes")  # mostly empty by design
    outcome = daily_run(raw, V.emp(spark, d), AS_OF, root)
    stored = spark.read.parquet(f"{root}/dw_attendance_daily")
    return stored.agg(rows().alias("stored"), F.count_if(F.col("status") == "Present").alias("present")).withColumns(
        {"status": F.lit(outcome.status), "row_count": F.lit(outcome.row_count).cast("bigint")}
    )


_CELLS = ["attendance_id", "employee_id", "date", "day_of_week", "shift", "status", "check_in", "check_out",
          "hours_worked", "overtime_hours", "department", "location", "notes"]


@query(
    "g04_gate_decision",
    f"""SELECT CASE WHEN null_rate > 0.3::DOUBLE THEN 'failed' WHEN null_rate < 0.1::DOUBLE THEN 'loaded' ELSE 'alert' END AS status,
               row_count, round(null_rate, 6) AS null_rate
        FROM (SELECT count(*) AS row_count, CAST({len(_CELLS)} * count(*) - {" - ".join(f"count({c})" for c in _CELLS)} AS DOUBLE)
                     / (count(*) * {len(_CELLS)}) AS null_rate FROM att_raw)""",
)
def g04_gate(spark: SparkSession, d: str) -> DataFrame:
    # the whole table, with the column that is mostly empty
    outcome = daily_run(V.att_raw(spark, d), V.emp(spark, d), AS_OF, shared_path(spark, "daily"))
    return spark.range(1).select(
        F.lit(outcome.status).alias("status"), F.lit(outcome.row_count).cast("bigint").alias("row_count"),
        F.round(F.lit(outcome.null_rate), 6).alias("null_rate"))


@query(
    "g05_star_schema_load",
    f"""SELECT 'dim_date' AS "table", count(*) AS "rows" FROM ({_DIM_DATE}) UNION ALL SELECT 'dim_employee', count(*) FROM emp
        UNION ALL SELECT 'dim_department', count(*) FROM dept UNION ALL SELECT 'dim_shift', 3
        UNION ALL SELECT 'fact_attendance', count(*) FROM att""",
)
def g05(spark: SparkSession, d: str) -> DataFrame:
    stored = batch.load_star_schema(V.att(spark, d), V.emp(spark, d), V.dept(spark, d), shared_path(spark, "star"))
    return union_all([df.agg(rows().alias("rows")).withColumn("table", F.lit(n)) for n, df in stored.items()])


@query(
    "g06_sample_queries",
    """SELECT 'Attendance by department' AS report, 20 AS "rows" UNION ALL SELECT 'Top 5 overtime employees', 5
       UNION ALL SELECT 'Monthly attendance trend', count(DISTINCT strftime(date, '%Y-%m')) FROM att""",
)
def g06(spark: SparkSession, d: str) -> DataFrame:
    reports = batch.sample_queries(V.emp(spark, d), V.att(spark, d))
    return union_all([df.agg(rows().alias("rows")).withColumn("report", F.lit(n)) for n, df in reports.items()])


@query(
    "g07_attendance_suite",
    """SELECT year(date) AS year, month(date) AS month, count(*) AS count FROM att
       WHERE status = 'Work-From-Home' GROUP BY ALL""",
)
def g07(spark: SparkSession, d: str) -> DataFrame:
    return batch.attendance_suite(V.att(spark, d), shared_path(spark, "suite"))["wfh_by_month"]
