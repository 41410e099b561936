"""Queries for projection, filter, join, order and set operators."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollcall.functions.scalar import is_weekend, iso_week, year_month
from rollcall.operators import relational as R
from rollcall.operators.aggregates import rows
from rollcall.operators.quality import schema_gate
from rollcall.operators.tableops import upsert
from rollcall.queries import views as V
from rollcall.queries.common import AS_OF
from rollcall.queries.registry import query

JUNE, JULY = date(2001, 6, 1), date(2001, 7, 31)


@query("p01_employee_columns", "SELECT employee_id, name, department FROM emp")
def p01(spark: SparkSession, d: str) -> DataFrame:
    return V.emp(spark, d).select("employee_id", "name", "department")


@query(
    "p02_department_staff",
    "SELECT employee_id, name, designation, salary FROM emp WHERE department = 'Research'",
)
def p02(spark: SparkSession, d: str) -> DataFrame:
    return R.department_staff(V.emp(spark, d), "Research")


@query(
    "p03_worked_statuses",
    "SELECT attendance_id, status FROM att WHERE status IN ('Present', 'Late', 'Work-From-Home')",
)
def p03(spark: SparkSession, d: str) -> DataFrame:
    att = V.att(spark, d)
    return att.filter(F.col("status").isin("Present", "Late", "Work-From-Home")).select("attendance_id", "status")


@query(
    "p04_current_month",
    """SELECT attendance_id, CAST(date AS VARCHAR) AS date FROM att
       WHERE strftime(date, '%Y-%m') = '2001-07'""",
)
def p04(spark: SparkSession, d: str) -> DataFrame:
    return R.in_month_of(V.att(spark, d), AS_OF).select("attendance_id", "date")


@query(
    "p05_last_30_days",
    """SELECT attendance_id, CAST(date AS VARCHAR) AS date FROM att
       WHERE date >= DATE '2001-07-31' - INTERVAL 30 DAY""",
)
def p05(spark: SparkSession, d: str) -> DataFrame:
    return R.since_days(V.att(spark, d), AS_OF, 30).select("attendance_id", "date")


@query(
    "p06_drop_incomplete",
    "SELECT attendance_id, employee_id, status FROM att_raw WHERE employee_id IS NOT NULL AND status IS NOT NULL",
)
def p06(spark: SparkSession, d: str) -> DataFrame:
    rows_ = V.att_raw(spark, d).dropna(subset=["employee_id", "status"])
    return rows_.select("attendance_id", "employee_id", "status")


@query(
    "p07_drop_empty_rows",
    """SELECT status, hours_worked, notes, count(*) AS n FROM att
       WHERE NOT (status IS NULL AND hours_worked IS NULL AND notes IS NULL) GROUP BY ALL""",
)
def p07(spark: SparkSession, d: str) -> DataFrame:
    cols = ["status", "hours_worked", "notes"]
    return V.att(spark, d).select(*cols).dropna(how="all").groupBy(*cols).agg(rows().alias("n"))


@query(
    "p08_nan_to_null",
    "SELECT attendance_id, CASE WHEN attendance_id % 20 <> 7 THEN hours_worked END AS hours_worked FROM att",
)
def p08(spark: SparkSession, d: str) -> DataFrame:
    with_nan = V.att(spark, d).select(
        "attendance_id", F.coalesce("hours_worked", F.lit(float("nan"))).alias("hours_worked")
    )
    return R.nan_as_null(with_nan)


@query("p09_positive_overtime", "SELECT attendance_id, overtime_hours FROM att WHERE overtime_hours > 0")
def p09(spark: SparkSession, d: str) -> DataFrame:
    return V.att(spark, d).filter(F.col("overtime_hours") > 0).select("attendance_id", "overtime_hours")


@query(
    "p10_above_average_hours",
    "SELECT attendance_id, hours_worked FROM att WHERE hours_worked > (SELECT avg(hours_worked) FROM att)",
)
def p10(spark: SparkSession, d: str) -> DataFrame:
    return R.above_average(V.att(spark, d).select("attendance_id", "hours_worked"), "hours_worked")


@query(
    "p11_having_on_alias",
    "SELECT location, count(*) AS records, avg(hours_worked) AS avg_hours FROM att GROUP BY location HAVING avg(hours_worked) > 7.5",
)
def p11(spark: SparkSession, d: str) -> DataFrame:
    per = V.att(spark, d).groupBy("location").agg(rows().alias("records"), F.avg("hours_worked").alias("avg_hours"))
    return per.filter(F.col("avg_hours") > 7.5)


@query(
    "p12_optional_filters",
    "SELECT attendance_id, department, status FROM att WHERE department = 'Accounts' AND status = 'Late'",
)
def p12(spark: SparkSession, d: str) -> DataFrame:
    chosen = R.filter_by(V.att(spark, d), department="Accounts", shift="All", location=None, status="Late")
    return chosen.select("attendance_id", "department", "status")


@query(
    "p13_last_six_months",
    """SELECT DISTINCT strftime(date, '%Y-%m') AS month FROM att WHERE date IS NOT NULL
       ORDER BY month DESC LIMIT 6""",
)
def p13(spark: SparkSession, d: str) -> DataFrame:
    months = V.att(spark, d).select(year_month("date").alias("month"))
    return R.latest_values(months, "month", 6)


@query("p13_departments", "SELECT DISTINCT department FROM att WHERE department IS NOT NULL")
def p13b(spark: SparkSession, d: str) -> DataFrame:
    return R.distinct_values(V.att(spark, d), "department")


@query("p14_rename", "SELECT department_name AS department, head FROM dept")
def p14(spark: SparkSession, d: str) -> DataFrame:
    return V.dept(spark, d).withColumnRenamed("department_name", "department").select("department", "head")


@query(
    "p15_calendar_columns",
    """SELECT attendance_id, isodow(date) >= 6 AS is_weekend, month(date) AS month, year(date) AS year,
              week(date) AS week FROM att""",
)
def p15(spark: SparkSession, d: str) -> DataFrame:
    att = V.att(spark, d).select("attendance_id", "date")
    return att.withColumns(
        {
            "is_weekend": is_weekend("date"),
            "month": F.month("date"),
            "year": F.year("date"),
            "week": iso_week("date"),
        }
    ).drop("date")


@query("p16_existing_columns", "SELECT employee_id, salary FROM emp")
def p16(spark: SparkSession, d: str) -> DataFrame:
    emp = V.emp(spark, d)
    return emp.select(*R.existing(emp, ["employee_id", "bonus", "salary", "grade"]))


@query(
    "p17_sample",
    "SELECT attendance_id, status FROM att WHERE substr(md5(CAST(attendance_id AS VARCHAR) || '#7'), 1, 8) < '0ccccccc'",
)
def p17(spark: SparkSession, d: str) -> DataFrame:
    return R.sample_rows(V.att(spark, d).select("attendance_id", "status"), "attendance_id", 0.05, seed=7)


@query(
    "p18_make_dirty",
    """SELECT attendance_id,
              CASE WHEN NOT substr(md5(CAST(attendance_id AS VARCHAR) || '#1'), 1, 8) < '0ccccccc' THEN hours_worked END AS hours_worked,
              CASE WHEN NOT substr(md5(CAST(attendance_id AS VARCHAR) || '#2'), 1, 8) < '051eb851' THEN status END AS status
       FROM att""",
)
def p18(spark: SparkSession, d: str) -> DataFrame:
    return R.make_dirty(V.att(spark, d).select("attendance_id", "hours_worked", "status"))


# --- joins -------------------------------------------------------------------------------

@query(
    "j01_inner_join",
    """SELECT a.attendance_id, a.employee_id, e.name, a.status FROM att a
       JOIN emp e ON a.employee_id = e.employee_id""",
)
def j01(spark: SparkSession, d: str) -> DataFrame:
    joined = R.with_employee(V.att(spark, d), V.emp(spark, d))
    return joined.select("attendance_id", "employee_id", "name", "status")


@query(
    "j02_left_join",
    """SELECT e.employee_id, count(a.attendance_id) AS records FROM emp e
       LEFT JOIN att a ON e.employee_id = a.employee_id GROUP BY e.employee_id""",
)
def j02(spark: SparkSession, d: str) -> DataFrame:
    # records are counted before the join: one row per employee meets the employee table
    counts = V.att(spark, d).groupBy("employee_id").agg(rows().alias("records"))
    people = V.emp(spark, d).select("employee_id")
    return people.join(counts, "employee_id", "left").fillna(0, subset=["records"])


@query(
    "j03_enrich",
    """SELECT a.attendance_id, a.employee_id, a.department, e.name, e.designation, e.salary,
              CAST(e.join_date AS VARCHAR) AS join_date, e.is_active, p.head
       FROM att a LEFT JOIN emp e ON a.employee_id = e.employee_id
       LEFT JOIN dept p ON a.department = p.department_name""",
)
def j03(spark: SparkSession, d: str) -> DataFrame:
    att = V.att(spark, d).select("attendance_id", "employee_id", "department")
    return R.enrich(att, V.emp(spark, d), V.dept(spark, d))


@query(
    "j04_above_average_overtime",
    """SELECT e.employee_id, e.name, e.department, s.avg_overtime FROM emp e
       JOIN (SELECT employee_id, avg(overtime_hours) AS avg_overtime FROM att GROUP BY employee_id
             HAVING avg(overtime_hours) > (SELECT avg(overtime_hours) FROM att)) s USING (employee_id)""",
)
def j04(spark: SparkSession, d: str) -> DataFrame:
    return R.above_average_overtime(V.emp(spark, d), V.att(spark, d))


_MANAGER_SQL = """
    SELECT staff.employee_id AS emp_id, CAST(away.date AS VARCHAR) AS date, staff.manager_id,
           boss.status AS manager_status, count(*) AS matches
    FROM emp staff, att_ev away, att_ev boss
    WHERE away.employee_id = staff.employee_id AND away.status = 'Absent'
      AND boss.employee_id = staff.manager_id AND boss.status = 'Present' AND boss.date = away.date
    GROUP BY ALL"""


@query("j05_absent_while_manager_present", _MANAGER_SQL)
def j05(spark: SparkSession, d: str) -> DataFrame:
    return R.absent_while_manager_present(V.emp(spark, d), V.att_ev(spark, d))


_ONE_MANAGER = "(SELECT min(employee_id) FROM emp)"


@query(
    "j05_one_manager_for_a_third",
    _MANAGER_SQL.replace("FROM emp staff,", f"""FROM (
        SELECT * REPLACE (CASE WHEN salary < (SELECT quantile_disc(salary, 0.34) FROM emp) THEN {_ONE_MANAGER} ELSE manager_id END AS manager_id)
        FROM emp) staff,"""),
)
def j05_hot(spark: SparkSession, d: str) -> DataFrame:
    # a third of the staff under one manager, dealt over blocks of 50
    emp = V.emp(spark, d)
    first = emp.agg(F.min("employee_id")).scalar()
    low = emp.agg(F.expr("percentile_disc(0.34) WITHIN GROUP (ORDER BY salary)")).scalar()
    led = emp.withColumn("manager_id", F.when(F.col("salary") < low, first).otherwise(F.col("manager_id")))
    return R.absent_while_manager_present(led, V.att_ev(spark, d), staff=50)


@query(
    "j06_orphans",
    """SELECT attendance_id, employee_id FROM att_raw
       WHERE employee_id IS NULL OR employee_id NOT IN (SELECT employee_id FROM emp WHERE is_active)""",
)
def j06(spark: SparkSession, d: str) -> DataFrame:
    active = V.emp(spark, d).filter("is_active")
    return R.orphans(V.att_raw(spark, d).select("attendance_id", "employee_id"), "employee_id", active, "employee_id")


@query(
    "j08_complete_weekdays",
    """SELECT w.day_of_week, r.records FROM (VALUES ('Monday'), ('Tuesday'), ('Wednesday'), ('Thursday'),
              ('Friday')) w(day_of_week)
       LEFT JOIN (SELECT day_of_week, count(*) AS records FROM att WHERE status = 'On-Leave'
                  AND department = 'Counsel' AND strftime(date, '%Y-%m') = '2001-07' GROUP BY day_of_week) r
         ON w.day_of_week = r.day_of_week""",
)
def j08(spark: SparkSession, d: str) -> DataFrame:
    july = R.in_month_of(R.filter_by(V.att(spark, d), status="On-Leave", department="Counsel"), AS_OF)
    counts = july.groupBy("day_of_week").agg(rows().alias("records"))
    return R.complete_categories(counts, "day_of_week", R.WORKDAYS)


@query(
    "j09_missing_days",
    """SELECT s.employee_id, CAST(s.date AS VARCHAR) AS date FROM (
           SELECT employee_id, CAST(unnest(generate_series(DATE '2001-06-01', DATE '2001-07-31', INTERVAL 1 DAY)) AS DATE) AS date
           FROM emp) s
       WHERE isodow(s.date) < 6
         AND NOT EXISTS (SELECT 1 FROM att a WHERE a.employee_id = s.employee_id AND a.date = s.date)""",
)
def j09(spark: SparkSession, d: str) -> DataFrame:
    return R.missing_days(V.emp(spark, d), V.att(spark, d), JUNE, JULY)


@query(
    "j10_upsert_join",
    """SELECT e.employee_id, e.name, CASE WHEN c.employee_id IS NOT NULL THEN c.total ELSE e.salary END AS salary
       FROM emp e LEFT JOIN (SELECT employee_id, count(*) * CAST(100 AS DOUBLE) AS total FROM att
                             WHERE status = 'Present' GROUP BY employee_id) c ON e.employee_id = c.employee_id""",
)
def j10(spark: SparkSession, d: str) -> DataFrame:
    pay = V.att(spark, d).filter("status = 'Present'").groupBy("employee_id").agg((rows() * F.lit(100.0)).alias("salary"))
    return upsert(V.emp(spark, d).select("employee_id", "name", "salary"), pay, ["employee_id"])


# --- order, set operations -----------------------------------------------------------------

@query(
    "o01_mixed_order",
    "SELECT department, status, count(*) AS count FROM att GROUP BY department, status",
)
def o01(spark: SparkSession, d: str) -> DataFrame:
    counts = V.att(spark, d).groupBy("department", "status").agg(rows().alias("count"))
    return counts.orderBy(F.col("department").asc_nulls_first(), F.desc("count"), F.col("status").asc_nulls_first())


@query(
    "o02_latest_100",
    _MANAGER_SQL + " ORDER BY date DESC, emp_id LIMIT 100",
)
def o02(spark: SparkSession, d: str) -> DataFrame:
    return R.latest_absences_while_manager_present(V.emp(spark, d), V.att_ev(spark, d), 100)


@query(
    "o03_preview",
    "SELECT attendance_id, employee_id, status FROM att ORDER BY attendance_id LIMIT 100",
)
def o03(spark: SparkSession, d: str) -> DataFrame:
    return R.preview(V.att(spark, d).select("attendance_id", "employee_id", "status"), 100, ["attendance_id"])


@query(
    "u01_append",
    """SELECT attendance_id, status, overtime_hours FROM att
       UNION ALL SELECT attendance_id, status, NULL FROM att_ev""",
)
def u01(spark: SparkSession, d: str) -> DataFrame:
    more = V.att_ev(spark, d).select("attendance_id", "status")
    return R.append_rows(V.att(spark, d).select("attendance_id", "status", "overtime_hours"), more)


@query("u02_concatenate", "SELECT employee_id, name FROM emp UNION ALL SELECT employee_id, name FROM emp")
def u02(spark: SparkSession, d: str) -> DataFrame:
    people = V.emp(spark, d).select("employee_id", "name")
    return R.append_rows(people, people)


@query("u03_distinct_dates", "SELECT DISTINCT CAST(date AS VARCHAR) AS date FROM att")
def u03(spark: SparkSession, d: str) -> DataFrame:
    return V.att(spark, d).select("date").distinct()


@query(
    "u04_differences",
    """WITH l AS (SELECT status, shift, count(*) AS n FROM att WHERE hours_worked IS NOT NULL GROUP BY ALL),
            r AS (SELECT status, shift, count(*) AS n FROM att WHERE overtime_hours > 0 GROUP BY ALL)
       SELECT coalesce(l.status, r.status) AS status, coalesce(l.shift, r.shift) AS shift,
              CASE WHEN coalesce(l.n, 0) > coalesce(r.n, 0) THEN 'left' ELSE 'right' END AS side,
              abs(coalesce(l.n, 0) - coalesce(r.n, 0)) AS copies
       FROM l FULL JOIN r ON l.status IS NOT DISTINCT FROM r.status AND l.shift IS NOT DISTINCT FROM r.shift
       WHERE coalesce(l.n, 0) <> coalesce(r.n, 0)""",
)
def u04(spark: SparkSession, d: str) -> DataFrame:
    att = V.att(spark, d)
    return R.differences(att.filter("hours_worked IS NOT NULL"), att.filter("overtime_hours > 0"), ["status", "shift"])


@query(
    "d01_required_columns",
    """SELECT 'attendance' AS "table", true AS accepted, count(*) AS "rows" FROM att
       UNION ALL SELECT 'employees', true, count(*) FROM emp
       UNION ALL SELECT 'departments', true, count(*) FROM dept
       UNION ALL SELECT 'leaves', true, count(*) FROM leaves""",
)
def d01(spark: SparkSession, d: str) -> DataFrame:
    tables = {"attendance": V.att, "employees": V.emp, "departments": V.dept, "leaves": V.leaves}
    out = None
    for name, view in tables.items():
        df = view(spark, d)
        part = df.agg(rows().alias("rows")).withColumns({"table": F.lit(name), "accepted": F.lit(schema_gate(df, name))})
        out = part if out is None else out.unionByName(part)
    return out
