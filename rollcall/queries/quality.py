"""Queries for data-quality checks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollcall.operators import quality as Q
from rollcall.queries import views as V
from rollcall.queries.common import AS_OF
from rollcall.queries.registry import query

KEPT = ["check_name", "table", "column", "passed", "severity", "expected", "actual", "row_count"]
_STATUSES = "'Present', 'Absent', 'Late', 'Half-Day', 'Work-From-Home', 'On-Leave', 'Unknown'"
_SORTED = "in [''Absent'', ''Half-Day'', ''Late'', ''On-Leave'', ''Present'', ''Unknown'', ''Work-From-Home'']"


def _row(name: str, table: str, column: str, severity: str, expected: str, count: str, source: str, noun: str = "violations",
         actual: str | None = None) -> str:
    """One check as a SELECT: it passes when ``count`` over ``source`` is 0."""
    actual = actual or f"CAST(n AS BIGINT) || ' {noun}'"
    return f"""SELECT '{name}' AS check_name, '{table}' AS "table", '{column}' AS "column", n = 0 AS passed,
        '{severity}' AS severity, '{expected}' AS expected, {actual} AS actual, CAST(n AS BIGINT) AS row_count
        FROM (SELECT {count} AS n, count(*) AS total FROM {source})"""


def _nulls(column: str, table: str, source: str) -> str:
    return _row(f"no_nulls:{column}", table, column, "critical", "0%", f"count(*) FILTER ({column} IS NULL)", source,
                actual="CAST(round(coalesce(100.0 * n / total, 0.0), 2)::DOUBLE AS VARCHAR) || '%'")


def _duplicates(keys: str, table: str, source: str) -> str:
    columns = keys.replace("+", ", ")
    return _row(
        f"unique_pk:{keys}", table, keys, "critical", "0 duplicates",
        "coalesce(sum(c - 1), 0)", f"(SELECT count(*) AS c FROM {source} GROUP BY {columns})", "duplicates",
    )


_ATT_SCAN = [
    _nulls("employee_id", "attendance", "att_raw"),
    _nulls("date", "attendance", "att_raw"),
    _nulls("status", "attendance", "att_raw"),
    _row("valid_status", "attendance", "status", "critical", _SORTED,
         f"count(*) FILTER (NOT coalesce(status IN ({_STATUSES}), false))", "att_raw", "invalid"),
    _row("hours_range", "attendance", "hours_worked", "warning", "[0, 14]",
         "count(*) FILTER (hours_worked < 0 OR hours_worked > 14)", "att_raw"),
    _row("no_future_dates", "attendance", "date", "warning", "≤ today",
         "count(*) FILTER (TRY_CAST(date AS DATE) > DATE '2001-07-31')", "att_raw", "future dates"),
]
_EMP_SCAN = [
    _nulls("employee_id", "employees", "emp"),
    _nulls("name", "employees", "emp"),
    _nulls("department", "employees", "emp"),
    _row("positive_salary", "employees", "salary", "critical", ">= 0", "count(*) FILTER (salary < 0)", "emp", "negative salaries"),
    _row("valid_email", "employees", "email", "warning", "contains @",
         "count(*) FILTER (NOT coalesce(contains(email, '@'), false))", "emp", "invalid emails"),
]
_ORPHANS = _row(
    "fk_attendance→employees", "attendance", "employee_id", "critical", "all valid",
    "count(*) FILTER (employee_id IS NULL OR employee_id NOT IN (SELECT employee_id FROM emp))", "att_raw", "orphan records",
)
_SPIKES = _row(
    "daily_count_spikes", "attendance", "date", "info", "< mean+3σ",
    "count(*) FILTER (c > (SELECT avg(c) + 3 * stddev_samp(c) FROM (SELECT count(employee_id) AS c FROM att_raw GROUP BY date)))",
    "(SELECT count(employee_id) AS c FROM att_raw GROUP BY date)", "spike days",
)
_RATES = """(SELECT rate - lag(rate) OVER (ORDER BY month) AS change FROM
             (SELECT strftime(TRY_CAST(date AS DATE), '%Y-%m') AS month,
                     avg(CASE WHEN status = 'Present' THEN 1 ELSE 0 END) AS rate
              FROM {source} WHERE TRY_CAST(date AS DATE) IS NOT NULL GROUP BY month))"""


def _drops(source: str) -> str:
    return _row("attendance_rate_drop", "attendance", "status", "warning", "MoM drop < 15%",
                "count(*) FILTER (change < -0.15)", _RATES.format(source=source), "months with >15% drop")


def _outliers(source: str, factor: str = "3") -> str:
    return f"""SELECT 'hours_outliers' AS check_name, 'attendance' AS "table", 'hours_worked' AS "column",
        n < 0.01 * total AS passed, 'warning' AS severity, '<1% outliers' AS expected,
        printf('%d outliers (%.2f%%)', n, 100.0 * n / total) AS actual, n AS row_count
        FROM (SELECT count(*) FILTER (hours_worked < q1 - {factor} * (q3 - q1) OR hours_worked > q3 + {factor} * (q3 - q1)) AS n,
                     count(*) AS total
              FROM {source}, (SELECT quantile_cont(hours_worked, 0.25) AS q1, quantile_cont(hours_worked, 0.75) AS q3
                              FROM {source}) q)"""


def _all(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


@query("d02_column_exists", """SELECT 'column_exists:badge' AS check_name, 'attendance' AS "table", 'badge' AS "column",
       false AS passed, 'critical' AS severity, 'exists' AS expected, 'missing' AS actual, 0 AS row_count
       UNION ALL """ + _nulls("status", "attendance", "att_raw"))
def d02(spark: SparkSession, d: str) -> DataFrame:
    return Q.ScanChecks(V.att_raw(spark, d), "attendance").complete(["badge", "status"]).results().select(*KEPT)


@query("d03_completeness", _all(_ATT_SCAN[:3]))
def d03(spark: SparkSession, d: str) -> DataFrame:
    return Q.check_completeness(V.att_raw(spark, d), "attendance").select(*KEPT)


@query(
    "d04_null_counts",
    """SELECT 'null_check:status' AS "check", n = 0 AS passed, CASE WHEN n = 0 THEN '✓' ELSE n || ' nulls found' END AS detail
       FROM (SELECT count(*) FILTER (status IS NULL) AS n FROM att)
       UNION ALL SELECT 'null_check:employee_id', n = 0, CASE WHEN n = 0 THEN '✓' ELSE n || ' nulls found' END
       FROM (SELECT count(*) FILTER (employee_id IS NULL) AS n FROM att)""",
)
def d04(spark: SparkSession, d: str) -> DataFrame:
    return Q.Validator().check_nulls(V.att(spark, d), ["status", "employee_id"]).report()


@query(
    "d05_allowed_values",
    """WITH bad AS (SELECT shift, count(*) AS n, min(attendance_id) AS first FROM att
                    WHERE NOT coalesce(shift IN ('Morning', 'Night'), false) GROUP BY shift)
       SELECT 'category_check:shift' AS "check", sum(n) = 0 AS passed,
              CAST(sum(n) AS BIGINT) || ' invalid values: [' || (SELECT string_agg(shift, ', ' ORDER BY first) FROM
                  (SELECT shift, first FROM bad ORDER BY first LIMIT 5)) || ']' AS detail FROM bad""",
)
def d05(spark: SparkSession, d: str) -> DataFrame:
    v = Q.Validator().check_allowed_values(V.att(spark, d), "shift", ["Morning", "Night"], order="attendance_id")
    return v.report()


@query(
    "d06_range",
    """SELECT 'range_check:hours_worked[0,14]' AS "check", n = 0 AS passed,
              CASE WHEN n = 0 THEN '✓' ELSE n || ' violations' END AS detail
       FROM (SELECT count(*) FILTER (hours_worked < 0 OR hours_worked > 14) AS n FROM att)""",
)
def d06(spark: SparkSession, d: str) -> DataFrame:
    return Q.Validator().check_range(V.att(spark, d), "hours_worked", 0, 14).report()


@query("d07_no_future_dates", _ATT_SCAN[5])
def d07(spark: SparkSession, d: str) -> DataFrame:
    return Q.ScanChecks(V.att_raw(spark, d), "attendance").no_future("date", AS_OF).results().select(*KEPT)


@query("d08_positive_salary", _EMP_SCAN[3])
def d08(spark: SparkSession, d: str) -> DataFrame:
    checks = Q.ScanChecks(V.emp(spark, d), "employees")
    return checks.within("positive_salary", "salary", 0, None, "critical", ">= 0", "negative salaries").results().select(*KEPT)


@query("d09_valid_email", _EMP_SCAN[4])
def d09(spark: SparkSession, d: str) -> DataFrame:
    return Q.ScanChecks(V.emp(spark, d), "employees").email().results().select(*KEPT)


@query("d10_uniqueness", _all([_duplicates("employee_id+date", "attendance", "att"),
                               _duplicates("employee_id", "employees", "emp")]))
def d10(spark: SparkSession, d: str) -> DataFrame:
    audit = Q.TableAudit(attendance=V.att(spark, d), employees=V.emp(spark, d))
    return audit.unique("attendance").unique("employees").results().select(*KEPT)


@query("d11_referential_integrity", _ORPHANS)
def d11(spark: SparkSession, d: str) -> DataFrame:
    return Q.check_reference(
        V.att_raw(spark, d), "attendance", "employee_id", V.emp(spark, d), "employees", "employee_id"
    ).select(*KEPT)


@query("d12_outliers", _all([_outliers("att"), _outliers("att_ev", "0.5")]))
def d12(spark: SparkSession, d: str) -> DataFrame:
    return Q.check_outliers(V.att(spark, d)).unionByName(Q.check_outliers(V.att_ev(spark, d), 0.5)).select(*KEPT)


@query("d13_spikes", _SPIKES)
def d13(spark: SparkSession, d: str) -> DataFrame:
    return Q.check_spikes(Q.daily_counts(V.att_raw(spark, d))).select(*KEPT)


@query("d14_rate_drop", _drops("att_raw"))
def d14(spark: SparkSession, d: str) -> DataFrame:
    return Q.check_rate_drop(Q.daily_counts(V.att_raw(spark, d))).select(*KEPT)


@query(
    "d15_null_rate_gate",
    """WITH c AS (SELECT count(*) AS row_count, count(*) FILTER (employee_id IS NULL) + count(*) FILTER (status IS NULL)
                         + count(*) FILTER (hours_worked IS NULL) + count(*) FILTER (notes IS NULL) AS null_cells FROM att_raw)
       SELECT row_count, null_cells, CAST(null_cells AS DOUBLE) / (row_count * 4) AS null_rate,
              CASE WHEN CAST(null_cells AS DOUBLE) / (row_count * 4) > 0.3 THEN 'fail'
                   WHEN CAST(null_cells AS DOUBLE) / (row_count * 4) < 0.1 THEN 'proceed' ELSE 'alert' END AS decision
       FROM c""",
)
def d15(spark: SparkSession, d: str) -> DataFrame:
    return Q.null_rate_gate(V.att_raw(spark, d), ["employee_id", "status", "hours_worked", "notes"])


@query(
    "d16_domain_checks",
    _all([
        _row("status_domain", "attendance", "status", "critical", _SORTED,
             f"count(*) FILTER (status IS NOT NULL AND status NOT IN ({_STATUSES}))", "att", "invalid"),
        _row("shift_domain", "attendance", "shift", "critical", "in [''Afternoon'', ''Morning'', ''Night'']",
             "count(*) FILTER (shift NOT IN ('Morning', 'Afternoon', 'Night'))", "att", "invalid"),
        _row("hours_not_negative", "attendance", "hours_worked", "critical", ">= 0",
             "count(*) FILTER (hours_worked < 0)", "att"),
        _row("overtime_not_negative", "attendance", "overtime_hours", "critical", ">= 0",
             "count(*) FILTER (overtime_hours < 0)", "att"),
    ]),
)
def d16(spark: SparkSession, d: str) -> DataFrame:
    return Q.domain_checks(V.att(spark, d)).select(*KEPT)


def _reference(table: str, column: str, source: str, to: str, ref: str, key: str) -> str:
    return _row(
        f"fk_{table}→{to}:{column}", table, column, "critical", "all valid",
        f"count(*) FILTER ({column} IS NOT NULL AND {column} NOT IN (SELECT {key} FROM {ref}))", source, "orphan records",
    )


def _unique(column: str, table: str, source: str) -> str:
    return _duplicates(column, table, f"(SELECT * FROM {source} WHERE {column} IS NOT NULL)")


@query(
    "d17_declared_constraints",
    _all([
        _nulls("department_name", "departments", "dept"),
        _nulls("name", "employees", "emp"),
        _nulls("employee_id", "attendance", "att"),
        _nulls("date", "attendance", "att"),
        _nulls("employee_id", "leaves", "leaves"),
        _unique("department_name", "departments", "dept"),
        _unique("employee_id", "employees", "emp"),
        _unique("email", "employees", "emp"),
        _unique("attendance_id", "attendance", "att"),
        _duplicates("employee_id+date", "attendance", "att"),
        _unique("leave_id", "leaves", "leaves"),
        _reference("employees", "department", "emp", "departments", "dept", "department_name"),
        _reference("employees", "manager_id", "emp", "employees", "emp", "employee_id"),
        _reference("attendance", "employee_id", "att", "employees", "emp", "employee_id"),
        _reference("leaves", "employee_id", "leaves", "employees", "emp", "employee_id"),
    ]),
)
def d17(spark: SparkSession, d: str) -> DataFrame:
    return Q.declared_constraints(
        V.dept(spark, d), V.emp(spark, d), V.att(spark, d), V.leaves(spark, d)
    ).select(*KEPT)


_TYPES = {"employee_id": "bigint", "name": "string", "email": "string", "salary": "double", "is_active": "boolean"}


@query(
    "d18_profile",
    _all([
        f"""SELECT '{c}' AS "column", count(*) FILTER ({c} IS NULL) AS nulls, count(*) AS row_count, '{t}' AS type FROM emp"""
        for c, t in _TYPES.items()
    ]),
)
def d18(spark: SparkSession, d: str) -> DataFrame:
    return Q.profile(V.emp(spark, d).select(*_TYPES))


def _outcomes(checks: list[tuple[str, str, str]]) -> str:
    """(check, violated condition, noun) of attendance rows as the rows of a validator's report."""
    return _all([
        f"""SELECT '{name}' AS "check", n = 0 AS passed, CASE WHEN n = 0 THEN '✓' ELSE n || ' {noun}' END AS detail
            FROM (SELECT count(*) FILTER ({condition}) AS n FROM att)""" for name, condition, noun in checks])


_REPORT = _outcomes([
    ("null_check:status", "status IS NULL", "nulls found"),
    ("null_check:employee_id", "employee_id IS NULL", "nulls found"),
    ("range_check:hours_worked[0,14]", "hours_worked < 0 OR hours_worked > 14", "violations"),
    ("fk_check:employee_id→employee_id", "employee_id NOT IN (SELECT employee_id FROM emp)", "orphan records"),
])


def _validator(spark: SparkSession, d: str) -> Q.Validator:
    att = V.att(spark, d)
    return (
        Q.Validator()
        .check_nulls(att, ["status", "employee_id"])
        .check_range(att, "hours_worked", 0, 14)
        .check_reference(att, "employee_id", V.emp(spark, d), "employee_id")
    )


@query("d19_validator_report", _REPORT)
def d19(spark: SparkSession, d: str) -> DataFrame:
    return _validator(spark, d).report()


@query(
    "d20_validator_summary",
    f"""SELECT count(*) AS total_checks, count(*) FILTER (passed) AS passed, count(*) FILTER (NOT passed) AS failed,
               printf('%.1f%%', 100.0 * count(*) FILTER (passed) / count(*)) AS pass_rate FROM ({_REPORT})""",
)
def d20(spark: SparkSession, d: str) -> DataFrame:
    return _validator(spark, d).summary()


_RUN_ALL = _all([
    *_ATT_SCAN, _duplicates("employee_id+date", "attendance", "att_raw"), _outliers("att_raw"), _SPIKES,
    _drops("att_raw"), *_EMP_SCAN, _duplicates("employee_id", "employees", "emp"), _ORPHANS,
])


def _run_all(spark: SparkSession, d: str) -> DataFrame:
    return Q.run_all(V.att_raw(spark, d), V.emp(spark, d), AS_OF)


@query("d21_run_all", _RUN_ALL)
def d21(spark: SparkSession, d: str) -> DataFrame:
    return _run_all(spark, d).select(*KEPT)


@query(
    "d22_report",
    f"""SELECT '2001-07-31T00:00:00' AS generated_at, count(*) AS total, count(*) FILTER (passed) AS passed,
               count(*) FILTER (NOT passed) AS failed, count(*) AS n_results FROM ({_RUN_ALL})""",
)
def d22(spark: SparkSession, d: str) -> DataFrame:
    document = Q.report_document(_run_all(spark, d), datetime(2001, 7, 31))
    return document.select("generated_at", "summary.*", F.size("results").cast("bigint").alias("n_results"))


@query("d22_report_entries", f"SELECT *, '2001-07-31T00:00:00' AS timestamp FROM ({_RUN_ALL})")
def d22c(spark: SparkSession, d: str) -> DataFrame:
    return Q.report_document(_run_all(spark, d), datetime(2001, 7, 31)).select(F.inline("results"))


@query(
    "d22_failure_split",
    f"""SELECT count(*) AS total, count(*) FILTER (passed) AS passed,
               count(*) FILTER (NOT passed AND severity = 'critical') AS critical_failures,
               count(*) FILTER (NOT passed AND severity = 'warning') AS warnings,
               CAST(floor(100.0 * count(*) FILTER (passed) / count(*)) AS BIGINT) AS passed_pct FROM ({_RUN_ALL})""",
)
def d22b(spark: SparkSession, d: str) -> DataFrame:
    return Q.split_failures(_run_all(spark, d))


@query(
    "s01_directory_report",
    """SELECT 'emp' AS "table", count(*) AS "rows", 10 AS "columns",
              count(*) FILTER (email IS NULL) + count(*) FILTER (manager_id IS NULL) AS missing FROM emp
       UNION ALL SELECT 'dept', count(*), 4, 0 FROM dept""",
)
def s01(spark: SparkSession, d: str) -> DataFrame:
    from rollcall.sources.readers import directory_report

    return directory_report({"emp": V.emp(spark, d), "dept": V.dept(spark, d)})
