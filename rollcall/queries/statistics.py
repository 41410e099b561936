"""Queries for statistics and normalisation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollcall.operators import statistics as N
from rollcall.queries import views as V
from rollcall.queries.common import six_digit_columns
from rollcall.queries.registry import query


def _d6(expr: str) -> str:
    return f"CAST(CAST({expr} AS DECIMAL(18, 6)) AS DOUBLE)"


def _hours(spark: SparkSession, d: str) -> DataFrame:
    return V.att(spark, d).select("attendance_id", "hours_worked", "overtime_hours")


@query(
    "n01_min_max",
    f"""SELECT attendance_id, {_d6("(hours_worked - lo) / (hi - lo)")} AS hours_worked_norm FROM att,
               (SELECT min(hours_worked) AS lo, max(hours_worked) AS hi FROM att) s""",
)
def n01(spark: SparkSession, d: str) -> DataFrame:
    scaled = N.normalize_columns(_hours(spark, d), ["hours_worked"], "min_max")
    return six_digit_columns(scaled.select("attendance_id", "hours_worked_norm"), "hours_worked_norm")


@query(
    "n02_z_score",
    f"""SELECT attendance_id, {_d6("(hours_worked - m) / s")} AS hours_worked_norm FROM att,
               (SELECT avg(hours_worked) AS m, stddev_samp(hours_worked) AS s FROM att) q""",
)
def n02(spark: SparkSession, d: str) -> DataFrame:
    scaled = N.normalize_columns(_hours(spark, d), ["hours_worked"], "z_score")
    return six_digit_columns(scaled.select("attendance_id", "hours_worked_norm"), "hours_worked_norm")


@query(
    "n03_robust_scale",
    f"""SELECT attendance_id, {_d6("(hours_worked - q[2]) / (q[3] - q[1])")} AS hours_worked_norm FROM att,
               (SELECT quantile_cont(hours_worked, [0.25, 0.5, 0.75]) AS q FROM att) s""",
)
def n03(spark: SparkSession, d: str) -> DataFrame:
    scaled = N.normalize_columns(_hours(spark, d), ["hours_worked"], "robust_scale")
    return six_digit_columns(scaled.select("attendance_id", "hours_worked_norm"), "hours_worked_norm")


@query(
    "n04_log_transform",
    f"""SELECT attendance_id, {_d6("ln(1 + CASE WHEN hours_worked < 0 THEN 0 ELSE hours_worked END)")} AS hours_worked_norm
        FROM att""",
)
def n04(spark: SparkSession, d: str) -> DataFrame:
    scaled = N.normalize_columns(_hours(spark, d), ["hours_worked"], "log_transform")
    return six_digit_columns(scaled.select("attendance_id", "hours_worked_norm"), "hours_worked_norm")


@query(
    "n05_normalize_columns",
    f"""SELECT attendance_id, {_d6("(hours_worked - lo1) / (hi1 - lo1)")} AS hours_worked_norm,
               {_d6("(overtime_hours - lo2) / (hi2 - lo2)")} AS overtime_hours_norm FROM att,
               (SELECT min(hours_worked) AS lo1, max(hours_worked) AS hi1, min(overtime_hours) AS lo2,
                       max(overtime_hours) AS hi2 FROM att) s""",
)
def n05(spark: SparkSession, d: str) -> DataFrame:
    scaled = N.normalize_columns(_hours(spark, d), ["hours_worked", "overtime_hours", "not_there"])
    kept = scaled.select("attendance_id", "hours_worked_norm", "overtime_hours_norm")
    return six_digit_columns(kept, "hours_worked_norm", "overtime_hours_norm")


@query(
    "n06_column_statistics",
    f"""SELECT count(hours_worked) AS n, avg(hours_worked) AS mean, {_d6("stddev_pop(hours_worked)")} AS std,
               {_d6("var_pop(hours_worked)")} AS variance, min(hours_worked) AS min, max(hours_worked) AS max,
               {_d6("quantile_cont(hours_worked, 0.5)")} AS median, {_d6("quantile_cont(hours_worked, 0.25)")} AS p25,
               {_d6("quantile_cont(hours_worked, 0.5)")} AS p50, {_d6("quantile_cont(hours_worked, 0.75)")} AS p75,
               {_d6("quantile_cont(hours_worked, 0.9)")} AS p90, {_d6("quantile_cont(hours_worked, 0.99)")} AS p99
        FROM att""",
)
def n06(spark: SparkSession, d: str) -> DataFrame:
    stats = N.column_statistics(V.att(spark, d), "hours_worked")
    return six_digit_columns(stats, "std", "variance", "median", "p25", "p50", "p75", "p90", "p99")


@query(
    "n06_price_quantiles",
    f"""SELECT {", ".join(f"{_d6(f'quantile_cont(l_extendedprice, {p})')} AS p{n}"
                          for p, n in ((0.25, 25), (0.5, 50), (0.75, 75), (0.9, 90), (0.99, 99)))} FROM lineitem""",
)
def n06b(spark: SparkSession, d: str) -> DataFrame:
    prices = V.table(spark, d, "lineitem").select("l_extendedprice")
    q = N.exact_quantiles(prices, "l_extendedprice", [0.25, 0.5, 0.75, 0.9, 0.99])
    return six_digit_columns(q, *q.columns)


@query(
    "n07_iqr_outliers",
    """WITH q AS (SELECT quantile_cont(salary, 0.25) AS q1, quantile_cont(salary, 0.75) AS q3 FROM emp),
            b AS (SELECT q1 - 0.25 * (q3 - q1) AS lower, q3 + 0.25 * (q3 - q1) AS upper FROM q)
       SELECT count(*) FILTER (salary < lower OR salary > upper) AS outliers, count(*) AS "rows",
              CAST(CAST(lower AS DECIMAL(18, 6)) AS DOUBLE) AS lower, CAST(CAST(upper AS DECIMAL(18, 6)) AS DOUBLE) AS upper
       FROM emp, b GROUP BY lower, upper""",
)
def n07(spark: SparkSession, d: str) -> DataFrame:
    return six_digit_columns(N.iqr_outliers(V.emp(spark, d), "salary", 0.25), "lower", "upper")


@query(
    "n07_hours_outliers",
    """WITH q AS (SELECT quantile_cont(hours_worked, 0.25) AS q1, quantile_cont(hours_worked, 0.75) AS q3 FROM att_ev),
            b AS (SELECT q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM q)
       SELECT count(*) FILTER (hours_worked < lower OR hours_worked > upper) AS outliers, count(*) AS "rows",
              CAST(CAST(lower AS DECIMAL(18, 6)) AS DOUBLE) AS lower, CAST(CAST(upper AS DECIMAL(18, 6)) AS DOUBLE) AS upper
       FROM att_ev, b GROUP BY lower, upper""",
)
def n07b(spark: SparkSession, d: str) -> DataFrame:
    return six_digit_columns(N.iqr_outliers(V.att_ev(spark, d), "hours_worked"), "lower", "upper")


_PAIRS = [("attendance_id", "hours_worked"), ("attendance_id", "overtime_hours"), ("hours_worked", "overtime_hours")]


@query(
    "n08_correlations",
    " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, {_d6(f'corr({a}, {b})')} AS correlation FROM att"
        for a, b in _PAIRS
    ),
)
def n08(spark: SparkSession, d: str) -> DataFrame:
    return six_digit_columns(N.correlations(_hours(spark, d), digits=None), "correlation")


@query(
    "n09_type_advice",
    """WITH i AS (SELECT 'attendance_id' AS "column", min(attendance_id) AS lo, max(attendance_id) AS hi FROM att
                  UNION ALL SELECT 'employee_id', min(employee_id), max(employee_id) FROM att)
       SELECT "column", 'bigint' AS "current", CASE WHEN lo >= -128 AND hi <= 127 THEN 'tinyint'
              WHEN lo >= -32768 AND hi <= 32767 THEN 'smallint'
              WHEN lo >= -2147483648 AND hi <= 2147483647 THEN 'int' ELSE 'bigint' END AS advice,
              CAST(NULL AS BOOLEAN) AS low_cardinality FROM i
       UNION ALL SELECT 'hours_worked', 'double', 'float', NULL
       UNION ALL SELECT 'status', 'string', 'string', CAST(count(DISTINCT status) AS DOUBLE) / count(*) < 0.1 FROM att
       UNION ALL SELECT 'department', 'string', 'string', CAST(count(DISTINCT department) AS DOUBLE) / count(*) < 0.1 FROM att""",
)
def n09(spark: SparkSession, d: str) -> DataFrame:
    att = V.att(spark, d).select("attendance_id", "employee_id", "hours_worked", "status", "department")
    return N.type_advice(att)


@query(
    "n09_narrow_integers",
    "SELECT attendance_id, employee_id FROM att",
)
def n09b(spark: SparkSession, d: str) -> DataFrame:
    return N.narrow_integers(V.att(spark, d).select("attendance_id", "employee_id"))


@query(
    "a22_productivity_description",
    f"""WITH p AS (SELECT CASE WHEN coalesce(hours_worked, 0) > 12 THEN 1.5 ELSE coalesce(hours_worked, 0) / 8 END AS v FROM att)
        SELECT count(v) AS count, avg(v) AS mean, {_d6("stddev_samp(v)")} AS std, min(v) AS min, max(v) AS max,
               {_d6("quantile_cont(v, 0.25)")} AS p25, {_d6("quantile_cont(v, 0.5)")} AS p50,
               {_d6("quantile_cont(v, 0.75)")} AS p75 FROM p""",
)
def a22(spark: SparkSession, d: str) -> DataFrame:
    from rollcall.operators.cleaning import feature_columns

    features = feature_columns(V.att(spark, d), digits=None)
    return six_digit_columns(N.describe_numeric(features, "productivity_score"), "std", "p25", "p50", "p75")


def _text_description(column: str) -> str:
    return f"""SELECT '{column}' AS "column", count({column}) AS count, count(DISTINCT {column}) AS "distinct",
        (SELECT {column} FROM att WHERE {column} IS NOT NULL GROUP BY {column} ORDER BY count(*) DESC, {column} LIMIT 1) AS top,
        (SELECT count(*) FROM att WHERE {column} IS NOT NULL GROUP BY {column} ORDER BY count(*) DESC LIMIT 1) AS freq,
        NULL AS mean, NULL AS std, NULL AS min, NULL AS p25, NULL AS p50, NULL AS p75, NULL AS max FROM att"""


@query(
    "a23_describe_all",
    f"""SELECT 'hours_worked' AS "column", count(hours_worked) AS count, CAST(NULL AS BIGINT) AS "distinct",
               CAST(NULL AS VARCHAR) AS top, CAST(NULL AS BIGINT) AS freq, avg(hours_worked) AS mean,
               {_d6("stddev_samp(hours_worked)")} AS std, min(hours_worked) AS min,
               {_d6("quantile_cont(hours_worked, 0.25)")} AS p25, {_d6("quantile_cont(hours_worked, 0.5)")} AS p50,
               {_d6("quantile_cont(hours_worked, 0.75)")} AS p75, max(hours_worked) AS max FROM att
        UNION ALL {_text_description("status")} UNION ALL {_text_description("department")}""",
)
def a23(spark: SparkSession, d: str) -> DataFrame:
    described = N.describe_all(V.att(spark, d), ["hours_worked", "status", "department"])
    return six_digit_columns(described, "std", "p25", "p50", "p75")
