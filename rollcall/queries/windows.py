"""Queries for window operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollcall.operators import windows as W
from rollcall.operators.aggregates import rows
from rollcall.queries import views as V
from rollcall.queries.registry import query
from rollcall.streaming.events import partition_offsets

_WORKED = "status IN ('Present', 'Late', 'Work-From-Home')"


@query(
    "w01_running_hours",
    f"""SELECT attendance_id, employee_id, CAST(date AS VARCHAR) AS date, hours_worked,
               sum(hours_worked) OVER so_far AS cumulative_hours
        FROM att WHERE {_WORKED}
        WINDOW so_far AS (PARTITION BY employee_id ORDER BY date, attendance_id ROWS UNBOUNDED PRECEDING)""",
)
def w01(spark: SparkSession, d: str) -> DataFrame:
    return W.running_hours(V.att(spark, d))


@query(
    "w02_weekly_average",
    f"""SELECT attendance_id, employee_id, CAST(date AS VARCHAR) AS date, hours_worked,
               avg(hours_worked) OVER last_seven AS rolling_7day_avg
        FROM att WHERE {_WORKED}
        WINDOW last_seven AS (PARTITION BY employee_id ORDER BY date, attendance_id ROWS 6 PRECEDING)""",
)
def w02(spark: SparkSession, d: str) -> DataFrame:
    return W.weekly_average_hours(V.att(spark, d))


_PRESENT_DAYS = """
    WITH n AS (SELECT employee_id, count(*) AS days FROM att WHERE status = 'Present' GROUP BY employee_id),
         p AS (SELECT employee_id, name, department, coalesce(days, 0) AS present_days
               FROM emp LEFT JOIN n USING (employee_id))"""


@query(
    "w03_rank_in_department",
    _PRESENT_DAYS + " SELECT *, rank() OVER (PARTITION BY department ORDER BY present_days DESC) AS dept_rank FROM p",
)
def w03(spark: SparkSession, d: str) -> DataFrame:
    return W.rank_in_department(V.emp(spark, d), V.att(spark, d))


@query(
    "w04_performance_quartile",
    _PRESENT_DAYS
    + " SELECT *, ntile(4) OVER (ORDER BY present_days DESC, employee_id) AS performance_quartile FROM p",
)
def w04(spark: SparkSession, d: str) -> DataFrame:
    return W.performance_quartile(V.emp(spark, d), V.att(spark, d))


@query(
    "w05_month_over_month",
    """SELECT employee_id, ym, present_days, lag(present_days) OVER months AS prev_month,
              coalesce(present_days - lag(present_days) OVER months, 0) AS mom_change
       FROM (SELECT employee_id, strftime(date, '%Y-%m') AS ym, count(*) FILTER (status = 'Present') AS present_days
             FROM att GROUP BY ALL)
       WINDOW months AS (PARTITION BY employee_id ORDER BY ym)""",
)
def w05(spark: SparkSession, d: str) -> DataFrame:
    return W.month_over_month(V.att(spark, d))


@query(
    "w06_share_of_total",
    """SELECT shift, count(*) AS records,
              CAST(100 AS DOUBLE) * count(*) / CAST(sum(count(*)) OVER () AS BIGINT) AS share
       FROM att GROUP BY shift""",
)
def w06(spark: SparkSession, d: str) -> DataFrame:
    counts = V.att(spark, d).groupBy("shift").agg(rows().alias("records"))
    return W.share_of_total(counts, "records", "share")


@query(
    "w07_top_rows_by_hours",
    """SELECT department, rn, attendance_id, employee_id, hours_worked FROM (
           SELECT *, row_number() OVER (PARTITION BY department
                     ORDER BY hours_worked DESC NULLS LAST, attendance_id) AS rn
           FROM att WHERE department IS NOT NULL) WHERE rn <= 3""",
)
def w07(spark: SparkSession, d: str) -> DataFrame:
    return W.top_rows_by_hours(V.att(spark, d))


@query(
    "w08_rolling_mean",
    """SELECT attendance_id, CAST(date AS VARCHAR) AS date, hours_worked,
              avg(hours_worked) OVER (ORDER BY date NULLS LAST, attendance_id
                                      ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS hours_worked_rolling_7d
       FROM att""",
)
def w08(spark: SparkSession, d: str) -> DataFrame:
    return W.rolling_mean(V.att(spark, d).select("attendance_id", "date", "hours_worked"), "hours_worked")


@query(
    "w08_rolling_mean_by_department",
    """SELECT attendance_id, department, CAST(date AS VARCHAR) AS date, hours_worked,
              avg(hours_worked) OVER (PARTITION BY department ORDER BY date, attendance_id
                                      ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS hours_worked_rolling_7d
       FROM att""",
)
def w08b(spark: SparkSession, d: str) -> DataFrame:
    att = V.att(spark, d).select("attendance_id", "department", "date", "hours_worked")
    return W.rolling_mean(att, "hours_worked", partition_by=["department"])


@query(
    "w09_monthly_rate_change",
    """WITH m AS (SELECT strftime(date, '%Y-%m') AS month,
                         avg(CASE WHEN status = 'Present' THEN 1 ELSE 0 END) AS rate FROM att GROUP BY month)
       SELECT month, rate, rate - lag(rate) OVER (ORDER BY month) AS change FROM m""",
)
def w09(spark: SparkSession, d: str) -> DataFrame:
    return W.monthly_rate_change(V.att(spark, d))


@query(
    "w10_keep_first",
    """SELECT employee_id, CAST(date AS VARCHAR) AS date, min(attendance_id) AS attendance_id
       FROM att GROUP BY employee_id, date""",
)
def w10(spark: SparkSession, d: str) -> DataFrame:
    att = V.att(spark, d).select("employee_id", "date", "attendance_id")
    return W.keep_first(att, ["employee_id", "date"], [F.col("attendance_id")])


@query(
    "w11_partition_offsets",
    """SELECT event_id, employee_id, partition,
              row_number() OVER (PARTITION BY partition ORDER BY event_ts, event_id) - 1 AS "offset"
       FROM (SELECT *, CAST(('0x' || substr(md5(employee_id), 1, 8))::BIGINT % 3 AS INTEGER) AS partition FROM ev)""",
)
def w11(spark: SparkSession, d: str) -> DataFrame:
    events = V.ev(spark, d).select("event_id", "employee_id", "event_ts")
    return partition_offsets(events, 3).drop("event_ts")


@query(
    "w02_average_over_days",
    """WITH daily AS (SELECT employee_id, date, sum(hours_worked) AS s, count(hours_worked) AS n
                      FROM att_ev GROUP BY ALL)
       SELECT employee_id, CAST(date AS VARCHAR) AS date,
              sum(s) OVER w / sum(n) OVER w AS avg_7_days
       FROM daily WINDOW w AS (PARTITION BY employee_id ORDER BY date
                               RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)""",
)
def w02b(spark: SparkSession, d: str) -> DataFrame:
    return W.moving_average_days(V.att_ev(spark, d), "hours_worked", ["employee_id"], "date", "avg_7_days")
