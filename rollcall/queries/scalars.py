"""Queries for scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollcall.functions import scalar as S
from rollcall.functions.signing import sign_rows, verify_rows
from rollcall.operators.aggregates import rows
from rollcall.operators.quality import summarize, check_completeness
from rollcall.operators.tableops import random_score
from rollcall.queries import views as V
from rollcall.queries.common import AS_OF, six_digits, wall_time
from rollcall.queries.registry import query
from rollcall.schemas import DEFAULT_HOURS, EVENT


@query(
    "f01_parse_date",
    "SELECT attendance_id, CAST(TRY_CAST(date AS DATE) AS VARCHAR) AS date FROM att_raw",
)
def f01(spark: SparkSession, d: str) -> DataFrame:
    return V.att_raw(spark, d).select("attendance_id", S.parse_date("date").alias("date"))


@query("f02_parse_timestamp", "SELECT event_id, event_ts AS parsed FROM ev")
def f02(spark: SparkSession, d: str) -> DataFrame:
    return wall_time(V.ev(spark, d).select("event_id", S.parse_timestamp("timestamp").alias("parsed")), "parsed")


@query(
    "f03_parse_number",
    """SELECT attendance_id, coalesce(TRY_CAST(CASE WHEN attendance_id % 17 = 3 THEN 'n/a'
              ELSE CAST(hours_worked AS VARCHAR) END AS DOUBLE), 0) AS hours FROM att""",
)
def f03(spark: SparkSession, d: str) -> DataFrame:
    text = F.when(F.col("attendance_id") % 17 == 3, "n/a").otherwise(F.col("hours_worked").cast("string"))
    return V.att(spark, d).select("attendance_id", S.parse_number(text).alias("hours"))


@query("f04_year_month", "SELECT attendance_id, strftime(date, '%Y-%m') AS ym FROM att")
def f04(spark: SparkSession, d: str) -> DataFrame:
    return V.att(spark, d).select("attendance_id", S.year_month("date").alias("ym"))


@query(
    "f05_month_start",
    "SELECT attendance_id, CAST(CAST(date_trunc('month', date) AS DATE) AS VARCHAR) AS month FROM att",
)
def f05(spark: SparkSession, d: str) -> DataFrame:
    return V.att(spark, d).select("attendance_id", S.month_start("date").alias("month"))


@query(
    "f06_date_parts",
    "SELECT attendance_id, year(date) AS y, month(date) AS m, day(date) AS d, quarter(date) AS q FROM att",
)
def f06(spark: SparkSession, d: str) -> DataFrame:
    return V.att(spark, d).select(
        "attendance_id", F.year("date").alias("y"), F.month("date").alias("m"),
        F.dayofmonth("date").alias("d"), F.quarter("date").alias("q"),
    )


@query(
    "f07_weekday",
    "SELECT attendance_id, isodow(date) - 1 AS day_num, isodow(date) >= 6 AS is_weekend FROM att",
)
def f07(spark: SparkSession, d: str) -> DataFrame:
    return V.att(spark, d).select(
        "attendance_id", S.weekday_number("date").alias("day_num"), S.is_weekend("date").alias("is_weekend")
    )


@query("f08_iso_week", "SELECT attendance_id, week(date) AS week FROM att")
def f08(spark: SparkSession, d: str) -> DataFrame:
    return V.att(spark, d).select("attendance_id", S.iso_week("date").alias("week"))


@query(
    "f09_names",
    "SELECT attendance_id, dayname(date) AS day_name, monthname(date) AS month_name FROM att",
)
def f09(spark: SparkSession, d: str) -> DataFrame:
    return V.att(spark, d).select(
        "attendance_id", S.day_name("date").alias("day_name"), S.month_name("date").alias("month_name")
    )


@query("f10_date_key", "SELECT attendance_id, CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_key FROM att")
def f10(spark: SparkSession, d: str) -> DataFrame:
    return V.att(spark, d).select("attendance_id", S.date_key("date").alias("date_key"))


@query("f11_hour", "SELECT event_id, hour(event_ts) AS hour FROM ev")
def f11(spark: SparkSession, d: str) -> DataFrame:
    return V.ev(spark, d).select("event_id", F.hour("event_ts").alias("hour"))


@query(
    "f12_days_before",
    "SELECT attendance_id, DATE '2001-07-31' - date AS days_ago, date >= DATE '2001-07-31' - 30 AS recent FROM att",
)
def f12(spark: SparkSession, d: str) -> DataFrame:
    as_of = F.lit(AS_OF)
    return V.att(spark, d).select(
        "attendance_id", F.datediff(as_of, "date").alias("days_ago"),
        (F.col("date") >= F.date_sub(as_of, 30)).alias("recent"),
    )


@query("f13_add_days", "SELECT attendance_id, CAST(date + 365 AS VARCHAR) AS next_year FROM att")
def f13(spark: SparkSession, d: str) -> DataFrame:
    return V.att(spark, d).select("attendance_id", F.date_add("date", 365).alias("next_year"))


@query(
    "f14_window_number",
    "SELECT event_id, CAST(floor(epoch(event_ts) / 10) AS BIGINT) AS window_number FROM ev",
)
def f14(spark: SparkSession, d: str) -> DataFrame:
    return V.ev(spark, d).select("event_id", S.window_number("event_ts", 10).alias("window_number"))


@query(
    "f15_clip",
    """SELECT attendance_id,
              CASE WHEN hours_worked < 0 THEN 0 WHEN hours_worked > 14 THEN 14 ELSE hours_worked END AS both_sides,
              CASE WHEN hours_worked > 14 THEN 14 ELSE hours_worked END AS upper_only,
              CASE WHEN hours_worked < 0 THEN 0 ELSE hours_worked END AS lower_only
       FROM att""",
)
def f15(spark: SparkSession, d: str) -> DataFrame:
    return V.att(spark, d).select(
        "attendance_id", S.clip("hours_worked", 0, 14).alias("both_sides"),
        S.clip("hours_worked", high=14).alias("upper_only"), S.clip("hours_worked", low=0).alias("lower_only"),
    )


@query(
    "f16_clamp_filled",
    "SELECT attendance_id, least(greatest(coalesce(hours_worked, 0), 0), 14) AS hours FROM att",
)
def f16(spark: SparkSession, d: str) -> DataFrame:
    return V.att(spark, d).select("attendance_id", S.clamp_filled("hours_worked", 0.0, 14.0).alias("hours"))


@query(
    "f17_round",
    """SELECT attendance_id, CAST(round(CAST(hours_worked AS DECIMAL(10, 1)), 0) AS DOUBLE) AS away,
              round_even(hours_worked, 0) AS even FROM att""",
)
def f17(spark: SparkSession, d: str) -> DataFrame:
    hours = F.col("hours_worked")
    return V.att(spark, d).select(
        "attendance_id", S.round_to(hours, 0).cast("double").alias("away"),
        S.round_to(hours, 0, half_even=True).cast("double").alias("even"),
    )


@query(
    "f18_log1p",
    """SELECT attendance_id, CAST(CAST(ln(1 + CASE WHEN hours_worked < 0 THEN 0 ELSE hours_worked END)
              AS DECIMAL(18, 6)) AS DOUBLE) AS log_hours FROM att""",
)
def f18(spark: SparkSession, d: str) -> DataFrame:
    return V.att(spark, d).select("attendance_id", six_digits(S.log1p_nonneg("hours_worked")).alias("log_hours"))


@query(
    "f19_flags",
    """SELECT attendance_id, CASE WHEN status = 'Present' THEN 1 ELSE 0 END AS is_present,
              CASE WHEN status = 'Absent' THEN 1 ELSE 0 END AS is_absent,
              CASE WHEN status = 'Late' THEN 1 ELSE 0 END AS is_late,
              CASE WHEN status = 'Work-From-Home' THEN 1 ELSE 0 END AS is_wfh FROM att""",
)
def f19(spark: SparkSession, d: str) -> DataFrame:
    wanted = {"is_present": "Present", "is_absent": "Absent", "is_late": "Late", "is_wfh": "Work-From-Home"}
    return V.att(spark, d).select(
        "attendance_id", *[S.flag(S.status_is(v)).alias(n) for n, v in wanted.items()]
    )


@query(
    "f20_fill_constant",
    "SELECT attendance_id, coalesce(status, 'Unknown') AS status, coalesce(hours_worked, 0) AS hours_worked FROM att",
)
def f20(spark: SparkSession, d: str) -> DataFrame:
    att = V.att(spark, d).select("attendance_id", "status", "hours_worked")
    return att.fillna({"status": "Unknown", "hours_worked": 0.0})


@query(
    "f21_fill_by_status",
    """SELECT attendance_id, coalesce(hours_worked, CASE status WHEN 'Present' THEN 8 WHEN 'Late' THEN 7
              WHEN 'Half-Day' THEN 4 WHEN 'Work-From-Home' THEN 8 WHEN 'Absent' THEN 0
              WHEN 'On-Leave' THEN 0 WHEN 'Unknown' THEN 0 END) AS hours FROM att""",
)
def f21(spark: SparkSession, d: str) -> DataFrame:
    filled = F.coalesce("hours_worked", S.lookup("status", DEFAULT_HOURS))
    return V.att(spark, d).select("attendance_id", filled.alias("hours"))


@query(
    "f22_productivity",
    """SELECT attendance_id, CASE WHEN hours_worked < 0 THEN 0 WHEN hours_worked > 12 THEN 1.5 ELSE hours_worked / 8 END AS floored,
              CASE WHEN hours_worked > 12 THEN 1.5 ELSE hours_worked / 8 END AS unfloored FROM att""",
)
def f22(spark: SparkSession, d: str) -> DataFrame:
    return V.att(spark, d).select(
        "attendance_id", S.productivity("hours_worked", digits=None).alias("floored"),
        S.productivity("hours_worked", floor=None, digits=None).alias("unfloored"),
    )


@query("f23_lower_trim", "SELECT employee_id, trim(lower(email)) AS email FROM emp")
def f23(spark: SparkSession, d: str) -> DataFrame:
    return V.emp(spark, d).select("employee_id", S.clean_text("email").alias("email"))


@query("f24_contains", "SELECT employee_id, coalesce(contains(email, '@'), false) AS has_at FROM emp")
def f24(spark: SparkSession, d: str) -> DataFrame:
    return V.emp(spark, d).select("employee_id", S.is_true(F.col("email").contains("@")).alias("has_at"))


@query(
    "f25_bins",
    """SELECT employee_id, CASE WHEN salary <= 0 THEN NULL WHEN salary <= 40000 THEN 'Junior'
              WHEN salary <= 80000 THEN 'Mid' WHEN salary <= 150000 THEN 'Senior' ELSE 'Executive' END AS band
       FROM emp""",
)
def f25(spark: SparkSession, d: str) -> DataFrame:
    return V.emp(spark, d).select("employee_id", S.salary_band().alias("band"))


@query(
    "f26_overtime",
    """SELECT attendance_id, CASE WHEN hours_worked > 8 THEN hours_worked - 8 WHEN hours_worked <= 8 THEN 0 END AS overtime
       FROM att""",
)
def f26(spark: SparkSession, d: str) -> DataFrame:
    return V.att(spark, d).select("attendance_id", S.overtime("hours_worked").alias("overtime"))


@query(
    "f27_parse_json",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM ev",
)
def f27(spark: SparkSession, d: str) -> DataFrame:
    parsed = F.from_json("props", "k bigint")
    return V.ev(spark, d).select("event_id", parsed.alias("data")).select("event_id", "data.*")


@query(
    "f28_row_json",
    """SELECT event_id, '{"event_id":"' || event_id || '","employee_id":"' || employee_id || '","event_type":"'
              || event_type || '"}' AS payload FROM ev""",
)
def f28(spark: SparkSession, d: str) -> DataFrame:
    events = V.ev(spark, d)
    return events.select("event_id", S.row_json(events, ["event_id", "employee_id", "event_type"]).alias("payload"))


_KEY = "signing-key"
_PADDED = _KEY.encode().ljust(64, b"\0")
_INNER = bytes(b ^ 0x36 for b in _PADDED).hex()
_OUTER = bytes(b ^ 0x5C for b in _PADDED).hex()


@query(
    "f29_signature",
    f"""WITH p AS (SELECT event_id, '{{"event_id":"' || event_id || '","event_type":"' || event_type || '"}}' AS payload FROM ev)
        SELECT event_id, payload, true AS signature_ok,
               sha256(unhex('{_OUTER}') || unhex(sha256(unhex('{_INNER}') || encode(payload)))) AS signature
        FROM p""",
)
def f29(spark: SparkSession, d: str) -> DataFrame:
    signed = sign_rows(V.ev(spark, d).select("event_id", "event_type"), _KEY)
    return verify_rows(signed, _KEY).drop("event_type")


@query(
    "f30_partition_number",
    """SELECT employee_id, CAST(('0x' || substr(md5(CAST(employee_id AS VARCHAR)), 1, 8))::BIGINT % 3 AS INTEGER) AS partition
       FROM emp""",
)
def f30(spark: SparkSession, d: str) -> DataFrame:
    return V.emp(spark, d).select("employee_id", S.partition_number("employee_id", 3).alias("partition"))


@query(
    "f31_percent_text",
    """SELECT count(*) AS total_checks, count(*) FILTER (nulls = 0) AS passed, count(*) FILTER (nulls > 0) AS failed,
              printf('%.1f%%', 100.0 * count(*) FILTER (nulls = 0) / count(*)) AS pass_rate
       FROM (SELECT count(*) FILTER (employee_id IS NULL) AS nulls FROM att_raw
             UNION ALL SELECT count(*) FILTER (date IS NULL) FROM att_raw
             UNION ALL SELECT count(*) FILTER (status IS NULL) FROM att_raw)""",
)
def f31(spark: SparkSession, d: str) -> DataFrame:
    return summarize(check_completeness(V.att_raw(spark, d), "attendance"))


@query(
    "f32_casts",
    "SELECT employee_id, CAST(is_active AS INTEGER) AS active, CAST(join_date AS VARCHAR) AS join_date FROM emp",
)
def f32(spark: SparkSession, d: str) -> DataFrame:
    emp = V.emp(spark, d)
    return emp.select(
        "employee_id", F.col("is_active").cast("int").alias("active"),
        F.col("join_date").cast("string").cast("date").alias("join_date"),
    )


@query(
    "f33_random_score",
    "SELECT count(*) AS n, true AS in_range FROM att",
)
def f33(spark: SparkSession, d: str) -> DataFrame:
    scored = V.att(spark, d).select("attendance_id", random_score(11).alias("score"))
    return scored.agg(rows().alias("n"), F.bool_and(F.col("score").between(0, 100)).alias("in_range"))


@query(
    "t05_parse_records",
    """SELECT employee_id AS key_employee_id, event_id, employee_id, event_type, timestamp, department, location,
              device_id, source, CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude,
              event_ts AS kafka_ts, 0 AS partition, CAST(event_id AS BIGINT) AS "offset", event_ts FROM ev""",
)
def t05(spark: SparkSession, d: str) -> DataFrame:
    from rollcall.sources.kafka import parse_records, to_records

    fields = [f.name for f in EVENT.fields if f.name not in ("latitude", "longitude")]
    events = V.ev(spark, d)
    records = to_records(events.select(*fields, "event_ts")).select(
        F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"),
        F.get_json_object("value", "$.timestamp").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("partition"),
        F.get_json_object("value", "$.event_id").cast("bigint").alias("offset"),
    )
    return wall_time(parse_records(records), "kafka_ts", "event_ts")
