"""The attendance model as views over the benchmark tables.

Every view is a projection of one table, so filters and column choice reach its
scan. The same definitions are given as SQL for the reference results.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

# Names the derived columns draw from.
DEPARTMENT_NAMES = [
    "Research", "People", "Accounts", "Trade", "Press", "Logistics", "Counsel", "Helpdesk",
]
LOCATION_NAMES = ["Aarau", "Bergen", "Cork", "Dijon", "Essen", "Faro"]
DESIGNATION_NAMES = ["Clerk", "Senior Clerk", "Lead", "Senior Lead", "Head"]


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One benchmark table; its schema is looked up once."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _pick(names: list[str], index: str) -> str:
    values = ", ".join(f"'{n}'" for n in names)
    return f"element_at(array({values}), CAST({index} AS INT) + 1)"


def _department(key: str) -> str:
    slot = f"({key} * 7 + 3) % 11"
    return _pick(DEPARTMENT_NAMES, f"if({slot} >= 8, 0, {slot})")


def _choose(cases: dict[str, str], otherwise: str | None = None) -> str:
    """CASE from conditions and text values."""
    whens = " ".join(f"WHEN {condition} THEN '{value}'" for condition, value in cases.items())
    return f"CASE {whens}{f' ELSE {chr(39)}{otherwise}{chr(39)}' if otherwise else ''} END"


EMP = f"""
    c_custkey AS employee_id
    c_name AS name
    CASE WHEN c_custkey % 50 = 3 THEN NULL WHEN c_custkey % 50 = 7 THEN c_name ELSE concat(c_name, '@Corp.example ') END AS email
    {_department("c_custkey")} AS department
    {_pick(DESIGNATION_NAMES, "c_custkey % 5")} AS designation
    {_pick(LOCATION_NAMES, "c_custkey % 6")} AS location
    if(c_custkey >= 5, c_custkey % 5, NULL) AS manager_id
    date_add(DATE '2015-01-01', CAST(c_custkey % 2000 AS INT)) AS join_date
    c_acctbal * 16 AS salary
    c_custkey % 20 <> 0 AS is_active
"""

_SHARE = "(o_orderkey * 7) % 100"
_ATT_STATUS = _choose({
    f"{_SHARE} < 65": "Present", f"{_SHARE} < 73": "Absent", f"{_SHARE} < 83": "Late",
    f"{_SHARE} < 88": "Half-Day", f"{_SHARE} < 96": "Work-From-Home", f"{_SHARE} < 98": "On-Leave",
})
_PRIORITY = "substring(o_orderpriority, 1, 1)"
_ATT_SHIFT = _choose(
    {f"{_PRIORITY} IN ('1', '2')": "Morning", f"{_PRIORITY} = '3'": "Afternoon", f"{_PRIORITY} = '4'": "Night"}, "Evening"
)

ATT = f"""
    o_orderkey AS attendance_id
    o_custkey AS employee_id
    CAST(o_orderdate AS DATE) AS date
    date_format(o_orderdate, 'EEEE') AS day_of_week
    {_ATT_SHIFT} AS shift
    {_ATT_STATUS} AS status
    if(o_orderkey % 20 <> 7, '09:00:00', NULL) AS check_in
    if(o_orderkey % 20 <> 7, '17:00:00', NULL) AS check_out
    if(o_orderkey % 20 <> 7, (o_orderkey * 13) % 40 / 2 - 2, NULL) AS hours_worked
    (o_orderkey * 13) % 12 / 2 AS overtime_hours
    if(o_orderkey % 50 <> 11, {_department("o_custkey")}, NULL) AS department
    {_pick(LOCATION_NAMES, "o_custkey % 6")} AS location
    if(o_orderkey % 10 = 0, 'note', NULL) AS notes
"""

ATT_RAW = """
    if(attendance_id % 97 = 5, 'not-a-date', CAST(date AS STRING)) AS date
    if(attendance_id % 211 <> 3, employee_id, NULL) AS employee_id
    if(attendance_id % 31 <> 4, overtime_hours, NULL) AS overtime_hours
"""

_EV_STATUS = _choose({
    "event_type IN ('view', 'click')": "Present", "event_type = 'error'": "Absent",
    "event_type = 'signup'": "Late", "event_type = 'purchase'": "Work-From-Home",
})

ATT_EV = f"""
    event_id AS attendance_id
    user_id AS employee_id
    CAST(ts AS DATE) AS date
    date_format(ts, 'EEEE') AS day_of_week
    {_EV_STATUS} AS status
    floor(value * 2) / 2 AS hours_worked
    CAST(floor(value) % 5 AS DOUBLE) AS overtime_hours
    {_department("user_id")} AS department
"""

LEAVES = f"""
    l_orderkey * 10 + l_linenumber AS leave_id
    l_suppkey AS employee_id
    {_choose({"l_returnflag = 'A'": "Sick", "l_returnflag = 'N'": "Casual"}, "Earned")} AS leave_type
    CAST(l_shipdate AS DATE) AS start_date
    date_add(CAST(l_shipdate AS DATE), l_linenumber % 5 + 1) AS end_date
    l_linestatus = 'F' AS approved
    l_suppkey % 5 AS approved_by
"""

_EV_TYPE = _choose(
    {"event_type = 'view'": "CHECK_IN", "event_type = 'click'": "CHECK_OUT", "event_type = 'error'": "BREAK_START",
     "event_type = 'signup'": "BREAK_END"}, "OVERTIME_START"
)

EV = f"""
    CAST(event_id AS STRING) AS event_id
    CAST(user_id AS STRING) AS employee_id
    {_EV_TYPE} AS event_type
    date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS") AS timestamp
    {_department("user_id")} AS department
    {_pick(LOCATION_NAMES, "user_id % 6")} AS location
    concat('DEV', user_id % 10) AS device_id
    if(user_id % 2 = 0, 'mobile', 'biometric') AS source
    CAST(ts AS TIMESTAMP) AS event_ts
    CAST(ts AS TIMESTAMP) + make_dt_interval(0, 0, 0, CAST(get_json_object(props, '$.k') AS DECIMAL(18, 6))) AS processing_time
    props
"""


def _columns(text: str) -> list[str]:
    return [line.strip() for line in text.strip().splitlines()]


def emp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Employees from customer."""
    return table(spark, sf_dir, "customer").selectExpr(*_columns(EMP))


def dept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Departments from their employees; the budget stands in for a planned one."""
    people = emp(spark, sf_dir)
    pay = F.sum(F.greatest(F.floor("salary"), F.lit(0))).cast("double")
    return people.groupBy(F.col("department").alias("department_name")).agg(
        F.min("employee_id").alias("department_id"), F.min("name").alias("head"), pay.alias("budget")
    )


def att(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attendance from orders: typed dates, some statuses, hours and departments missing."""
    return table(spark, sf_dir, "orders").selectExpr(*_columns(ATT))


def att_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attendance as it would come from a file: date text, some unreadable, some ids missing."""
    typed = att(spark, sf_dir)
    changed = {line.rsplit(" AS ", 1)[1]: line for line in _columns(ATT_RAW)}
    return typed.selectExpr(*[changed.get(c, c) for c in typed.columns])


def att_ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A denser attendance table from events: several rows per employee and day."""
    return table(spark, sf_dir, "events").selectExpr(*_columns(ATT_EV))


def leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leave requests from lineitem."""
    return table(spark, sf_dir, "lineitem").selectExpr(*_columns(LEAVES))


def events_to_ev(events: DataFrame) -> DataFrame:
    """Check-in events from events; works on the table and on a stream of it."""
    return events.selectExpr(*_columns(EV))


def ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_to_ev(table(spark, sf_dir, "events"))


# --- the same views for the reference SQL ------------------------------------------------

def _sql_list(names: list[str]) -> str:
    return "[" + ", ".join(f"'{n}'" for n in names) + "]"


def _sql_department(k: str) -> str:
    slot = f"(({k} * 7 + 3) % 11)"
    return f"({_sql_list(DEPARTMENT_NAMES)})[CASE WHEN {slot} >= 8 THEN 0 ELSE {slot} END + 1]"


SQL_VIEWS: dict[str, str] = {
    "emp": f"""
        SELECT c_custkey AS employee_id, c_name AS name,
               CASE WHEN c_custkey % 50 = 3 THEN NULL WHEN c_custkey % 50 = 7 THEN c_name
                    ELSE c_name || '@Corp.example ' END AS email,
               {_sql_department("c_custkey")} AS department,
               ({_sql_list(DESIGNATION_NAMES)})[c_custkey % 5 + 1] AS designation,
               ({_sql_list(LOCATION_NAMES)})[c_custkey % 6 + 1] AS location,
               CASE WHEN c_custkey >= 5 THEN c_custkey % 5 END AS manager_id,
               DATE '2015-01-01' + CAST(c_custkey % 2000 AS INTEGER) AS join_date,
               c_acctbal * 16 AS salary, c_custkey % 20 <> 0 AS is_active
        FROM customer""",
    "dept": """
        SELECT department AS department_name, min(employee_id) AS department_id, min(name) AS head,
               CAST(sum(greatest(CAST(floor(salary) AS BIGINT), 0)) AS DOUBLE) AS budget
        FROM emp GROUP BY department""",
    "att": f"""
        SELECT o_orderkey AS attendance_id, o_custkey AS employee_id,
               CAST(o_orderdate AS DATE) AS date, dayname(o_orderdate) AS day_of_week,
               CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2') THEN 'Morning'
                    WHEN substr(o_orderpriority, 1, 1) = '3' THEN 'Afternoon'
                    WHEN substr(o_orderpriority, 1, 1) = '4' THEN 'Night' ELSE 'Evening' END AS shift,
               CASE WHEN (o_orderkey * 7) % 100 < 65 THEN 'Present' WHEN (o_orderkey * 7) % 100 < 73 THEN 'Absent'
                    WHEN (o_orderkey * 7) % 100 < 83 THEN 'Late' WHEN (o_orderkey * 7) % 100 < 88 THEN 'Half-Day'
                    WHEN (o_orderkey * 7) % 100 < 96 THEN 'Work-From-Home'
                    WHEN (o_orderkey * 7) % 100 < 98 THEN 'On-Leave' END AS status,
               CASE WHEN o_orderkey % 20 <> 7 THEN '09:00:00' END AS check_in,
               CASE WHEN o_orderkey % 20 <> 7 THEN '17:00:00' END AS check_out,
               CASE WHEN o_orderkey % 20 <> 7
                    THEN CAST((o_orderkey * 13) % 40 AS DOUBLE) / 2 - 2 END AS hours_worked,
               CAST((o_orderkey * 13) % 12 AS DOUBLE) / 2 AS overtime_hours,
               CASE WHEN o_orderkey % 50 <> 11 THEN {_sql_department("o_custkey")} END AS department,
               ({_sql_list(LOCATION_NAMES)})[o_custkey % 6 + 1] AS location,
               CASE WHEN o_orderkey % 10 = 0 THEN 'note' END AS notes
        FROM orders""",
    "att_raw": """
        SELECT * REPLACE (
               CASE WHEN attendance_id % 97 = 5 THEN 'not-a-date' ELSE CAST(date AS VARCHAR) END AS date,
               CASE WHEN attendance_id % 211 <> 3 THEN employee_id END AS employee_id,
               CASE WHEN attendance_id % 31 <> 4 THEN overtime_hours END AS overtime_hours)
        FROM att""",
    "att_ev": f"""
        SELECT event_id AS attendance_id, user_id AS employee_id, CAST(ts AS DATE) AS date,
               dayname(ts) AS day_of_week,
               CASE WHEN event_type IN ('view', 'click') THEN 'Present' WHEN event_type = 'error' THEN 'Absent'
                    WHEN event_type = 'signup' THEN 'Late' WHEN event_type = 'purchase' THEN 'Work-From-Home'
                    END AS status,
               CAST(floor(value * 2) AS DOUBLE) / 2 AS hours_worked,
               CAST(CAST(floor(value) AS BIGINT) % 5 AS DOUBLE) AS overtime_hours,
               {_sql_department("user_id")} AS department
        FROM events""",
    "leaves": """
        SELECT l_orderkey * 10 + l_linenumber AS leave_id, l_suppkey AS employee_id,
               CASE WHEN l_returnflag = 'A' THEN 'Sick' WHEN l_returnflag = 'N' THEN 'Casual'
                    ELSE 'Earned' END AS leave_type,
               CAST(l_shipdate AS DATE) AS start_date,
               CAST(l_shipdate AS DATE) + CAST(l_linenumber % 5 + 1 AS INTEGER) AS end_date,
               l_linestatus = 'F' AS approved, l_suppkey % 5 AS approved_by
        FROM lineitem""",
    "ev": f"""
        SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS employee_id,
               CASE WHEN event_type = 'view' THEN 'CHECK_IN' WHEN event_type = 'click' THEN 'CHECK_OUT'
                    WHEN event_type = 'error' THEN 'BREAK_START' WHEN event_type = 'signup' THEN 'BREAK_END'
                    ELSE 'OVERTIME_START' END AS event_type,
               strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp,
               {_sql_department("user_id")} AS department,
               ({_sql_list(LOCATION_NAMES)})[user_id % 6 + 1] AS location,
               'DEV' || (user_id % 10) AS device_id,
               CASE WHEN user_id % 2 = 0 THEN 'mobile' ELSE 'biometric' END AS source,
               ts AS event_ts,
               ts + to_seconds(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS processing_time,
               props
        FROM events""",
}

# date parts are 32-bit integers in Spark and 64-bit ones in the reference engine
_DATE_PART = re.compile(r"\b(?:year|month|day|week|hour|quarter|isodow)\((?:[^()]|\([^()]*\))*\)")

_NEEDS = {"dept": ["emp"], "att_raw": ["att"]}


def reference_sql(body: str) -> str:
    """The statement with the views it mentions put in front as common table expressions."""
    # a quoted 'emp' or a column such as att.date also matches; an unused view costs nothing
    wanted = [v for v in SQL_VIEWS if re.search(rf"\b{v}\b", body)]
    ordered: list[str] = []
    for v in wanted:
        for need in [*_NEEDS.get(v, []), v]:
            if need not in ordered:
                ordered.append(need)
    body = _DATE_PART.sub(lambda m: f"CAST({m.group()} AS INTEGER)", body.strip())
    if not ordered:
        return body
    views = ", ".join(f"{v} AS ({SQL_VIEWS[v]})" for v in ordered)
    if body.upper().startswith("WITH "):
        return f"WITH {views}, {body[5:]}"
    return f"WITH {views} {body}"
