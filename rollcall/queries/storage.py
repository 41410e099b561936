"""Queries for sources, sinks and versioned tables: data is written to the shared folder and read back."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from rollcall.operators import tableops as L
from rollcall.operators.aggregates import department_attendance, rows
from rollcall.operators.quality import report_document, run_all
from rollcall.queries import views as V
from rollcall.queries.common import AS_OF, union_all
from rollcall.queries.registry import query
from rollcall.session import shared_path
from rollcall.sources import readers, writers
from rollcall.sources.files import list_names

_ATT = ["attendance_id", "employee_id", "date", "status", "hours_worked"]
_ATT_SQL = "SELECT attendance_id, employee_id, CAST(date AS VARCHAR) AS date, status, hours_worked FROM att"


def _att(spark: SparkSession, d: str) -> DataFrame:
    return V.att(spark, d).select(*_ATT)


@query("s02_csv_scan", "SELECT attendance_id, employee_id, date, status, hours_worked FROM att_raw")
def s02(spark: SparkSession, d: str) -> DataFrame:
    path = shared_path(spark, "csv")
    raw = V.att_raw(spark, d).select(*_ATT)
    writers.write_csv(raw, path)
    return readers.read_csv(spark, path, raw.schema, keep_corrupt=True).drop(readers.CORRUPT)


@query(
    "s03_large_scan",
    "SELECT l_returnflag, CAST(sum(l_quantity) AS DOUBLE) / count(*) AS avg_quantity, count(*) AS total_rows FROM lineitem GROUP BY l_returnflag",
)
def s03(spark: SparkSession, d: str) -> DataFrame:
    lines = V.table(spark, d, "lineitem")
    return lines.groupBy("l_returnflag").agg(
        F.try_divide(F.sum("l_quantity"), rows()).alias("avg_quantity"), rows().alias("total_rows")
    )


@query("s04_stored_or_csv", "SELECT employee_id, name, department, salary FROM emp")
def s04(spark: SparkSession, d: str) -> DataFrame:
    path = shared_path(spark, "staff")
    name = f"staff_{path[-12:]}"
    assert readers.load_table(spark, name).columns == []
    emp = V.emp(spark, d).select("employee_id", "name", "department", "salary")
    writers.write_table(emp, name, path=path)
    return readers.load_table(spark, name)


@query("s05_parquet_scan", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 400000")
def s05(spark: SparkSession, d: str) -> DataFrame:
    orders = readers.read_parquet(spark, f"{d}/orders.parquet")
    return orders.filter(F.col("o_totalprice") > 400000).select("o_orderkey", "o_totalprice")


@query("s06_parquet_sink", _ATT_SQL)
def s06(spark: SparkSession, d: str) -> DataFrame:
    path = shared_path(spark, "parquet")
    writers.write_parquet(_att(spark, d), path)
    return readers.read_parquet(spark, path)


@query(
    "s07_run_date_partition",
    "SELECT '2001-07-30' AS ds, count(*) AS \"rows\" FROM att UNION ALL SELECT '2001-07-31', count(*) FROM att WHERE status = 'Present'",
)
def s07(spark: SparkSession, d: str) -> DataFrame:
    path, att = shared_path(spark, "rundate"), _att(spark, d)
    writers.write_run_date(att, path, date(2001, 7, 30))
    writers.write_run_date(att, path, date(2001, 7, 31))
    writers.write_run_date(att.filter("status = 'Present'"), path, date(2001, 7, 31))  # repeated run
    return spark.read.parquet(path).groupBy(F.col("ds").cast("string").alias("ds")).agg(rows().alias("rows"))


@query("s08_csv_sink", "SELECT employee_id, count(*) AS records FROM att GROUP BY employee_id")
def s08(spark: SparkSession, d: str) -> DataFrame:
    path = shared_path(spark, "csvout")
    writers.write_csv(V.att(spark, d).groupBy("employee_id").agg(rows().alias("records")), path)
    return readers.read_csv(spark, path, T.StructType.fromDDL("employee_id BIGINT, records BIGINT"))


@query("s09_table_sink", "SELECT status, 2 * count(*) AS records FROM att GROUP BY status")
def s09(spark: SparkSession, d: str) -> DataFrame:
    path, att = shared_path(spark, "table"), _att(spark, d)
    name = f"attendance_{path[-12:]}"
    writers.write_table(att, name, "overwrite", path)
    writers.write_table(att, name, "append")
    return spark.table(name).groupBy("status").agg(rows().alias("records"))


@query(
    "s10_create_table_as",
    """SELECT department, count(*) AS total_records, count(*) FILTER (status = 'Present') AS present,
              sum(overtime_hours) AS total_overtime FROM att GROUP BY department""",
)
def s10(spark: SparkSession, d: str) -> DataFrame:
    path = shared_path(spark, "ctas")
    name = f"summary_{path[-12:]}"
    text = """SELECT department, count(*) AS total_records, count_if(status = 'Present') AS present,
                     sum(overtime_hours) AS total_overtime FROM {att} GROUP BY department"""
    writers.create_table_as(spark, name, text, path, att=V.att(spark, d))
    writers.create_table_as(spark, name, text, path, att=V.att(spark, d))  # replaces the first
    return spark.table(name)


@query(
    "s11_json_scan",
    "SELECT event_id, employee_id, event_type, timestamp, department FROM ev",
)
def s11(spark: SparkSession, d: str) -> DataFrame:
    path = shared_path(spark, "json")
    events = V.ev(spark, d).select("event_id", "employee_id", "event_type", "timestamp", "department")
    writers.write_json(events, path)
    return readers.read_json_lines(spark, path, events.schema)


@query("s12_json_report", "SELECT 17 AS results, '2001-07-31T00:00:00' AS generated_at, count(*) > 0 AS has_rows FROM att_raw")
def s12(spark: SparkSession, d: str) -> DataFrame:
    path = shared_path(spark, "report")
    results = run_all(V.att_raw(spark, d), V.emp(spark, d), AS_OF)
    writers.write_report(report_document(results, datetime(2001, 7, 31)), path)
    return spark.read.json(path).select(
        F.size("results").alias("results"), "generated_at", (F.size("results") > 0).alias("has_rows")
    )


@query("s20_by_day", "SELECT year(date) AS year, month(date) AS month, day(date) AS day, count(*) AS records FROM att GROUP BY ALL")
def s20(spark: SparkSession, d: str) -> DataFrame:
    path = shared_path(spark, "monthly")
    # the benchmark period has thousands of days; a folder per month keeps the file count sensible
    writers.write_by_day(_att(spark, d), path, depth=2)
    stored = spark.read.parquet(path)
    return stored.groupBy("year", "month", F.dayofmonth("date").alias("day")).agg(rows().alias("records"))


@query(
    "s20_year_month_day",
    """SELECT year(date) AS year, month(date) AS month, day(date) AS day, count(*) AS records FROM att_ev GROUP BY ALL""",
)
def s20b(spark: SparkSession, d: str) -> DataFrame:
    path = shared_path(spark, "lake")
    writers.write_by_day(V.att_ev(spark, d).select("attendance_id", "date"), path)
    return spark.read.parquet(path).groupBy("year", "month", "day").agg(rows().alias("records"))


@query(
    "s21_archive",
    """SELECT 'archived' AS part, count(*) AS "rows" FROM att WHERE date < DATE '2001-07-01'
       UNION ALL SELECT 'open', count(*) FROM att WHERE date >= DATE '2001-07-01'""",
)
def s21(spark: SparkSession, d: str) -> DataFrame:
    path = shared_path(spark, "archive")
    rows_of_days, late = _att(spark, d), F.coalesce(F.col("status") == "Absent", F.lit(False))
    for _ in range(2):  # the job runs again after a failure
        rest = writers.archive_closed(rows_of_days.filter(~late), path, AS_OF, "first")
    # delivered later, for months already archived
    rest = rest.unionByName(writers.archive_closed(rows_of_days.filter(late), path, AS_OF, "late"))
    parts = {"archived": spark.read.parquet(path), "open": rest}
    return union_all([df.agg(rows().alias("rows")).withColumn("part", F.lit(n)) for n, df in parts.items()])


@query(
    "s22_retention",
    """SELECT CAST(date AS VARCHAR) AS ds, count(*) AS "rows" FROM att_ev WHERE date >= DATE '2024-01-24' GROUP BY date""",
)
def s22(spark: SparkSession, d: str) -> DataFrame:
    path = shared_path(spark, "retention")
    events = V.att_ev(spark, d).select("attendance_id", F.col("date").cast("string").alias("ds"))
    events.write.partitionBy("ds").parquet(path)
    writers.expire_partitions(spark, path, date(2024, 1, 31), 7)
    return spark.read.parquet(path).groupBy(F.col("ds").cast("string").alias("ds")).agg(rows().alias("rows"))


# --- versioned tables ---------------------------------------------------------------------

def _small(spark: SparkSession, d: str) -> DataFrame:
    return V.att_ev(spark, d).select("attendance_id", "employee_id", "date", "status", "hours_worked")


@query("l01_overwrite", "SELECT 0 AS version, status, count(*) AS records FROM att_ev GROUP BY status")
def l01(spark: SparkSession, d: str) -> DataFrame:
    table = L.VersionedTable(spark, shared_path(spark, "versions"))
    version = table.overwrite(_small(spark, d))
    return table.read().groupBy("status").agg(rows().alias("records")).withColumn("version", F.lit(version))


@query(
    "l02_append_shifted",
    """SELECT attendance_id, CAST(date AS VARCHAR) AS date FROM att
       UNION ALL SELECT attendance_id, CAST(date + 365 AS VARCHAR) FROM
           (SELECT * FROM att ORDER BY attendance_id LIMIT 100)""",
)
def l02(spark: SparkSession, d: str) -> DataFrame:
    return L.append_shifted(V.att(spark, d).select("attendance_id", "date"), ["attendance_id"])


_CORRECTIONS = """(SELECT employee_id, date, min(attendance_id) AS k, 8.5::DOUBLE AS hours_worked, 'Present' AS status
                   FROM att WHERE status = 'Absent' GROUP BY employee_id, date
                   UNION ALL SELECT employee_id, DATE '2030-01-01', NULL, 8.5, 'Present' FROM emp WHERE is_active)"""


def _corrections(spark: SparkSession, d: str) -> DataFrame:
    absent = V.att(spark, d).filter("status = 'Absent'").select("employee_id", "date").distinct()
    later = V.emp(spark, d).filter("is_active").select("employee_id", F.lit(date(2030, 1, 1)).alias("date"))
    fixed = {"hours_worked": F.lit(8.5), "status": F.lit("Present")}
    return absent.unionByName(later).withColumns(fixed)


_UPSERTED = f"""
    SELECT a.attendance_id, a.employee_id, a.date, coalesce(c.status, a.status) AS status,
           coalesce(c.hours_worked, a.hours_worked) AS hours_worked
    FROM att a LEFT JOIN {_CORRECTIONS} c ON a.employee_id = c.employee_id AND a.date = c.date
    UNION ALL SELECT NULL, c.employee_id, c.date, c.status, c.hours_worked FROM {_CORRECTIONS} c
    WHERE NOT EXISTS (SELECT 1 FROM att a WHERE a.employee_id = c.employee_id AND a.date = c.date)"""


@query("l03_upsert", f"SELECT * REPLACE (CAST(date AS VARCHAR) AS date) FROM ({_UPSERTED})")
def l03(spark: SparkSession, d: str) -> DataFrame:
    target = V.att(spark, d).select("attendance_id", "employee_id", "date", "status", "hours_worked")
    return L.upsert(target, _corrections(spark, d), ["employee_id", "date"])


@query(
    "l03_upsert_latest",
    f"""SELECT * REPLACE (CAST(date AS VARCHAR) AS date) FROM ({_UPSERTED})""",
)
def l03b(spark: SparkSession, d: str) -> DataFrame:
    """Three corrections for every key, of which the newest counts; the older ones have other figures."""
    target = V.att(spark, d).select("attendance_id", "employee_id", "date", "status", "hours_worked")
    newest = _corrections(spark, d).withColumn("sent", F.lit(3))
    older = [newest.withColumns({"hours_worked": F.lit(float(n)), "status": F.lit("Late"), "sent": F.lit(n)}) for n in (1, 2)]
    return L.upsert(target, union_all([older[0], newest, older[1]]), ["employee_id", "date"], [F.desc("sent")])


@query(
    "l04_time_travel",
    f"""SELECT 0 AS version, count(*) AS "rows", count(*) FILTER (status = 'Present') AS present FROM att
        UNION ALL SELECT 1, count(*), count(*) FILTER (status = 'Present') FROM ({_UPSERTED})""",
)
def l04(spark: SparkSession, d: str) -> DataFrame:
    table = L.VersionedTable(spark, shared_path(spark, "versions"))
    table.overwrite(_att(spark, d))
    table.merge(_corrections(spark, d), ["employee_id", "date"])
    present = F.count_if(F.col("status") == "Present").alias("present")
    return union_all([
        table.read(v).agg(rows().alias("rows"), present).withColumn("version", F.lit(v)) for v in (0, 1)
    ])


@query(
    "l05_history",
    """SELECT * FROM (VALUES (0, 'WRITE', 0), (1, 'APPEND', 0), (2, 'ADD COLUMN', 2)) h(version, operation, base),
              (SELECT 2 * count(*) AS "rows" FROM att_ev) n""",
)
def l05(spark: SparkSession, d: str) -> DataFrame:
    table = L.VersionedTable(spark, shared_path(spark, "versions"))
    small = _small(spark, d)
    table.overwrite(small)
    table.append(small)
    table.evolve("data_quality_score", L.random_score(3))
    total = table.read().agg(rows()).scalar()
    return table.history().drop("timestamp").withColumn("rows", total)


@query(
    "l06_add_column",
    """SELECT attendance_id, 'EVT' AS origin FROM att_ev UNION ALL SELECT attendance_id, NULL FROM att_ev""",
)
def l06(spark: SparkSession, d: str) -> DataFrame:
    table = L.VersionedTable(spark, shared_path(spark, "versions"))
    ids = _small(spark, d).select("attendance_id")
    table.overwrite(ids)
    table.append(ids.withColumn("origin", F.lit("EVT")))
    return table.read()


@query("l07_compact_and_purge", "SELECT count(*) AS \"rows\", 1 AS folders_removed, 2 AS files FROM att_ev")
def l07(spark: SparkSession, d: str) -> DataFrame:
    root = shared_path(spark, "versions")
    table = L.VersionedTable(spark, root)
    table.overwrite(_small(spark, d))
    version = table.compact(2)
    gone = table.purge(version)
    files = [n for n in list_names(spark, f"{root}/v={version}") if n.endswith(".parquet")]
    return table.read().agg(rows().alias("rows")).withColumns(
        {"folders_removed": F.lit(len(gone)), "files": F.lit(len(files))}
    )


@query(
    "l07_pruned_read",
    "SELECT attendance_id, status FROM att WHERE year(date) = 1998 AND month(date) = 3",
)
def l07b(spark: SparkSession, d: str) -> DataFrame:
    path = shared_path(spark, "pruned")
    writers.write_by_day(_att(spark, d), path, depth=2)
    march = spark.read.parquet(path).filter((F.col("year") == 1998) & (F.col("month") == 3))
    return march.select("attendance_id", "status")


@query(
    "g01_summary_table",
    """SELECT department, count(*) AS total_records, count(*) FILTER (status = 'Present') AS present,
              avg(hours_worked) AS avg_hours, sum(overtime_hours) AS total_overtime FROM att GROUP BY department""",
)
def g01b(spark: SparkSession, d: str) -> DataFrame:
    path = shared_path(spark, "summary")
    name = f"dept_attendance_summary_{path[-12:]}"
    writers.write_table(department_attendance(V.att(spark, d), digits=None), name, path=path)
    return spark.table(name)
