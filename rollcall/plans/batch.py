"""Batch jobs: ingest, merge and summarise, analyse, load the star schema."""

from __future__ import annotations

import time
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.errors import PySparkException

from rollcall.operators import aggregates as A
from rollcall.operators import cleaning, quality, statistics, warehouse
from rollcall.operators.relational import nan_as_null
from rollcall.operators.windows import top_rows_by_hours
from rollcall.schemas import TABLES
from rollcall.sources.files import path_exists
from rollcall.sources.readers import directory_report, read_csv, read_directory
from rollcall.sources.writers import write_csv, write_parquet, write_table

INGEST_ORDER = ["departments", "employees", "attendance", "leaves"]


@dataclass
class IngestResult:
    table: str
    status: str  # loaded, empty, missing, rejected, failed
    rows: int
    seconds: float
    detail: str = ""


def ingest_table(df: DataFrame, table: str, mode: str = "overwrite", path: str | None = None) -> IngestResult:
    """Check the required columns, drop empty rows, NaN to null, store.

    Rows are counted while they are written, not by another scan.
    """
    started = time.perf_counter()
    missing = quality.missing_columns(df, table)
    if missing:
        return IngestResult(table, "rejected", 0, 0.0, f"missing columns: {missing}")
    seen = Observation(f"ingest_{table}")
    clean = nan_as_null(df.dropna(how="all")).observe(seen, F.count(F.lit(1)).alias("rows"))
    try:
        write_table(clean, table, mode, path)
    except PySparkException as error:
        return IngestResult(table, "failed", 0, time.perf_counter() - started, str(error))
    return IngestResult(table, "loaded", seen.get["rows"], time.perf_counter() - started)


def ingest_file(
    spark: SparkSession, csv_path: str, table: str, mode: str = "overwrite", path: str | None = None
) -> IngestResult:
    """Ingest one CSV file. A missing one, or one without rows, leaves what is stored as it is and is not counted as processed."""
    if not path_exists(spark, csv_path):
        return IngestResult(table, "missing", 0, 0.0, csv_path)
    if spark.read.option("header", True).csv(csv_path).isEmpty():
        return IngestResult(table, "empty", 0, 0.0, csv_path)
    # the header decides which columns there are; the declared types are used for those known
    header = spark.read.option("header", True).csv(csv_path).columns
    declared = {f.name: f for f in TABLES[table].fields} if table in TABLES else {}
    if [c for c in header if c in declared] and set(header) <= set(declared):
        df = read_csv(spark, csv_path, type(TABLES[table])([declared[c] for c in header]))
    else:
        df = read_csv(spark, csv_path)
    return ingest_table(df, table, mode, path)


def summary_tables(att: DataFrame) -> dict[str, DataFrame]:
    return {
        "dept_attendance_summary": A.department_attendance(att),
        "monthly_trend": A.monthly_trend(att),
    }


def full_batch(spark: SparkSession, folder: str, root: str | None = None) -> list[IngestResult]:
    """Ingest the four files in order, then store the two summaries.

    One file that is missing or bad does not stop the others.
    """
    def place(name: str) -> str | None:
        return f"{root}/{name}" if root else None

    results = [
        ingest_file(spark, f"{folder}/{name}.csv", name, "overwrite", place(name)) for name in INGEST_ORDER
    ]
    if any(r.table == "attendance" and r.status == "loaded" for r in results):
        for name, df in summary_tables(spark.table("attendance")).items():
            write_table(df, name, "overwrite", place(name))
    return results


def ingest_report(spark: SparkSession, results: Iterable[IngestResult]) -> DataFrame:
    """Files processed, rows ingested, files failed, seconds."""
    rows = [(r.table, r.status, r.rows, r.seconds) for r in results]
    table = spark.createDataFrame(rows, "table string, status string, rows bigint, seconds double")
    return table.agg(
        F.count_if(F.col("status") == "loaded").alias("files_processed"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows_ingested"),
        F.count_if(F.col("status").isin("failed", "rejected")).alias("files_failed"),
        F.coalesce(F.sum("seconds"), F.lit(0.0)).alias("seconds"),
    )


def merge_and_summarize(spark: SparkSession, folder: str, out: str) -> dict[str, DataFrame]:
    """Read a folder of CSV files, store the enriched table and the employee summary.

    The summary reads the stored enriched rows, so cleaning and joins run once.
    """
    frames = read_directory(spark, folder, register=False)
    enriched = cleaning.merge_datasets(frames)
    write_parquet(enriched, f"{out}/attendance_enriched")
    stored = spark.read.parquet(f"{out}/attendance_enriched")
    write_csv(stored, f"{out}/attendance_enriched_csv")
    summary = A.employee_summary(stored)
    write_csv(summary, f"{out}/employee_summary_csv")
    return {"report": directory_report(frames), "enriched": stored, "summary": summary}


def analysis(att: DataFrame, out: str) -> dict[str, DataFrame]:
    """Profile, type advice, statistics, outliers, correlations, department hours; narrowed copy stored."""
    results = {
        "profile": quality.profile(att),
        "types": statistics.type_advice(att),
        "statistics": statistics.column_statistics(att, "hours_worked"),
        "outliers": statistics.iqr_outliers(att, "hours_worked"),
        "correlations": statistics.correlations(att),
        "department_hours": A.hours_per_row_by_department(att),
    }
    write_parquet(statistics.narrow_integers(att), f"{out}/attendance_optimized")
    return results


def load_star_schema(att: DataFrame, emp: DataFrame, dept: DataFrame, root: str) -> dict[str, DataFrame]:
    """Store the dimensions, then the fact table from the stored dimensions."""
    spark = att.sparkSession
    dims = {
        "dim_date": warehouse.dim_date(att),
        "dim_employee": warehouse.dim_employee(emp),
        "dim_department": warehouse.dim_department(dept),
        "dim_shift": warehouse.dim_shift(spark),
    }
    for name, df in dims.items():
        write_parquet(df, f"{root}/{name}")
    stored = {name: spark.read.parquet(f"{root}/{name}") for name in dims}
    fact = warehouse.fact_attendance(att, stored["dim_employee"], stored["dim_department"])
    write_parquet(fact, f"{root}/fact_attendance")
    return {**stored, "fact_attendance": spark.read.parquet(f"{root}/fact_attendance")}


def sample_queries(emp: DataFrame, att: DataFrame) -> dict[str, DataFrame]:
    """The three named reports of the query suite."""
    return {
        "Attendance by department": A.department_status_counts(att),
        "Top 5 overtime employees": A.top_overtime_names(emp, att),
        "Monthly attendance trend": A.monthly_present(att),
    }


def attendance_suite(raw: DataFrame, out: str) -> dict[str, DataFrame]:
    """Basics, feature columns, reports and top rows; the features are stored once and read back."""
    basics = {
        "status_distribution": A.value_counts(raw, "status"),
        "hours_by_department": A.hours_by_department(raw),
    }
    write_parquet(cleaning.feature_columns(raw), f"{out}/attendance")
    features = raw.sparkSession.read.parquet(f"{out}/attendance")
    return {
        **basics,
        "productivity": statistics.describe_numeric(features, "productivity_score"),
        "wfh_by_month": A.wfh_by_month(features),
        "monthly_rates": A.department_month_rates(features),
        "top_overtime": A.top_overtime(features),
        "absence_by_day": A.absence_by_day_number(features),
        "late_by_department": A.late_by_department(features),
        "top_rows": top_rows_by_hours(features),
    }
