"""The daily run: gate on empty cells, transform, load, report, check, retire old output."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import DataFrame

from rollcall.operators import aggregates as A
from rollcall.operators import cleaning, quality
from rollcall.sources.writers import expire_partitions, write_report, write_run_date


@dataclass
class RunStatus:
    run_date: date
    status: str  # loaded, alert, failed
    row_count: int
    null_rate: float | None
    removed: list[str] = field(default_factory=list)


def daily_run(raw: DataFrame, emp: DataFrame, run_date: date, root: str, keep_days: int = 7) -> RunStatus:
    """Run one day. A repeated run replaces that day's partition instead of adding to it.

    The transformed rows are staged by run date and loaded from there; the
    warehouse keeps every run date, and only staged rows older than ``keep_days``
    are retired. Only the gate's one row comes to the driver. A bad table stops the
    run before anything is written; a doubtful one is reported and not loaded.
    """
    spark = raw.sparkSession
    gate = quality.null_rate_gate(raw).first()
    if gate["decision"] == "fail":
        return RunStatus(run_date, "failed", gate["row_count"], gate["null_rate"])
    table, staging = f"{root}/dw_attendance_daily", f"{root}/staging/attendance_daily"
    if gate["decision"] == "alert":
        removed = expire_partitions(spark, staging, run_date, keep_days)
        return RunStatus(run_date, "alert", gate["row_count"], gate["null_rate"], removed)
    write_run_date(cleaning.daily_transform(raw), staging, run_date)
    staged = spark.read.parquet(f"{staging}/ds={run_date.isoformat()}")
    write_run_date(staged, table, run_date)
    stored = spark.read.parquet(table)
    write_report(A.daily_kpi(stored, run_date), f"{root}/reports/kpi_{run_date:%Y%m%d}")
    results = quality.run_all(raw, emp, run_date)
    write_report(
        quality.report_document(results, datetime.combine(run_date, datetime.min.time())),
        f"{root}/reports/dq_{run_date:%Y%m%d}",
    )
    removed = expire_partitions(spark, staging, run_date, keep_days)
    return RunStatus(run_date, "loaded", gate["row_count"], gate["null_rate"], removed)
