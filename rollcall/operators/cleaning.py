"""Cleaning and feature columns for raw attendance and employee records."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rollcall.functions.scalar import (
    clamp_filled,
    clean_text,
    clip,
    flag,
    is_weekend,
    iso_week,
    lookup,
    parse_date,
    parse_number,
    productivity,
    round_to,
    status_is,
    weekday_number,
    year_month,
)
from rollcall.operators.relational import enrich
from rollcall.operators.windows import keep_first
from rollcall.schemas import DEFAULT_HOURS

MAX_HOURS, MAX_OVERTIME = 14.0, 4.0  # Fixed values: daily caps.
MIN_SALARY, MAX_SALARY = 10000.0, 500000.0  # Fixed values: salary limits.


def clean_attendance(raw: DataFrame) -> DataFrame:
    """First record per (employee, raw date); statuses and hours filled; figures capped; dates parsed.

    Duplicates are judged on the date text as it came in. Missing hours follow
    from the status; overtime is only capped from above and may stay missing.
    """
    first = keep_first(raw, ["employee_id", "date"], [F.col("attendance_id")])
    status = F.coalesce(F.col("status"), F.lit("Unknown"))
    return (
        first.withColumn("status", status)
        .withColumn("hours_worked", F.coalesce("hours_worked", lookup("status", DEFAULT_HOURS)))
        .withColumn("hours_worked", clip("hours_worked", 0.0, MAX_HOURS))
        .withColumn("overtime_hours", clip("overtime_hours", high=MAX_OVERTIME))
        .withColumn("date", parse_date("date"))
        .dropna(subset=["date"])
    )


def clean_employees(raw: DataFrame, order: str | None = None) -> DataFrame:
    """One row per employee, salary limited, e-mail normalised, join date parsed.

    ``order`` names the column that says which of several rows came first; without
    it the choice is by the row's values, so it is the same on every run.
    """
    by = [F.col(order)] if order else [F.col(c) for c in raw.columns if c != "employee_id"]
    return (
        keep_first(raw, ["employee_id"], by)
        .withColumn("salary", clip("salary", MIN_SALARY, MAX_SALARY))
        .withColumn("email", clean_text("email"))
        .withColumn("join_date", parse_date("join_date"))
        .dropna(subset=["employee_id", "name"])
    )


def merge_datasets(frames: dict[str, DataFrame]) -> DataFrame:
    """Cleaned attendance with employee and department attributes and calendar columns.

    Takes the dirty variant of attendance where there is one.
    """
    missing = {"attendance", "employees", "departments"} - set(frames)
    if missing:
        raise ValueError(f"missing tables: {sorted(missing)}")
    attendance = clean_attendance(frames.get("attendance_dirty", frames["attendance"]))
    merged = enrich(attendance, clean_employees(frames["employees"]), frames["departments"])
    return merged.withColumns(
        {
            "is_weekend": is_weekend("date"),
            "month": F.month("date"),
            "year": F.year("date"),
            "week": iso_week("date"),
        }
    )


def _filled_and_capped(raw: DataFrame) -> DataFrame:
    return (
        raw.withColumns(
            {
                "status": F.coalesce(F.col("status"), F.lit("Unknown")),
                "hours_worked": clip(F.coalesce(F.col("hours_worked"), F.lit(0.0)), 0.0, MAX_HOURS),
                "overtime_hours": clip("overtime_hours", 0.0, MAX_OVERTIME),
                "date": parse_date("date"),
            }
        )
        .dropna(subset=["date", "employee_id"])
        .withColumn("is_present", flag(status_is("Present")))
    )


def etl_clean(raw: DataFrame, digits: int | None = 3) -> DataFrame:
    """Transform-before-load cleaning; missing overtime stays missing."""
    return _filled_and_capped(raw).withColumns(
        {
            "year_month": year_month("date"),
            "is_weekend": is_weekend("date"),
            "productivity_score": productivity("hours_worked", digits=digits),
        }
    )


def elt_clean(staged: DataFrame, digits: int | None = 3) -> DataFrame:
    """Cleaning of rows that were stored as they came: missing overtime becomes 0.

    The date is kept as it is and only has to be there; notes are not carried over.
    """
    hours = F.col("hours_worked")
    return (
        staged.dropna(subset=["employee_id", "date"])
        .withColumns(
            {
                "is_present": flag(status_is("Present")),
                "productivity_score": round_to(clamp_filled(hours / 8, 0.0, 1.5), digits),
                "hours_worked": clamp_filled(hours, 0.0, MAX_HOURS),
                "overtime_hours": clamp_filled("overtime_hours", 0.0, MAX_OVERTIME),
                "status": F.coalesce(F.col("status"), F.lit("Unknown")),
            }
        )
        .drop("notes")
    )


def daily_transform(raw: DataFrame) -> DataFrame:
    """The daily run's cleaning: fills, caps, month, year, presence flag."""
    return _filled_and_capped(raw).withColumns({"month": F.month("date"), "year": F.year("date")})


def feature_columns(raw: DataFrame, digits: int | None = 3) -> DataFrame:
    """Calendar, presence and productivity columns; the score has no lower limit here."""
    parsed = raw.withColumns(
        {
            "date": parse_date("date"),
            "hours_worked": parse_number("hours_worked"),
            "overtime_hours": parse_number("overtime_hours"),
            "status": F.coalesce(F.col("status"), F.lit("Unknown")),
        }
    )
    return parsed.withColumns(
        {
            "month": F.month("date"),
            "year": F.year("date"),
            "day_num": weekday_number("date"),
            "is_present": flag(status_is("Present")),
            "productivity_score": productivity("hours_worked", floor=None, digits=digits),
        }
    )


def dashboard_columns(raw: DataFrame) -> DataFrame:
    """Columns behind the dashboard figures; rows without a readable date stay."""
    parsed = raw.withColumns(
        {
            "date": parse_date("date"),
            "status": F.coalesce(F.col("status"), F.lit("Unknown")),
            "hours_worked": F.coalesce(F.col("hours_worked"), F.lit(0.0)),
        }
    )
    return parsed.withColumns(
        {
            "is_present": flag(status_is("Present")),
            "month": year_month("date"),
            "week": iso_week("date"),
            "year": F.year("date"),
        }
    )
