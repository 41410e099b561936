import sys
from datetime import date, timedelta
from pathlib import Path

import pytest
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from rollcall.session import build_session  # noqa: E402

ATTENDANCE = (
    "attendance_id bigint, employee_id string, date date, day_of_week string, shift string, status string, "
    "hours_worked double, overtime_hours double, department string, location string, notes string"
)


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": "/tmp/rollcall-test-warehouse",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def attendance(spark: SparkSession) -> DataFrame:
    """Twelve days, each of another employee; the fourth has no status and no hours."""
    days = [  # status, hours, overtime
        ("Late", 7.25, 0.0), ("Present", 8.75, 0.5), ("Present", 8.25, 0.25), (None, None, 0.0),
        ("On-Leave", 0.0, 0.0), ("Present", 10.0, 1.25), ("Half-Day", 3.5, 0.0), ("Work-From-Home", 7.75, 0.0),
        ("Present", 8.5, 0.0), ("Present", 8.0, 0.0), ("Absent", 0.0, 0.0), ("Present", 9.5, 1.0),
    ]
    rows = [
        (n, f"EMP{n:04d}", date(2023, 12, 31) + timedelta(days=n), "Monday", "Morning", *day, "Research", "Aarau", None)
        for n, day in enumerate(days, 1)
    ]
    return spark.createDataFrame(rows, ATTENDANCE)


@pytest.fixture
def employees(spark: SparkSession) -> DataFrame:
    people = [("Tessa", "Trade", 48250.0), ("Okko", "People", 91000.0), ("Maren", "Research", 52400.0),
              ("Runa", "Accounts", 39900.0), ("Ivo", "Research", 77100.0), ("Sanne", "Trade", 61800.0)]
    rows = [
        (f"EMP{n:04d}", name, f"{name.lower()}@firm.example", department, "Clerk", pay, True, "2021-09-13", "Aarau")
        for n, (name, department, pay) in enumerate(people, 1)
    ]
    return spark.createDataFrame(
        rows,
        "employee_id string, name string, email string, department string, designation string, salary double, "
        "is_active boolean, join_date string, location string",
    )


def rows_of(df: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
