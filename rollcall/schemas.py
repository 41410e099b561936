"""Explicit schemas of the input tables, category domains and required columns."""

from __future__ import annotations

from pyspark.sql import types as T


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_LONG, _TEXT, _DOUBLE, _FLAG = T.LongType(), T.StringType(), T.DoubleType(), T.BooleanType()

DEPARTMENTS = _table(department_id=_LONG, department_name=_TEXT, head=_TEXT, budget=_DOUBLE)

EMPLOYEES = _table(
    employee_id=_TEXT, name=_TEXT, email=_TEXT, department=_TEXT, designation=_TEXT, location=_TEXT,
    manager_id=_TEXT, join_date=_TEXT, salary=_DOUBLE, is_active=_FLAG,
)

# dates stay text on input: cleaning decides what happens to the ones that do not parse
ATTENDANCE = _table(
    attendance_id=_LONG, employee_id=_TEXT, date=_TEXT, day_of_week=_TEXT, shift=_TEXT, status=_TEXT,
    check_in=_TEXT, check_out=_TEXT, hours_worked=_DOUBLE, overtime_hours=_DOUBLE, department=_TEXT,
    location=_TEXT, notes=_TEXT,
)

LEAVES = _table(
    leave_id=_LONG, employee_id=_TEXT, leave_type=_TEXT, start_date=_TEXT, end_date=_TEXT,
    approved=_FLAG, approved_by=_TEXT,
)

EVENT = _table(
    event_id=_TEXT, employee_id=_TEXT, event_type=_TEXT, timestamp=_TEXT, department=_TEXT,
    location=_TEXT, device_id=_TEXT, source=_TEXT, latitude=_DOUBLE, longitude=_DOUBLE,
)

TABLES: dict[str, T.StructType] = {
    "departments": DEPARTMENTS,
    "employees": EMPLOYEES,
    "attendance": ATTENDANCE,
    "attendance_dirty": ATTENDANCE,
    "leaves": LEAVES,
}

# Category domains.
SHIFTS = ["Morning", "Afternoon", "Night"]
STATUSES = ["Present", "Absent", "Late", "Half-Day", "Work-From-Home", "On-Leave", "Unknown"]
WORKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday"]

# Hours assumed for a status when the record has none.
DEFAULT_HOURS = {
    "Present": 8.0,
    "Late": 7.0,
    "Half-Day": 4.0,
    "Work-From-Home": 8.0,
    "Absent": 0.0,
    "On-Leave": 0.0,
    "Unknown": 0.0,
}

# Columns a file must have before it is ingested.
REQUIRED_COLUMNS = {
    "attendance": ["employee_id", "date", "status", "hours_worked"],
    "employees": ["employee_id", "name", "department"],
    "departments": ["department_name"],
    "leaves": ["employee_id", "leave_type", "start_date"],
}

# Columns of a table that may not be null, and its key.
CRITICAL_COLUMNS = {
    "attendance": ["employee_id", "date", "status"],
    "employees": ["employee_id", "name", "department"],
}
PRIMARY_KEYS = {
    "attendance": ["employee_id", "date"],
    "employees": ["employee_id"],
}
