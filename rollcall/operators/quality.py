"""Data-quality checks. Every check is one row of a result table.

Checks that read single rows are counted together in one aggregation per table.
A ``TableAudit`` also takes keys and references: one scan of each table, one shuffle
for all. Outliers, spikes and rates add one plan each.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from rollcall.functions.scalar import is_true, parse_date, percent, percent_text, year_month
from rollcall.operators.relational import contains, orphans
from rollcall.operators.statistics import as_struct, iqr_outliers
from rollcall.session import written
from rollcall.schemas import CRITICAL_COLUMNS, PRIMARY_KEYS, REQUIRED_COLUMNS, SHIFTS, STATUSES

RESULT_COLUMNS = [
    "check_name", "table", "column", "passed", "severity", "expected", "actual", "row_count",
]


def result(
    name: str | Column,
    table: str,
    column: str,
    passed: Column,
    severity: str,
    expected: str,
    actual: Column,
    count: Column,
) -> Column:
    """One check result as a struct."""
    return F.struct(
        (F.lit(name) if isinstance(name, str) else name).alias("check_name"),
        F.lit(table).alias("table"),
        F.lit(column).alias("column"),
        passed.alias("passed"),
        F.lit(severity).alias("severity"),
        F.lit(expected).alias("expected"),
        actual.alias("actual"),
        count.cast("bigint").alias("row_count"),
    )


def _text(count: Column, noun: str) -> Column:
    return F.concat(count.cast("string"), F.lit(f" {noun}"))


def count_check(
    name: str, table: str, column: str, count: Column, severity: str, expected: str, noun: str
) -> Column:
    """A check that passes when its count is 0."""
    return result(name, table, column, count == 0, severity, expected, _text(count, noun), count)


def _unpack(one_row: DataFrame, results: list[Column]) -> DataFrame:
    return one_row.select(F.inline(F.array(*results)))


def union_results(parts: list[DataFrame]) -> DataFrame:
    """All results as one table."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# --- plan-time checks -----------------------------------------------------------------

def missing_columns(df: DataFrame, table: str, required: dict[str, list[str]] = REQUIRED_COLUMNS) -> list[str]:
    """Required columns the table does not have; decided from the schema alone."""
    return [c for c in required.get(table, []) if c not in df.columns]


def schema_gate(df: DataFrame, table: str) -> bool:
    return not missing_columns(df, table)


# --- checks counted in one scan ---------------------------------------------------------

def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Null count per column as rows (column, nulls, row_count), from one aggregation."""
    one = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"n_{c}") for c in columns],
    )
    return one.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column"),
                        F.col(f"n_{c}").alias("nulls"),
                        F.col("_rows").alias("row_count"),
                    )
                    for c in columns
                ]
            )
        )
    )


class ScanChecks:
    """Collects checks over one table and counts all of them in a single aggregation."""

    def __init__(self, df: DataFrame, table: str):
        self.df, self.table = df, table
        self._rows = f"_rows_{table}"
        self._conditions: dict[str, Column] = {}
        self._results: list[Column] = []

    def _count(self, cond: Column) -> Column:
        name = f"_c{len(self._conditions)}_{self.table}"
        self._conditions[name] = is_true(cond)
        return F.col(name)

    def complete(self, columns: list[str]) -> "ScanChecks":
        for c in columns:
            if c not in self.df.columns:
                self._results.append(
                    result(f"column_exists:{c}", self.table, c, F.lit(False), "critical",
                           "exists", F.lit("missing"), F.lit(0))
                )
                continue
            n = self._count(F.col(c).isNull())
            share = F.round(F.coalesce(percent(n, F.col(self._rows)), F.lit(0.0)), 2)
            actual = F.concat(share.cast("string"), F.lit("%"))
            self._results.append(
                result(f"no_nulls:{c}", self.table, c, n == 0, "critical", "0%", actual, n)
            )
        return self

    def allowed(self, name: str, column: str, values: list[str], severity: str = "critical",
                null_allowed: bool = False) -> "ScanChecks":
        """Values outside the list; null counts as outside unless allowed."""
        if column in self.df.columns:
            outside = ~F.coalesce(F.col(column).isin(values), F.lit(null_allowed))
            n = self._count(outside)
            self._results.append(
                count_check(name, self.table, column, n, severity, f"in {sorted(values)}", "invalid")
            )
        return self

    def within(self, name: str, column: str, low: float | None, high: float | None,
               severity: str, expected: str, noun: str = "violations") -> "ScanChecks":
        """Values outside [low, high]; null is not a violation."""
        if column in self.df.columns:
            bad = F.lit(False)
            if low is not None:
                bad = bad | is_true(F.col(column) < low)
            if high is not None:
                bad = bad | is_true(F.col(column) > high)
            n = self._count(bad)
            self._results.append(count_check(name, self.table, column, n, severity, expected, noun))
        return self

    def no_future(self, column: str, as_of: date) -> "ScanChecks":
        if column in self.df.columns:
            n = self._count(F.col(column).try_cast("date") > F.lit(as_of))
            self._results.append(
                count_check("no_future_dates", self.table, column, n, "warning", "≤ today", "future dates")
            )
        return self

    def email(self, column: str = "email") -> "ScanChecks":
        if column in self.df.columns:
            n = self._count(~contains(column, "@"))
            self._results.append(
                count_check("valid_email", self.table, column, n, "warning", "contains @", "invalid emails")
            )
        return self

    def results(self) -> DataFrame:
        counts = [F.count_if(cond).alias(name) for name, cond in self._conditions.items()]
        return _unpack(self.df.agg(F.count(F.lit(1)).alias(self._rows), *counts), self._results)


def check_completeness(df: DataFrame, table: str) -> DataFrame:
    return ScanChecks(df, table).complete(CRITICAL_COLUMNS[table]).results()


def _attendance_scan(att: DataFrame, as_of: date) -> ScanChecks:
    return (
        ScanChecks(att, "attendance")
        .complete(CRITICAL_COLUMNS["attendance"])
        .allowed("valid_status", "status", STATUSES)
        .within("hours_range", "hours_worked", 0, 14, "warning", "[0, 14]")
        .no_future("date", as_of)
    )


def _employee_scan(emp: DataFrame) -> ScanChecks:
    return (
        ScanChecks(emp, "employees")
        .complete(CRITICAL_COLUMNS["employees"])
        .within("positive_salary", "salary", 0, None, "critical", ">= 0", "negative salaries")
        .email()
    )


def domain_checks(att: DataFrame) -> DataFrame:
    """The value rules of the attendance table declaration. There a null passes."""
    return (
        ScanChecks(att, "attendance")
        .allowed("status_domain", "status", STATUSES, null_allowed=True)
        .allowed("shift_domain", "shift", SHIFTS, null_allowed=True)
        .within("hours_not_negative", "hours_worked", 0, None, "critical", ">= 0")
        .within("overtime_not_negative", "overtime_hours", 0, None, "critical", ">= 0")
        .results()
    )


# --- keys and references ---------------------------------------------------------------

def duplicate_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows beyond the first of their key; null keys equal each other."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))


def _text_of(df: DataFrame, column: str, like: str | None = None) -> Column:
    """A value as text: equal texts for equal values, also where the other side's type ``like`` differs."""
    kind, value = dict(df.dtypes)[column], F.col(column)
    fractions = ("double", "float", "decimal")
    if like is not None and like != kind:
        if kind.startswith(fractions) or like.startswith(fractions):
            value, kind = value.try_cast("double"), "double"
        elif "string" in (kind, like):
            # a text that is no number equals no number
            value = F.coalesce(value.try_cast("bigint").cast("string"), value.cast("string"))
    if kind in ("double", "float"):
        value = value + F.lit(0.0)  # -0.0 is 0.0
    elif kind == "timestamp":
        value = F.unix_micros(value)
    elif kind == "binary":
        value = F.hex(value)
    return value.cast("string")


def _key(df: DataFrame, columns: list[str]) -> Column:
    """One column's text, or the texts of several, each after its length; in these a null is a value of its own."""
    if len(columns) == 1:
        return _text_of(df, columns[0])
    parts = [_text_of(df, c) for c in columns]
    return F.concat_ws("|", *[F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts])


class TableAudit:
    """Row, key and reference checks of several tables from one scan of each and one shuffle.

    A row gives one entry (rule, key, own) for every rule that it takes part in:
    without a key for a rule on single rows that it breaks, with its key for a
    unique key or a reference, and with ``own`` false where another table refers
    to it. Entries are counted per (rule, key) before they move, so the entries of
    a frequent or empty key are one row a task. From the counts per key follow
    duplicates (rows beyond the first) and orphans (rows of keys without a row that
    is referred to). Results come in the order of the calls; a table without rows
    has counts of 0. Nothing runs until the results are read.
    """

    def __init__(self, **tables: DataFrame):
        self.tables = tables
        self._entries: dict[str, list[Column]] = {t: [] for t in tables}
        self._figures: list[tuple[str, str]] = []  # per rule: name and which figure of its counts it is
        self._results: list[Column] = []

    def _rule(self, figure: str, name: str | None = None) -> int:
        self._figures.append((name or f"_k{len(self._figures)}", figure))
        return len(self._figures) - 1

    def _entry(self, table: str, rule: int, key: Column | None = None, when: Column | None = None, own: bool = True) -> None:
        entry = F.struct(
            F.lit(rule).alias("rule"), (F.lit(None).cast("string") if key is None else key).alias("key"), F.lit(own).alias("own"))
        self._entries[table].append(entry if when is None else F.when(when, entry))

    def scan(self, checks: ScanChecks) -> "TableAudit":
        """The checks of single rows of one table."""
        self._entry(checks.table, self._rule("n", checks._rows))
        for name, cond in checks._conditions.items():
            self._entry(checks.table, self._rule("n", name), when=cond)
        self._results += checks._results
        return self

    def unique(self, table: str, keys: list[str] | None = None, null_allowed: bool = False) -> "TableAudit":
        """No key twice; null keys equal each other unless they are allowed."""
        keys = keys or PRIMARY_KEYS[table]
        joined, rule = "+".join(keys), self._rule("repeated")
        key = _key(self.tables[table], keys)
        filled = None
        if null_allowed:
            filled = F.lit(True)
            for c in keys:
                filled = filled & F.col(c).isNotNull()
        self._entry(table, rule, key, filled)
        self._results.append(count_check(
            f"unique_pk:{joined}", table, joined, F.col(self._figures[rule][0]), "critical", "0 duplicates", "duplicates"))
        return self

    def refers(self, table: str, column: str, to: str, to_column: str, name: str | None = None,
               null_allowed: bool = False) -> "TableAudit":
        """Every key of ``column`` is in the other table's column; a null is an orphan unless it is allowed."""
        rule, df, ref = self._rule("unknown"), self.tables[table], self.tables[to]
        kind, ref_kind = dict(df.dtypes)[column], dict(ref.dtypes)[to_column]
        self._entry(table, rule, _text_of(df, column, ref_kind), F.col(column).isNotNull() if null_allowed else None)
        self._entry(to, rule, _text_of(ref, to_column, kind), F.col(to_column).isNotNull(), own=False)
        self._results.append(count_check(
            name or f"fk_{table}→{to}", table, column, F.col(self._figures[rule][0]), "critical", "all valid", "orphan records"))
        return self

    def results(self) -> DataFrame:
        entries = union_results([
            self.tables[t].select(F.inline(F.filter(F.array(*e), lambda x: x.isNotNull()))) for t, e in self._entries.items() if e])
        per_key = entries.groupBy("rule", "key").agg(F.count_if("own").alias("n"), F.bool_or(~F.col("own")).alias("known"))
        per_rule = per_key.groupBy("rule").agg(
            F.sum("n").alias("n"),
            F.sum(F.greatest(F.col("n") - 1, F.lit(0))).alias("repeated"),
            F.sum(F.when(F.col("known"), 0).otherwise(F.col("n"))).alias("unknown"),
        )
        one = per_rule.agg(*[
            F.coalesce(F.max(F.when(F.col("rule") == i, F.col(figure))), F.lit(0)).alias(name)
            for i, (name, figure) in enumerate(self._figures)])
        return _unpack(one, self._results)


def check_uniqueness(df: DataFrame, table: str, keys: list[str] | None = None) -> DataFrame:
    return TableAudit(**{table: df}).unique(table, keys).results()


def orphan_count(
    df: DataFrame, column: str, ref: DataFrame, ref_column: str, null_allowed: bool = False
) -> DataFrame:
    """Rows whose key is not in the reference table, counted per key before the join."""
    keyed = df.filter(F.col(column).isNotNull()) if null_allowed else df
    per_key = keyed.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    return orphans(per_key, column, ref, ref_column).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("orphans")
    )


def check_reference(
    df: DataFrame, table: str, column: str, ref: DataFrame, ref_table: str, ref_column: str,
    null_allowed: bool = False,
) -> DataFrame:
    audit = TableAudit(**{table: df, ref_table: ref})
    return audit.refers(table, column, ref_table, ref_column, null_allowed=null_allowed).results()


def declared_constraints(
    dept: DataFrame, emp: DataFrame, att: DataFrame, leaves: DataFrame
) -> DataFrame:
    """NOT NULL, UNIQUE and FOREIGN KEY rules of the table declarations (a null reference is allowed)."""
    audit = TableAudit(departments=dept, employees=emp, attendance=att, leaves=leaves)
    for table, columns in (("departments", ["department_name"]), ("employees", ["name"]),
                           ("attendance", ["employee_id", "date"]), ("leaves", ["employee_id"])):
        audit.scan(ScanChecks(audit.tables[table], table).complete(columns))
    for table, column in (("departments", "department_name"), ("employees", "employee_id"), ("employees", "email"),
                          ("attendance", "attendance_id")):
        audit.unique(table, [column], null_allowed=True)
    audit.unique("attendance").unique("leaves", ["leave_id"], null_allowed=True)
    for table, column, to, key in (
        ("employees", "department", "departments", "department_name"), ("employees", "manager_id", "employees", "employee_id"),
        ("attendance", "employee_id", "employees", "employee_id"), ("leaves", "employee_id", "employees", "employee_id"),
    ):
        audit.refers(table, column, to, key, f"fk_{table}→{to}:{column}", null_allowed=True)
    return audit.results()


# --- anomalies -------------------------------------------------------------------------

def check_outliers(att: DataFrame, factor: float = 3.0) -> DataFrame:
    """Hours outside the quartiles by more than three IQR; fewer than 1% of all rows pass."""
    counted = iqr_outliers(att, "hours_worked", factor).select(
        F.col("outliers").alias("_out"), F.col("rows").alias("_rows")
    )
    share = F.format_string("%.2f%%", F.coalesce(percent(F.col("_out"), F.col("_rows")), F.lit(0.0)))
    actual = F.concat(F.col("_out").cast("string"), F.lit(" outliers ("), share, F.lit(")"))
    passed = F.col("_out") < F.col("_rows") * F.lit(0.01)
    return _unpack(
        counted,
        [result("hours_outliers", "attendance", "hours_worked", passed, "warning",
                "<1% outliers", actual, F.col("_out"))],
    )


def daily_counts(att: DataFrame) -> DataFrame:
    """Per date as it is stored: rows, rows with an employee, present rows.

    All figures over time are worked out from this one row per day.
    """
    return (
        att.filter(F.col("date").isNotNull())
        .groupBy("date")
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            F.count("employee_id").alias("_n"),
            F.count_if(is_true(F.col("status") == "Present")).alias("_present"),
        )
    )


def check_spikes(daily: DataFrame) -> DataFrame:
    """Days with more records than the mean plus three sample deviations, from ``daily_counts``."""
    stats = as_struct(daily.agg(F.avg("_n").alias("mean"), F.stddev_samp("_n").alias("std")))
    spikes = daily.agg(F.count_if(F.col("_n") > stats["mean"] + 3 * stats["std"]).alias("_spikes"))
    return _unpack(
        spikes,
        [count_check("daily_count_spikes", "attendance", "date", F.col("_spikes"), "info",
                     "< mean+3σ", "spike days")],
    )


def check_rate_drop(daily: DataFrame, drop: float = 0.15) -> DataFrame:
    """Months whose present rate fell by more than 15 points; no row with fewer than two months.

    From ``daily_counts``; the window sees one row per calendar month.
    """
    monthly = (
        daily.select(parse_date("date").alias("date"), "_rows", "_present")
        .filter(F.col("date").isNotNull())
        .groupBy(year_month("date").alias("month"))
        .agg((F.sum("_present") / F.sum("_rows")).alias("rate"))
    )
    change = F.col("rate") - F.lag("rate").over(Window.orderBy("month"))
    changes = monthly.withColumn("change", change).agg(
        F.count(F.lit(1)).alias("_months"), F.count_if(F.col("change") < -drop).alias("_drops")
    )
    return _unpack(
        changes.filter(F.col("_months") >= 2),
        [count_check("attendance_rate_drop", "attendance", "status", F.col("_drops"), "warning",
                     "MoM drop < 15%", "months with >15% drop")],
    )


def run_all(att: DataFrame, emp: DataFrame, as_of: date) -> DataFrame:
    """All checks of both tables: ten on attendance, seven on employees and the reference between."""
    daily = written(daily_counts(att), "daily")
    audit = (
        TableAudit(attendance=att, employees=emp)
        .scan(_attendance_scan(att, as_of))
        .unique("attendance")
        .scan(_employee_scan(emp))
        .unique("employees")
        .refers("attendance", "employee_id", "employees", "employee_id")
    )
    return union_results([audit.results(), check_outliers(att), check_spikes(daily), check_rate_drop(daily)])


# --- generic validator -----------------------------------------------------------------

def _outcome(check: str, count: Column, detail: Column) -> Column:
    return F.struct(
        F.lit(check).alias("check"),
        (count == 0).alias("passed"),
        F.when(count == 0, F.lit("✓")).otherwise(detail).alias("detail"),
    )


class Validator:
    """Rule-based checks on any table, collected as (check, passed, detail) rows.

    Each ``check_*`` call adds a lazy result and returns the validator; nothing
    runs until ``report`` or ``summary`` is evaluated.
    """

    def __init__(self) -> None:
        self._parts: list[DataFrame] = []

    def check_nulls(self, df: DataFrame, columns: list[str]) -> "Validator":
        one = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n_{c}") for c in columns])
        self._parts.append(_unpack(one, [
            _outcome(f"null_check:{c}", F.col(f"n_{c}"), _text(F.col(f"n_{c}"), "nulls found"))
            for c in columns
        ]))
        return self

    def check_range(self, df: DataFrame, column: str, low: float, high: float) -> "Validator":
        bad = F.count_if(is_true((F.col(column) < low) | (F.col(column) > high)))
        self._parts.append(_unpack(df.agg(bad.alias("n")), [
            _outcome(f"range_check:{column}[{low},{high}]", F.col("n"), _text(F.col("n"), "violations"))
        ]))
        return self

    def check_allowed_values(
        self, df: DataFrame, column: str, allowed: list[str], order: str | None = None
    ) -> "Validator":
        """Values outside the list, with up to five of them as examples.

        Examples are the first met in ``order``, or the smallest. Invalid values
        are counted per value, and only five of those rows are gathered.
        """
        invalid = df.filter(~F.coalesce(F.col(column).isin(allowed), F.lit(False)))
        first = F.min(order) if order else F.min(column)
        per_value = invalid.groupBy(column).agg(F.count(F.lit(1)).alias("n"), first.alias("first"))
        examples = per_value.orderBy(F.col("first").asc_nulls_last(), F.col(column)).limit(5)
        named = F.coalesce(F.col(column).cast("string"), F.lit("null"))
        listed = examples.agg(
            F.transform(F.array_sort(F.collect_list(F.struct(
                F.col("first").isNull().alias("last"), "first", named.alias("v")))), lambda s: s["v"])
        ).scalar()
        one = per_value.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).withColumn("examples", listed)
        detail = F.concat(
            F.col("n").cast("string"), F.lit(" invalid values: ["), F.array_join("examples", ", "), F.lit("]")
        )
        self._parts.append(_unpack(one, [_outcome(f"category_check:{column}", F.col("n"), detail)]))
        return self

    def check_reference(self, df: DataFrame, column: str, ref: DataFrame, ref_column: str) -> "Validator":
        one = orphan_count(df, column, ref, ref_column)
        self._parts.append(_unpack(one, [
            _outcome(f"fk_check:{column}→{ref_column}", F.col("orphans"),
                     _text(F.col("orphans"), "orphan records"))
        ]))
        return self

    def report(self) -> DataFrame:
        if not self._parts:
            raise ValueError("no check has been added")
        return union_results(self._parts)

    def summary(self) -> DataFrame:
        return summarize(self.report())

    def passed(self) -> bool:
        """Whether every check so far passed, as a plain bool (runs the checks)."""
        return bool(self.report().agg(F.bool_and("passed")).first()[0])


def summarize(results: DataFrame) -> DataFrame:
    """Total, passed, failed and pass rate of a result table."""
    counts = results.agg(
        F.count(F.lit(1)).alias("total_checks"), F.count_if(F.col("passed")).alias("passed")
    )
    return counts.withColumn("failed", F.col("total_checks") - F.col("passed")).withColumn(
        "pass_rate", percent_text(F.col("passed"), F.col("total_checks"))
    )


def split_failures(results: DataFrame) -> DataFrame:
    """Headline counts: total, passed, whole percent, critical failures, warnings."""
    failed = ~F.col("passed")
    return results.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("passed")).alias("passed"),
        F.count_if(failed & (F.col("severity") == "critical")).alias("critical_failures"),
        F.count_if(failed & (F.col("severity") == "warning")).alias("warnings"),
    ).withColumn("passed_pct", F.floor(percent(F.col("passed"), F.col("total"))).cast("bigint"))


def report_document(results: DataFrame, generated_at: datetime) -> DataFrame:
    """The report as one nested row: generated_at, summary, results.

    The list holds one entry per check, so its length is set by the code and not by the data.
    """
    stamped = results.withColumn("timestamp", F.lit(generated_at.isoformat()))
    summary = F.struct(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("passed")).alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
    )
    return stamped.agg(
        F.lit(generated_at.isoformat()).alias("generated_at"),
        summary.alias("summary"),
        F.collect_list(F.struct(*stamped.columns)).alias("results"),
    )


# --- gate and profile ------------------------------------------------------------------

FAIL_ABOVE, PROCEED_BELOW = 0.30, 0.10  # Fixed values: null-rate limits of the gate.


def null_rate_gate(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Share of empty cells and what it means: fail, proceed or alert. One aggregation."""
    columns = columns or df.columns
    nulls = F.lit(0)
    for c in columns:
        nulls = nulls + F.count_if(F.col(c).isNull())
    one = df.agg(F.count(F.lit(1)).alias("row_count"), nulls.alias("null_cells"))
    rate = F.try_divide(F.col("null_cells").cast("double"), F.col("row_count") * F.lit(len(columns)))
    decision = (
        F.when(F.col("row_count") == 0, F.lit("fail"))
        .when(F.col("null_rate") > FAIL_ABOVE, F.lit("fail"))
        .when(F.col("null_rate") < PROCEED_BELOW, F.lit("proceed"))
        .otherwise(F.lit("alert"))
    )
    return one.withColumn("null_rate", rate).withColumn("decision", decision)


def profile(df: DataFrame) -> DataFrame:
    """Per column: type, nulls and the row count."""
    types = dict(df.dtypes)
    kind = F.lit(None).cast("string")
    for c, t in types.items():
        kind = F.when(F.col("column") == c, F.lit(t)).otherwise(kind)
    return null_counts(df, df.columns).withColumn("type", kind)


def table_shape(df: DataFrame) -> DataFrame:
    """Rows, columns and missing cells of a table."""
    nulls = F.lit(0)
    for c in df.columns:
        nulls = nulls + F.count_if(F.col(c).isNull())
    return df.agg(F.count(F.lit(1)).alias("rows"), nulls.alias("missing")).withColumn(
        "columns", F.lit(len(df.columns))
    )
