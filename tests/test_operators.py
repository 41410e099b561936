"""Operators on small tables with known results."""

import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from rollcall.functions import scalar as S
from rollcall.functions.signing import hmac_sha256, sign_rows, verify_rows
from rollcall.operators import aggregates as A
from rollcall.operators import cleaning as C
from rollcall.operators import quality as Q
from rollcall.operators import relational as R
from rollcall.operators import statistics as N
from rollcall.operators import warehouse as M
from rollcall.operators import windows as W


def numbers(spark, values, name="x"):
    return spark.createDataFrame([(v,) for v in values], f"{name} double")


def normed(spark, values, method):
    out = N.normalize_columns(numbers(spark, values), ["x"], method).orderBy("x")
    return [r["x_norm"] for r in out.collect()]


class TestNormalize:
    def test_min_max(self, spark):
        assert normed(spark, [0.0, 5.0, 10.0], "min_max") == [0.0, 0.5, 1.0]

    def test_constant_becomes_zero_in_empty_rows_too(self, spark):
        assert normed(spark, [5.0, 5.0, None], "min_max") == [0.0, 0.0, 0.0]
        assert normed(spark, [5.0, 5.0, 5.0], "z_score") == [0.0, 0.0, 0.0]
        assert normed(spark, [5.0, 5.0, 5.0], "robust_scale") == [0.0, 0.0, 0.0]

    def test_z_score(self, spark):
        z = normed(spark, [1.0, 2.0, 3.0, 4.0, 5.0], "z_score")
        assert sum(z) == pytest.approx(0, abs=1e-10)
        assert math.sqrt(sum(v * v for v in z) / 4) == pytest.approx(1, abs=1e-10)

    def test_z_score_of_one_row_is_unknown(self, spark):
        assert normed(spark, [3.0], "z_score") == [None]

    def test_robust(self, spark):
        assert normed(spark, [1.0, 2.0, 3.0, 4.0, 5.0], "robust_scale") == [-1.0, -0.5, 0.0, 0.5, 1.0]

    def test_log(self, spark):
        values = normed(spark, [-3.0, 0.0, 1.0, 8.0, 100.0], "log_transform")
        assert values == [pytest.approx(math.log1p(max(v, 0))) for v in (-3, 0, 1, 8, 100)]

    def test_absent_columns_are_skipped(self, spark):
        df = spark.createDataFrame([(0, 0.0), (4, 0.5), (8, 1.0), (12, 2.0)], "hours int, overtime double")
        out = N.normalize_columns(df, ["hours", "overtime", "bonus"])
        assert out.columns == ["hours", "overtime", "hours_norm", "overtime_norm"]
        assert rows_of(out.select("hours_norm"))[-1] == (1.0,)


class TestSummaries:
    def test_daily(self, attendance):
        first = A.daily_summary(attendance).orderBy("date").first()
        assert (first.total_employees, first.present_count, first.absent_count, first.avg_hours) == (1, 0, 0, 7.25)

    def test_department(self, attendance):
        row = A.department_summary(attendance).collect()
        assert len(row) == 1
        assert row[0].asDict() == {
            "department": "Research", "headcount": 12, "avg_attendance_pct": 50.0,
            "total_hours": 71.5, "avg_overtime": pytest.approx(0.25),
        }

    def test_rolling(self, attendance):
        out = W.rolling_mean(attendance, "hours_worked", 3).orderBy("date").collect()
        got = [r["hours_worked_rolling_3d"] for r in out]
        assert got[:4] == pytest.approx([7.25, 8.0, 24.25 / 3, 8.5])  # the empty fourth value is left out of the mean

    def test_status_counts(self, attendance):
        counts = {r["status"]: r["total_records"] for r in A.status_distribution(attendance).collect()}
        assert counts[None] == 1 and counts["Present"] == 6
        assert None not in {r["status"] for r in A.value_counts(attendance, "status").collect()}

    def test_null_groups(self, spark):
        df = spark.createDataFrame(
            [("People", "Present", None, None), (None, "Present", 8.0, 1.0)],
            "department string, status string, hours_worked double, overtime_hours double",
        ).withColumn("employee_id", F.lit("E1"))
        assert A.department_summary(df).count() == 1
        assert A.department_attendance(df).count() == 2
        assert A.department_summary(df).first().total_hours == 0.0
        assert A.department_attendance(df).filter("department = 'People'").first().total_overtime is None

    def test_hours_per_row_counts_empty_hours(self, attendance):
        row = A.hours_per_row_by_department(attendance).first()
        assert (row.avg_hours, row.total_rows) == (pytest.approx(71.5 / 12, abs=0.01), 12)

    def test_weekdays_keep_order_and_empty_days(self, attendance):
        out = A.weekday_rates(attendance).collect()
        assert [r.day_of_week for r in out] == ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday"]
        assert [r.attendance_pct for r in out] == [50.0, None, None, None, None]

    def test_empty_request_log(self, spark):
        log = spark.createDataFrame([], "status_code int, latency_ms double")
        assert A.request_report(log).count() == 0

    def test_kpis_use_unfiltered_headcount(self, attendance):
        row = A.kpis(attendance, attendance.filter("status = 'Present'")).first()
        assert (row.total_employees, row.attendance_rate, row.vs_target, row.total_overtime) == (12, 100.0, 15.0, 3)


class TestValidator:
    def test_nulls(self, attendance):
        assert Q.Validator().check_nulls(attendance, ["employee_id"]).passed() is True
        assert Q.Validator().check_nulls(attendance, ["status"]).passed() is False

    def test_range(self, spark, attendance):
        assert Q.Validator().check_range(attendance, "hours_worked", 0, 14).passed() is True
        bad = Q.Validator().check_range(numbers(spark, [8.0, 20.0, -1.0]), "x", 0, 14)
        assert bad.passed() is False
        assert bad.report().first().detail == "2 violations"

    def test_allowed_values(self, spark, attendance):
        known = ["Present", "Absent", "Late", "Half-Day", "Work-From-Home", "On-Leave"]
        assert Q.Validator().check_allowed_values(attendance.dropna(subset=["status"]), "status", known).passed() is True
        letters = spark.createDataFrame([(i, c) for i, c in enumerate("ghabcdefa")], "id int, c string")
        report = Q.Validator().check_allowed_values(letters, "c", ["a"], order="id").report().first()
        assert report.detail == "7 invalid values: [g, h, b, c, d]"
        assert Q.Validator().check_allowed_values(attendance, "status", known).report().first().detail == "1 invalid values: [null]"

    def test_reference(self, spark, attendance, employees):
        v = Q.Validator().check_reference(attendance, "employee_id", employees, "employee_id")
        assert v.report().first().detail == "6 orphan records"

    def test_report_and_summary(self, attendance):
        v = Q.Validator().check_nulls(attendance, ["employee_id", "date"])
        v.check_range(attendance.fillna(0.0), "hours_worked", 0, 14)
        assert v.report().columns == ["check", "passed", "detail"]
        assert v.summary().first().asDict() == {"total_checks": 3, "passed": 3, "failed": 0, "pass_rate": "100.0%"}
        assert Q.summarize(v.report().filter("false")).first().pass_rate == "N/A"


class TestQuality:
    def test_run_all(self, attendance, employees):
        results = Q.run_all(attendance, employees, date(2024, 1, 5)).collect()
        assert len(results) == 16  # one month only, so no comparison of months
        by_name = {(r.table, r.check_name): r for r in results}
        assert by_name["attendance", "no_nulls:status"].actual == "8.33%"
        assert by_name["attendance", "valid_status"].row_count == 1
        assert by_name["attendance", "no_future_dates"].row_count == 7
        assert by_name["attendance", "fk_attendance→employees"].actual == "6 orphan records"
        assert by_name["employees", "valid_email"].passed

    def test_missing_column(self, attendance):
        row = Q.ScanChecks(attendance, "attendance").complete(["badge"]).results().first()
        assert (row.check_name, row.passed, row.actual) == ("column_exists:badge", False, "missing")

    def test_null_keys_are_duplicates_of_each_other(self, spark):
        df = spark.createDataFrame([(None,), (None,), ("a",)], "k string")
        assert Q.duplicate_count(df, ["k"]).first().duplicates == 1

    def test_null_reference_is_an_orphan_unless_allowed(self, spark, employees):
        df = spark.createDataFrame([(None,), ("EMP0001",), ("X",), ("X",)], "employee_id string")
        assert Q.orphan_count(df, "employee_id", employees, "employee_id").first().orphans == 3
        assert Q.orphan_count(df, "employee_id", employees, "employee_id", True).first().orphans == 2

    def test_audit_of_several_tables(self, spark):
        part = spark.createDataFrame(
            [(1, "a", 1.0, 7), (1, "a", 1.0, 7), (None, "a", 2.0, 8), (None, "a", 2.0, None), (3, None, -0.0, 9), (4, "1|2", None, 5)],
            "k int, c string, x double, to long")
        whole = spark.createDataFrame([("7",), ("8",), ("8",), (None,), ("nine",)], "id string")
        zeros = spark.createDataFrame([(0,), (1,), (2,)], "z int")
        audit = (
            Q.TableAudit(part=part, whole=whole, zeros=zeros, none=part.limit(0))
            .scan(Q.ScanChecks(part, "part").complete(["k", "c", "badge"]).within("low", "x", 1, None, "info", ">= 1"))
            .unique("part", ["k"]).unique("part", ["k"], null_allowed=True).unique("part", ["k", "c"])
            .refers("part", "to", "whole", "id").refers("part", "to", "whole", "id", "allowed", null_allowed=True)
            .refers("part", "x", "zeros", "z").refers("whole", "id", "part", "to")
            .unique("none", ["k"]).scan(Q.ScanChecks(part.limit(0), "none").complete(["c"])).refers("none", "k", "zeros", "z")
        )
        rows = audit.results().collect()
        assert [(r.check_name, r.row_count) for r in rows] == [
            ("no_nulls:k", 2), ("no_nulls:c", 1), ("column_exists:badge", 0), ("low", 1), ("unique_pk:k", 2), ("unique_pk:k", 1),
            ("unique_pk:k+c", 2), ("fk_part→whole", 3), ("allowed", 2), ("fk_part→zeros", 1), ("fk_whole→part", 2),
            ("unique_pk:k", 0), ("no_nulls:c", 0), ("fk_none→zeros", 0)]
        assert rows[0].actual == "33.33%" and rows[12].actual == "0.0%"

    def test_audit_reads_a_table_once_and_counts_hot_keys_before_they_move(self, spark, tmp_path):
        spark.range(4000).selectExpr("if(id < 3000, 0, id) AS k", "id AS n").write.parquet(f"{tmp_path}/t")
        df = spark.read.parquet(f"{tmp_path}/t")
        audit = Q.TableAudit(t=df).unique("t", ["n"]).unique("t", ["k"]).refers("t", "k", "t", "n")
        audit = audit.scan(Q.ScanChecks(df, "t").complete(["k"])).results()
        plan = audit._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") == 1
        assert [r.row_count for r in audit.collect()] == [0, 2999, 0, 0]

    def test_gate(self, spark):
        def decide(nulls):
            rows = [(None if i < nulls else "x",) for i in range(20)]
            return Q.null_rate_gate(spark.createDataFrame(rows, "a string")).first().decision

        assert [decide(n) for n in (1, 2, 6, 7)] == ["proceed", "alert", "alert", "fail"]

    def test_report_document(self, attendance, employees):
        row = Q.report_document(Q.run_all(attendance, employees, date(2024, 2, 1)), datetime(2024, 2, 1)).first()
        assert row.summary.total == len(row.results) == row.summary.passed + row.summary.failed
        assert row.results[0].timestamp == row.generated_at == "2024-02-01T00:00:00"

    def test_schema_gate(self, employees):
        assert Q.schema_gate(employees, "employees")
        assert Q.missing_columns(employees.drop("name"), "employees") == ["name"]


class TestCleaning:
    def test_fills(self, attendance):
        row = C.clean_attendance(attendance).filter("attendance_id = 4").first()
        assert (row.status, row.hours_worked) == ("Unknown", 0.0)

    def test_caps_and_order_of_steps(self, spark):
        df = spark.createDataFrame(
            [
                (1, "E1", "2024-01-01", "Present", 20.0, 5.0), (2, "E2", "2024-01-02", "Present", -1.0, -2.0),
                (3, "E1", "2024-01-01", "Absent", 1.0, 0.0), (4, "E3", "bad", "Present", 1.0, 0.0),
                (5, "E4", "2024-01-03", "Late", None, None), (6, "E5", "2024-01-03", "Odd", None, 0.0),
                (7, None, "2024-01-04", "Present", 1.0, 0.0), (8, None, "2024-01-04", "Present", 2.0, 0.0),
            ],
            "attendance_id bigint, employee_id string, date string, status string, hours_worked double, overtime_hours double",
        )
        got = [(r.attendance_id, r.hours_worked, r.overtime_hours) for r in C.clean_attendance(df).orderBy("attendance_id").collect()]
        assert got == [(1, 14.0, 4.0), (2, 0.0, -2.0), (5, 7.0, None), (6, None, 0.0), (7, 1.0, 0.0)]

    def test_employees(self, employees):
        twice = employees.unionByName(employees.limit(2)).withColumn("email", F.concat(F.lit(" "), F.upper("email")))
        out = C.clean_employees(twice)
        assert out.count() == 6
        assert {r.email for r in out.collect()} == {f"{n}@firm.example" for n in ("tessa", "okko", "maren", "runa", "ivo", "sanne")}

    def test_etl_keeps_missing_overtime_and_elt_fills_it(self, spark):
        df = spark.createDataFrame(
            [(1, "E1", "2024-01-06", None, None, None)],
            "attendance_id bigint, employee_id string, date string, status string, hours_worked double, overtime_hours double",
        )
        for c in ("day_of_week", "shift", "check_in", "check_out", "department", "location"):
            df = df.withColumn(c, F.lit(None).cast("string"))
        etl, elt = C.etl_clean(df).first(), C.elt_clean(df).first()
        assert (etl.overtime_hours, elt.overtime_hours) == (None, 0.0)
        assert (etl.status, etl.year_month, etl.is_weekend, etl.productivity_score) == ("Unknown", "2024-01", True, 0.0)

    def test_merge_prefers_the_dirty_table(self, attendance, employees, spark):
        dept = spark.createDataFrame([("Research", "Zed")], "department_name string, head string")
        frames = {"attendance": attendance.limit(1), "attendance_dirty": attendance, "employees": employees, "departments": dept}
        out = C.merge_datasets(frames)
        assert out.count() == 12
        first = out.filter("attendance_id = 1").first()
        assert (first.name, first.head, first.month, first.week, first.is_weekend) == ("Tessa", "Zed", 1, 1, False)
        with pytest.raises(ValueError):
            C.merge_datasets({"attendance": attendance})

    def test_clean_normalize_summarize(self, attendance):
        scaled = N.normalize_columns(C.clean_attendance(attendance), ["hours_worked"])
        assert "hours_worked_norm" in scaled.columns
        assert A.department_summary(scaled).first().total_hours == 71.5


class TestScalars:
    def one(self, spark, expr):
        return spark.range(1).select(expr.alias("v")).first().v

    def test_clip_keeps_null(self, spark):
        assert self.one(spark, S.clip(F.lit(None).cast("double"), 0, 14)) is None

    def test_bad_text(self, spark):
        assert self.one(spark, S.parse_date(F.lit("2024-02-30"))) is None
        assert self.one(spark, S.parse_number(F.lit("x"))) == 0.0
        assert self.one(spark, S.parse_timestamp(F.lit("never"))) is None

    def test_rounding(self, spark):
        half = F.lit(2.5)
        assert self.one(spark, S.round_to(half, 0)) == 3.0
        assert self.one(spark, S.round_to(half, 0, half_even=True)) == 2.0

    def test_bins(self, spark):
        pay = [-1.0, 0.0, 1.0, 40000.0, 40000.5, 80000.0, 150000.0, 1e9, None]
        out = numbers(spark, pay).select(S.salary_band("x")).collect()
        assert [r[0] for r in out] == [None, None, "Junior", "Junior", "Mid", "Mid", "Senior", "Executive", None]

    def test_percent_of_nothing(self, spark):
        assert self.one(spark, S.percent(F.lit(1), F.lit(0))) is None

    def test_signature_matches_the_standard_library(self, spark):
        import hashlib
        import hmac

        for key in ("k", "signing-key", "x" * 100):
            want = hmac.new(key.encode(), b"payload", hashlib.sha256).hexdigest()
            assert self.one(spark, hmac_sha256(F.lit("payload"), key)) == want

    def test_verification_notices_a_change(self, spark):
        signed = sign_rows(spark.range(2), "key")
        changed = signed.withColumn("payload", F.when(F.col("id") == 1, F.lit("{}")).otherwise(F.col("payload")))
        assert rows_of(verify_rows(changed, "key").select("id", "signature_ok")) == [(0, True), (1, False)]

    def test_month_range_in_december(self, spark):
        df = spark.createDataFrame([(date(2023, 12, 31),), (date(2024, 1, 1),)], "date date")
        assert R.in_month_of(df, date(2023, 12, 5)).count() == 1

    def test_filters(self, attendance):
        assert R.filter_by(attendance, department="All", status=None).count() == 12
        assert R.filter_by(attendance, status="Late").count() == 1

    def test_nan(self, spark):
        assert rows_of(R.nan_as_null(numbers(spark, [float("nan"), 1.0]))) == [(1.0,), (None,)]


class TestStatistics:
    def test_quantiles(self, spark):
        got = N.exact_quantiles(numbers(spark, [1.0, 2.0, 2.0, 4.0, None]), "x", [0.0, 0.25, 0.5, 1.0]).first()
        assert tuple(got) == (1.0, 1.75, 2.0, 4.0)

    def test_no_values(self, spark):
        empty = numbers(spark, [None, None])
        assert tuple(N.exact_quantiles(empty, "x", [0.5]).first()) == (None,)
        assert N.iqr_outliers(empty, "x").first().outliers == 0
        assert N.column_statistics(empty, "x").first().mean is None

    def test_description(self, spark):
        row = N.describe_numeric(numbers(spark, [1.0, 2.0, 3.0, 4.0]), "x").first()
        assert (row["count"], row.mean, row.min, row.p25, row.p50, row.max) == (4, 2.5, 1.0, 1.75, 2.5, 4.0)
        assert row.std == pytest.approx(1.2909944487)

    def test_describe_all(self, attendance):
        out = {r["column"]: r for r in N.describe_all(attendance, ["status", "hours_worked", "notes"]).collect()}
        assert (out["status"]["count"], out["status"]["distinct"], out["status"].top, out["status"].freq) == (11, 6, "Present", 6)
        assert (out["notes"]["count"], out["notes"].top) == (0, None)

    def test_correlation_uses_pairs_without_nulls(self, spark):
        df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, None), (4.0, 8.0)], "a double, b double")
        assert N.correlations(df).first().correlation == 1.0

    def test_types(self, spark):
        df = spark.createDataFrame([(1, 70000, "a")] * 20 + [(-3, 5, "b")], "a bigint, b bigint, c string")
        advice = {r["column"]: r for r in N.type_advice(df).collect()}
        assert (advice["a"].advice, advice["b"].advice, advice["c"].low_cardinality) == ("tinyint", "int", True)
        assert dict(N.narrow_integers(df).dtypes) == {"a": "tinyint", "b": "int", "c": "string"}


class TestWarehouse:
    def test_star_schema(self, spark, attendance, employees):
        dept = spark.createDataFrame([("Research", "Zed", 2e6)], "department_name string, head string, budget double")
        star = M.star_schema(attendance, employees, dept)
        assert star["dim_date"].count() == 12 and star["dim_shift"].count() == 3
        assert [r.emp_key for r in star["dim_employee"].orderBy("employee_id").collect()] == [1, 2, 3, 4, 5, 6]
        fact = star["fact_attendance"].orderBy("fact_id").collect()
        assert len(fact) == 12
        assert (fact[1].date_key, fact[1].emp_key, fact[1].dept_key, fact[1].shift_key, fact[1].is_absent) == (20240102, 2, 1, 1, 0)
        assert fact[10].is_absent == 1 and fact[10].emp_key is None
