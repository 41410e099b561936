"""Sources, sinks, versioned tables and whole jobs."""

import uuid
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from rollcall.operators.tableops import VersionedTable, append_shifted, random_score, upsert
from rollcall.plans import batch
from rollcall.plans.daily import daily_run
from rollcall.schemas import ATTENDANCE, EVENT
from rollcall.session import checkpoint_root, shared_path
from rollcall.sources import readers, writers
from rollcall.sources.files import list_names


@pytest.fixture
def name():
    return f"t_{uuid.uuid4().hex[:10]}"


@pytest.fixture
def folder(spark, attendance, employees, tmp_path):
    """The raw files of a small company, one file per table."""
    def put(df, name):
        df.toPandas().to_csv(tmp_path / f"{name}.csv", index=False)

    clean = attendance.withColumns({"check_in": F.lit(None).cast("string"), "check_out": F.lit(None).cast("string")})
    put(clean.select([f.name for f in ATTENDANCE.fields]), "attendance")
    put(employees.withColumn("manager_id", F.lit(None).cast("string")), "employees")
    put(spark.createDataFrame([(1, "Research", "Zed", 2e6)], "department_id int, department_name string, head string, budget double"), "departments")
    return str(tmp_path)


class TestFiles:
    def test_shared_folder_is_the_configured_one(self, spark):
        assert shared_path(spark, "x").startswith(checkpoint_root(spark) + "/x-")
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured:
            assert checkpoint_root(spark) == configured.rstrip("/")

    def test_directory(self, spark, folder):
        tables = readers.read_directory(spark, folder)
        assert sorted(tables) == ["attendance", "departments", "employees"]
        assert spark.table("attendance").count() == 12
        report = {r.table: (r.rows, r.columns, r.missing) for r in readers.directory_report(tables).collect()}
        assert report["attendance"] == (12, 13, 38)
        assert readers.read_directory(spark, folder + "/none") == {}

    def test_csv_lines_that_do_not_fit(self, spark, tmp_path):
        (tmp_path / "d.csv").write_text("a,b\n1,x\nz,y\n")
        from pyspark.sql.types import IntegerType, StringType, StructType

        schema = StructType().add("a", IntegerType()).add("b", StringType())
        rows = readers.read_csv(spark, str(tmp_path / "d.csv"), schema, keep_corrupt=True).cache().collect()
        assert [(r.a, r[readers.CORRUPT]) for r in rows] == [(1, None), (None, "z,y")]
        assert dict(readers.read_csv(spark, str(tmp_path / "d.csv")).dtypes) == {"a": "string", "b": "string"}

    def test_json_array(self, spark, tmp_path):
        (tmp_path / "e.json").write_text('[{"event_id": "1", "event_type": "CHECK_IN"},\n {"event_id": "2"}]')
        assert readers.read_json_array(spark, str(tmp_path / "e.json"), EVENT).count() == 2

    def test_load_table_falls_back(self, spark, folder, employees, name):
        assert readers.load_table(spark, "leaves").count() == 0
        assert readers.load_table(spark, "employees_not_stored", f"{folder}/employees.csv").count() == 6
        writers.write_table(employees, name)
        assert readers.load_table(spark, name).count() == 6

    def test_run_date_is_replaced_and_retired(self, spark, attendance, tmp_path):
        path = str(tmp_path / "daily")
        for day in (1, 2, 10, 10):
            writers.write_run_date(attendance.drop("notes"), path, date(2024, 1, day))
        assert spark.read.parquet(path).count() == 36
        assert writers.expire_partitions(spark, path, date(2024, 1, 10), 7) == ["2024-01-01", "2024-01-02"]
        assert spark.read.parquet(path).count() == 12
        assert writers.retained(attendance, date(2024, 1, 10), 7).count() == 10

    def test_layout_by_day_and_archive(self, spark, attendance, tmp_path):
        writers.write_daily_monthly(attendance.drop("notes"), str(tmp_path / "lake"))
        assert list_names(spark, str(tmp_path / "lake/daily/year=2024/month=01"))[0] == "day=01"
        assert spark.read.parquet(str(tmp_path / "lake/monthly")).count() == 12
        moved = attendance.drop("notes").withColumn("date", F.when(F.col("attendance_id") < 4, F.lit(date(2023, 12, 9))).otherwise(F.col("date")))
        for _ in range(2):  # a repeated delivery replaces what it wrote
            rest = writers.archive_closed(moved, str(tmp_path / "old"), date(2024, 1, 31), "2024-01-31")
        assert (rest.count(), spark.read.parquet(str(tmp_path / "old")).count()) == (9, 3)
        writers.archive_closed(moved.limit(0).union(moved.filter("attendance_id = 1")), str(tmp_path / "old"), date(2024, 1, 31), "late")
        assert spark.read.parquet(str(tmp_path / "old")).count() == 4

    def test_create_table_as_replaces(self, spark, attendance, name):
        for limit in (3, 5):
            writers.create_table_as(spark, name, f"SELECT * FROM {{att}} WHERE attendance_id <= {limit}", att=attendance)
        assert spark.table(name).count() == 5


class TestUpsert:
    def test_partial_columns_nulls_and_new_keys(self, spark):
        target = spark.createDataFrame([("a", 1, "x", 1.0), ("b", 1, "y", 2.0), (None, 1, "z", 3.0)], "k string, d int, s string, v double")
        source = spark.createDataFrame([("a", 1, None), ("c", 1, 9.0), (None, 1, 7.0)], "k string, d int, v double")
        got = upsert(target, source, ["k", "d"])
        assert got.columns == target.columns
        assert rows_of(got) == rows_of(spark.createDataFrame(
            [("a", 1, "x", None), ("b", 1, "y", 2.0), (None, 1, "z", 3.0), ("c", 1, None, 9.0), (None, 1, None, 7.0)],
            "k string, d int, s string, v double"))

    def test_one_source_row_per_key(self, spark):
        target = spark.createDataFrame([(1, "old")], "k int, v string")
        source = spark.createDataFrame([(1, "first", 1), (1, "last", 2), (2, "p", 1), (2, "q", 2)], "k int, v string, n int")
        got = upsert(target, source, ["k"], [F.desc("n")])
        assert rows_of(got) == [(1, "last"), (2, "q")]

    def test_several_source_rows_for_one_target_row_are_refused(self, spark):
        target = spark.createDataFrame([(1, "old"), (3, "kept"), (None, "n")], "k int, v string")
        source = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
        with pytest.raises(Exception, match="several source rows"):
            upsert(target, source, ["k"]).collect()
        with pytest.raises(Exception, match="several source rows"):
            upsert(target, source, ["k"]).select("v").collect()
        # of a key the target does not have, and of null keys, all are added
        more = spark.createDataFrame([(2, "a"), (2, "b"), (None, "x"), (None, "y")], "k int, v string")
        assert rows_of(upsert(target, more, ["k"])) == rows_of(target.unionByName(more))

    def test_target_is_read_once(self, spark, tmp_path):
        spark.range(10).selectExpr("id k", "id v").write.parquet(str(tmp_path / "t"))
        target = spark.read.parquet(str(tmp_path / "t"))
        plan = upsert(target, target.limit(3), ["k"])._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation") == 2  # the target, and the target as this source

    def test_append_shifted(self, attendance):
        out = append_shifted(attendance, ["attendance_id"], 3, 365)
        assert out.count() == 15 and out.filter("date >= '2024-12-31'").count() == 3


class TestVersions:
    def test_life_of_a_table(self, spark, tmp_path):
        table = VersionedTable(spark, str(tmp_path / "t"))
        assert table.history().count() == 0
        first = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
        at = datetime(2024, 1, 1)
        assert table.overwrite(first, at) == 0
        assert table.append(spark.createDataFrame([(3, "c", True)], "k int, v string, extra boolean"), at) == 1
        assert table.merge(spark.createDataFrame([(1, "A"), (9, "Z")], "k int, v string"), ["k"], at=at) == 2
        assert table.evolve("score", random_score(1), at) == 3
        assert table.compact(1, at) == 4
        assert rows_of(table.read(0)) == [(1, "a"), (2, "b")]
        assert rows_of(table.read(1)) == rows_of(spark.createDataFrame([(1, "a", None), (2, "b", None), (3, "c", True)], "k int, v string, extra boolean"))
        assert sorted((r.k, r.v) for r in table.read(2).collect()) == [(1, "A"), (2, "b"), (3, "c"), (9, "Z")]
        assert "score" in table.read().columns and table.read().count() == 4
        log = table.history().orderBy("version").collect()
        assert [(r.version, r.operation, r.base) for r in log] == [(0, "WRITE", 0), (1, "APPEND", 0), (2, "MERGE", 2), (3, "ADD COLUMN", 3), (4, "OPTIMIZE", 4)]
        assert table.purge(2) == [0, 1]
        assert table.read(2).count() == 4

    def test_unfinished_write_is_not_seen_and_is_replaced(self, spark, tmp_path):
        table = VersionedTable(spark, str(tmp_path / "t"))
        table.overwrite(spark.range(3))
        spark.range(100).write.parquet(str(tmp_path / "t/v=1"))  # no history row follows
        assert table.read().count() == 3
        table.append(spark.range(2))
        assert table.read().count() == 5
        with pytest.raises(ValueError):
            table.read(7)


class TestJobs:
    def test_full_batch(self, spark, folder, tmp_path):
        results = batch.full_batch(spark, folder, str(tmp_path / "wh"))
        assert [(r.table, r.status, r.rows) for r in results] == [
            ("departments", "loaded", 1), ("employees", "loaded", 6), ("attendance", "loaded", 12), ("leaves", "missing", 0)
        ]
        assert spark.table("dept_attendance_summary").first().present == 6
        assert spark.table("monthly_trend").first().active_employees == 12
        report = batch.ingest_report(spark, results).first()
        assert (report.files_processed, report.rows_ingested, report.files_failed) == (3, 19, 0)

    def test_rejected_and_emptied(self, spark, name):
        assert batch.ingest_table(spark.range(1), "attendance").status == "rejected"
        df = spark.createDataFrame([(1.0, "x"), (float("nan"), "y"), (None, None)], "a double, b string")
        result = batch.ingest_table(df, name)
        assert (result.status, result.rows) == ("loaded", 2)
        assert spark.table(name).filter("b = 'y'").first().a is None

    def test_empty_file_is_not_processed(self, spark, name, tmp_path):
        spark.range(2).write.saveAsTable(name)
        for i, content in enumerate(("", "attendance_id,employee_id,date,status\n")):
            path = tmp_path / f"{i}.csv"
            path.write_text(content)
            result = batch.ingest_file(spark, str(path), name)
            assert (result.status, result.rows) == ("empty", 0) and spark.table(name).count() == 2
            assert batch.ingest_report(spark, [result]).first().files_processed == 0

    def test_merge_and_summarize(self, spark, folder, tmp_path):
        out = batch.merge_and_summarize(spark, folder, str(tmp_path / "out"))
        assert out["enriched"].count() == 12 and out["summary"].count() == 12
        assert out["enriched"].filter("employee_id = 'EMP0002'").first().name == "Okko"

    def test_analysis_and_suite(self, spark, attendance, tmp_path):
        out = batch.analysis(attendance, str(tmp_path / "a"))
        assert out["statistics"].first().n == 11
        assert dict(spark.read.parquet(str(tmp_path / "a/attendance_optimized")).dtypes)["attendance_id"] == "tinyint"
        suite = batch.attendance_suite(attendance, str(tmp_path / "s"))
        assert suite["top_rows"].count() == 3 and suite["wfh_by_month"].first()["count"] == 1

    def test_star_schema(self, spark, attendance, employees, tmp_path):
        dept = spark.createDataFrame([("Research", "Zed", 2e6)], "department_name string, head string, budget double")
        stored = batch.load_star_schema(attendance, employees, dept, str(tmp_path / "star"))
        assert stored["fact_attendance"].filter("emp_key IS NOT NULL").count() == 6

    def test_daily_run(self, spark, attendance, employees, tmp_path):
        root = str(tmp_path / "dw")
        raw = attendance.drop("notes")
        for _ in range(2):
            assert daily_run(raw, employees, date(2024, 1, 1), root).status == "loaded"
        assert spark.read.parquet(f"{root}/dw_attendance_daily").count() == 12
        later = daily_run(raw, employees, date(2024, 1, 20), root)
        assert later.removed == ["2024-01-01"]
        assert list_names(spark, f"{root}/staging/attendance_daily") == ["ds=2024-01-20"]
        kept = spark.read.parquet(f"{root}/dw_attendance_daily")  # the warehouse keeps the run of the 1st
        assert kept.count() == 24 and kept.select("ds").distinct().count() == 2
        assert spark.read.json(f"{root}/reports/kpi_20240120").first().total_records == 24
        assert spark.read.json(f"{root}/reports/dq_20240120").first().summary.total == 16

    def test_daily_gate(self, spark, attendance, employees, tmp_path):
        root = str(tmp_path / "dw")
        doubtful = attendance.withColumn("location", F.lit(None).cast("string"))
        assert daily_run(doubtful, employees, date(2024, 1, 1), root).status == "alert"
        bad = doubtful.withColumns({c: F.lit(None).cast("string") for c in ("shift", "day_of_week", "department")})
        outcome = daily_run(bad, employees, date(2024, 1, 1), root)
        assert outcome.status == "failed" and outcome.null_rate > 0.3
        assert daily_run(attendance.limit(0), employees, date(2024, 1, 1), root).status == "failed"
        assert list_names(spark, root) == []


def test_release_deletes_only_what_was_staged(spark):
    from rollcall.session import release, written
    from rollcall.sources.files import path_exists

    staged = written(spark.range(3), "staged")
    path = staged.inputFiles()[0].rsplit("/", 1)[0]
    assert staged.count() == 3 and path_exists(spark, path)
    assert release(spark) >= 1 and not path_exists(spark, path)
    assert release(spark) == 0
