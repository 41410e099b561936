"""The split paths give the results of the plain ones, whatever one key holds."""

import random
from collections import Counter
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from conftest import rows_of
from rollcall.functions.scalar import partition_number
from rollcall.operators import relational as R
from rollcall.operators import statistics as N
from rollcall.operators import windows as W
from rollcall.operators.aggregates import overtime_by_department_exact
from rollcall.operators.quantiles import column_quantiles
from rollcall.operators.splits import running_sum, split_points, with_position, with_position_within
from rollcall.streaming import events as E
from rollcall.streaming import windows as T


@pytest.fixture(autouse=True)
def whole_probe(monkeypatch):
    """Small tables are sampled as if they were large."""
    from rollcall.operators import splits

    monkeypatch.setattr(splits, "PROBE", 1.0)


@pytest.fixture(scope="module")
def skewed(spark):
    """600 rows; employee 1 has more than half, employee None a tenth; few dates, many ties."""
    rng = random.Random(5)
    rows = []
    for i in range(600):
        who = 1 if rng.random() < 0.55 else None if rng.random() < 0.2 else rng.randint(2, 9)
        hours = None if rng.random() < 0.2 else rng.randint(0, 28) / 2
        rows.append((i, who, date(2024, 1, 1) + timedelta(days=rng.randint(0, 11)), rng.choice(["Present", "Late", "Absent"]), hours))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "attendance_id bigint, employee_id bigint, date date, status string, hours_worked double")
    return df.repartition(5).cache()


def test_split_points(skewed):
    order = [F.col("date"), F.col("attendance_id")]
    assert split_points(skewed, ["employee_id"], order) is None  # smaller than the sample
    points = {r.employee_id: r["_points"] for r in split_points(skewed, ["employee_id"], order, 10).collect()}
    assert 1 in points and 3 <= len(points[1]) <= 9 and points[1] == sorted(points[1])
    assert sum(map(len, points.values())) < 10


@pytest.mark.parametrize("blocks", [3, 18])
def test_running_total(skewed, blocks):
    assert rows_of(W.running_hours(skewed, blocks)) == rows_of(W.running_hours(skewed, 10_000))


@pytest.mark.parametrize("blocks,chunk", [(3, 3), (10, 20), (18, 100)])
def test_weekly_average(skewed, blocks, chunk):
    assert rows_of(W.weekly_average_hours(skewed, blocks, chunk)) == rows_of(W.weekly_average_hours(skewed, 10_000))


@pytest.mark.parametrize("blocks,chunk", [(400, 3), (18, 50), (5, 10_000)])
def test_rolling_mean(skewed, blocks, chunk):
    w = Window.orderBy("date", "attendance_id").rowsBetween(-6, 0)
    want = skewed.withColumn("hours_worked_rolling_7d", F.avg("hours_worked").over(w))
    assert rows_of(W.rolling_mean(skewed, "hours_worked", blocks=blocks, chunk_rows=chunk)) == rows_of(want)


@pytest.mark.parametrize("blocks", [400, 18, 4])
def test_positions(skewed, blocks):
    order = [F.col("date"), F.col("attendance_id")]
    want = skewed.withColumn("position", F.row_number().over(Window.orderBy(*order)))
    assert rows_of(with_position(skewed, order, blocks=blocks).select(want.columns)) == rows_of(want)
    want = skewed.withColumn("position", F.row_number().over(Window.partitionBy("employee_id").orderBy(*order)))
    got = with_position_within(skewed, ["employee_id"], order, blocks=blocks)
    assert rows_of(got.select(want.columns)) == rows_of(want)


def test_five_thousand_large_keys(spark, monkeypatch):
    """A small bound makes every key large; none is left out."""
    df = spark.range(60_000).select((F.col("id") % 5_000).alias("k"), "id", (F.col("id") % 7).alias("v"))
    order = [F.col("id")]
    points = split_points(df, ["k"], order, 12_000, 5)
    assert points.count() > 4_000
    from rollcall.operators import splits

    monkeypatch.setattr(splits, "split_points", lambda *a: points)
    want = df.withColumn("t", F.sum("v").over(Window.partitionBy("k").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)))
    got = running_sum(df, "v", ["k"], order, "t")
    assert got.select(want.columns).exceptAll(want).count() == 0 and got.count() == 60_000


def test_positions_write_nothing(skewed):
    from rollcall import session

    before = len(session._WRITTEN)
    with_position(skewed, [F.col("attendance_id")], blocks=10).count()
    column_quantiles(skewed, ["hours_worked"], [0.5]).count()
    assert len(session._WRITTEN) == before


@pytest.mark.parametrize("rows", [1, 2, 3, 4, 7, 10])
@pytest.mark.parametrize("tiles", [4, 5])
def test_ntile(spark, rows, tiles):
    df = spark.range(rows)
    want = df.withColumn("t", F.ntile(tiles).over(Window.orderBy("id")))
    assert rows_of(W.ntile(df, tiles, [F.col("id")], "t")) == rows_of(want)


def test_rank(spark):
    rng = random.Random(2)
    df = spark.createDataFrame([(i, rng.choice("ab"), rng.randint(0, 6)) for i in range(200)], "id int, g string, n int")
    want = df.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy(F.desc("n"))))
    got = W.rank_by_count(df, "g", "n", "r").select(want.columns)
    assert rows_of(got) == rows_of(want)


def test_quantiles_of_many_values(spark):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.normal(size=3000), np.full(1500, 0.25)])
    df = spark.createDataFrame([(float(v),) for v in values], "x double").repartition(7)
    probs = [0.01, 0.25, 0.5, 0.75, 0.9, 0.99]
    got = N.exact_quantiles(df, "x", probs).first()
    assert list(got) == pytest.approx(list(np.percentile(values, [100 * p for p in probs])), abs=1e-12)


@pytest.mark.parametrize("accuracy", [20, 100, 10_000])
def test_quantiles_of_groups(spark, accuracy):
    """One group holds most rows; one has a single value, one only nulls; null is a group; NaN is the largest."""
    rng = np.random.default_rng(4)
    groups = {"hot": rng.normal(size=4000).round(2).tolist(), "few": [3.0, 1.0], "one": [7.0] * 900, "none": [None] * 5,
              None: rng.integers(0, 5, 700).astype(float).tolist(), "nan": [1.0, 2.0, float("nan")]}
    df = spark.createDataFrame([(k, v, v and -v) for k, vs in groups.items() for v in vs], "k string, v double, w double").repartition(6)
    probs = [0.0, 0.1, 0.5, 0.9, 1.0]
    names = ["p0", "p10", "p50", "p90", "p100"]
    got = {(r.k, r.column): r for r in column_quantiles(df, ["v", "w"], probs, ["k"], {"most": F.max("_v")}, accuracy).collect()}
    assert len(got) == 12 and got["none", "v"].n == 0 and got["none", "w"].p50 is None
    for k, vs in groups.items():
        if k not in ("none", "nan"):
            assert [got[k, "v"][n] for n in names] == pytest.approx(list(np.percentile(vs, [100 * p for p in probs])), abs=1e-12)
            assert [got[k, "w"][n] for n in names] == pytest.approx(list(np.percentile([-v for v in vs], [100 * p for p in probs])), abs=1e-12)
            assert (got[k, "v"].n, got[k, "v"].most) == (len(vs), max(vs))
    assert got["nan", "v"].p0 == 1.0 and got["nan", "v"].p50 == 2.0 and np.isnan(got["nan", "v"].p100)


def test_quantiles_of_many_groups(spark, monkeypatch):
    from rollcall.operators import quantiles

    monkeypatch.setattr(quantiles, "MOST_GROUPS", 3)  # brackets are joined by a shuffle
    df = spark.range(500).select((F.col("id") % 9).alias("k"), F.col("id").cast("double").alias("v"))
    got = {r.k: r.p50 for r in column_quantiles(df, ["v"], [0.5], ["k"]).collect()}
    assert got == {k: float(np.median(np.arange(k, 500, 9))) for k in range(9)}


def test_only_bracket_values_are_moved(spark):
    """Of 200,000 different values the shuffle of the second scan gets a few hundred."""
    df = spark.range(200_000, numPartitions=4).select(F.col("id").cast("double").alias("x"))
    out = column_quantiles(df, ["x"], [0.5])
    assert out.first().p50 == 99_999.5
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "RangePartitioning" not in plan and "rangepartitioning" not in plan
    from rollcall.operators.quantiles import _brackets, _long_form

    r = _brackets(_long_form(df, ["x"], []), ["_column"], [0.5], {}, 10_000).first()
    assert 0 < r["_hi"][0] - r["_lo"][0] < 500


def test_one_department_holds_all_rows(spark):
    emp = spark.createDataFrame([(i, "Works") for i in range(20)] + [(99, "Idle")], "employee_id bigint, department string")
    att = spark.range(30_000).select((F.col("id") % 20).alias("employee_id"), (F.col("id") % 1009 / 8.0).alias("overtime_hours"))
    row = overtime_by_department_exact(emp, att).collect()
    values = np.array([i % 1009 / 8.0 for i in range(30_000)])
    values = values[values > 0]
    assert len(row) == 1 and row[0].median_overtime == np.median(values) and row[0].max_overtime == values.max()
    assert row[0].avg_overtime == pytest.approx(values.mean())


def test_offsets(spark):
    rng = random.Random(4)
    start = datetime(2024, 1, 1)
    rows = [(f"e{i}", "hot" if rng.random() < 0.6 else str(rng.randint(0, 20)), start + timedelta(seconds=rng.randint(0, 90))) for i in range(400)]
    df = spark.createDataFrame(rows, "event_id string, employee_id string, event_ts timestamp").repartition(6)
    keyed = df.withColumn("partition", partition_number("employee_id", 3))
    want = keyed.withColumn("offset", F.row_number().over(Window.partitionBy("partition").orderBy("event_ts", "event_id")) - 1)
    assert rows_of(E.partition_offsets(df, 3).select(want.columns)) == rows_of(want)
    assert keyed.groupBy("employee_id").agg(F.count_distinct("partition").alias("n")).filter("n > 1").count() == 0


def test_sessions_agree_with_the_built_in_window(spark):
    rng = random.Random(6)
    start = datetime(2024, 1, 1)
    times = [start + timedelta(seconds=rng.randint(0, 200_000), microseconds=rng.randint(0, 999_999)) for _ in range(500)]
    rows = [("hot" if i % 2 else str(i % 5), t) for i, t in enumerate(times)]
    # a pause of exactly the gap, and one a second longer
    later = start + timedelta(days=9)
    rows += [("hot", later + timedelta(seconds=s)) for s in (0, 1800, 3601)]
    df = spark.createDataFrame(rows, "employee_id string, event_ts timestamp")
    assert rows_of(T.session_table(df)) == rows_of(T.sessions(df, delay=None).select("window_start", "window_end", "employee_id", "events"))


def test_keep_first_limits_before_the_shuffle(skewed):
    plan = W.keep_first(skewed, ["employee_id", "date"], [F.col("attendance_id")])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("hashpartitioning") < plan.index("Partial")


def test_moving_average_over_days(spark):
    rows = [(1, date(2024, 1, d), float(d)) for d in (1, 2, 8, 20)]
    df = spark.createDataFrame(rows, "employee_id int, date date, hours_worked double")
    got = W.moving_average_days(df, "hours_worked", ["employee_id"], "date", "avg7").orderBy("date").collect()
    assert [r.avg7 for r in got] == [1.0, 1.5, 5.0, 20.0]


def test_absent_while_manager_present_counts_pairs(spark):
    emp = spark.createDataFrame([(1, None), (2, 1), (3, 1)], "employee_id int, manager_id int")
    day = date(2024, 1, 1)
    att = spark.createDataFrame(
        [(1, day, "Present"), (1, day, "Present"), (2, day, "Absent"), (3, day, "Late"), (2, date(2024, 1, 2), "Absent")],
        "employee_id int, date date, status string",
    )
    assert rows_of(R.absent_while_manager_present(emp, att)) == [(2, day, 1, "Present", 2)]


def test_hot_manager_is_dealt_over_blocks(spark):
    """Manager 1 leads 60 of 90 people, 2 one person, 3 nobody; one record pair may be several."""
    rng = random.Random(8)
    people = [(1, None), (2, 1), (3, 2), *[(i, 1) for i in range(4, 63)], *[(i, i - 1) for i in range(63, 91)], (91, None)]
    days = [date(2024, 1, d) for d in range(1, 6)]
    records = [(who, day, rng.choice(["Absent", "Present", "Late", None])) for who, _ in people for day in days for _ in range(rng.randint(0, 3))]
    records += [(None, days[0], "Absent"), (1, None, "Present"), (4, None, "Absent")]
    emp = spark.createDataFrame(people, "employee_id int, manager_id int")
    att = spark.createDataFrame(records, "employee_id int, date date, status string")
    pairs = Counter(
        (who, day, boss, "Present") for who, boss in people if boss is not None for day in days
        for e, d, s in records if (e, d, s) == (who, day, "Absent")
        for m, k, t in records if (m, k, t) == (boss, day, "Present"))
    want = sorted((*k, n) for k, n in pairs.items())
    dealt, plain = (sorted(rows_of(R.absent_while_manager_present(emp, att, staff=n))) for n in (4, 20_000))
    assert want and dealt == want == plain
    led = emp.filter("manager_id is not null").withColumnRenamed("employee_id", "emp_id")
    assert rows_of(R.staff_blocks(led, 4)) == [(1, 15)]
