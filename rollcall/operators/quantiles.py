"""Exact quantiles of whole columns and of groups in two scans.

The first scan makes a mergeable sketch of every column and group. It gives, for
each wanted quantile, two values between which it must lie. The second scan counts
what lies below and between such brackets and keeps only the values inside them,
each different one once with its count. Only those are put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rollcall.operators.splits import same_keys

# Ranks from the sketch are off by at most 1/ACCURACY of a group's rows. Groups up to that size are ordered whole.
ACCURACY = 10_000
_SLACK = 4  # brackets are so many of these errors wide on either side
# The brackets of at most so many groups go to every task; those of more are joined by a shuffle.
MOST_GROUPS = 10_000


def quantile_name(prob: float) -> str:
    return f"p{prob * 100:g}".replace(".", "_")


def _long_form(df: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    """One row per value: the keys, the number of the column, and the value as double."""
    if len(columns) == 1:
        return df.select(*keys, F.lit(0).alias("_column"), F.col(columns[0]).cast("double").alias("_v"))
    cells = F.array(*[F.struct(F.lit(i).alias("_column"), F.col(c).cast("double").alias("_v")) for i, c in enumerate(columns)])
    return df.select(*keys, F.inline(cells))


def _brackets(rows: DataFrame, keys: list[str], probs: list[float], also: dict[str, Column], accuracy: int) -> DataFrame:
    """Per key: ``_n`` values, the figures ``also``, and arrays ``_lo`` and ``_hi`` with a bracket for every quantile."""
    width = _SLACK / accuracy
    points = [max(0.0, p - width) for p in probs] + [min(1.0, p + width) for p in probs]
    stats = rows.groupBy(*keys).agg(
        F.count("_v").alias("_n"), F.percentile_approx("_v", points, accuracy).alias("_points"),
        *[c.alias(name) for name, c in also.items()])
    large, m = F.col("_n") > accuracy, len(probs)
    return stats.withColumns({
        "_lo": F.when(large, F.slice("_points", 1, m)), "_hi": F.when(large, F.slice("_points", m + 1, m))}).drop("_points")


def _small(brackets: DataFrame) -> DataFrame | None:
    """The brackets as a table that may go to every task, if they are few; they are worked out once."""
    rows = brackets.limit(MOST_GROUPS + 1).collect()
    return brackets.sparkSession.createDataFrame(rows, brackets.schema) if len(rows) <= MOST_GROUPS else None


def _selected(rows: DataFrame, brackets: DataFrame, keys: list[str], probs: list[float], broadcast: bool) -> DataFrame:
    """Per key the interpolated quantiles, by name."""
    beside = brackets.select(*[F.col(k).alias(f"_b_{k}") for k in keys], "_n", "_lo", "_hi")
    met = rows.where("_v is not null").join(F.broadcast(beside) if broadcast else beside, same_keys(keys, "_b_"))
    v, passed, inside = F.col("_v"), F.lit(0), F.lit(False)
    for i in range(len(probs)):
        low, high = F.get("_lo", F.lit(i)), F.get("_hi", F.lit(i))
        passed = passed + F.when(v > high, F.lit(1)).otherwise(F.lit(0))
        inside = inside | (F.coalesce(v >= low, F.lit(True)) & F.coalesce(v <= high, F.lit(True)))
    # between two brackets only the number of rows matters; beyond the last nothing does
    counted = (
        met.select(*keys, "_n", passed.alias("_passed"), F.when(inside, v).alias("_inside"))
        .where((F.col("_passed") < len(probs)) | F.col("_inside").isNotNull())
        .groupBy(*keys, "_n", "_passed", "_inside").agg(F.count(F.lit(1)).alias("_rows"))
    )
    upto = Window.partitionBy(*keys).orderBy("_passed", F.col("_inside").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    ranked = counted.withColumn("_next", F.sum("_rows").over(upto))
    at = {p: F.lit(p) * (F.col("_n") - 1) for p in probs}

    def value(rank: Column) -> Column:
        rank = rank.cast("bigint")
        return F.max(F.when((rank < F.col("_next")) & (rank >= F.col("_next") - F.col("_rows")), F.col("_inside")))

    found = ranked.groupBy(*keys, "_n").agg(
        *[value(F.floor(at[p])).alias(f"_low{i}") for i, p in enumerate(probs)],
        *[value(F.ceil(at[p])).alias(f"_high{i}") for i, p in enumerate(probs)])
    missed = F.raise_error(F.lit("a quantile lies outside its bracket"))  # would break the bound of the sketch
    out = []
    for i, p in enumerate(probs):
        low, high = F.col(f"_low{i}"), F.col(f"_high{i}")
        between = F.when(low == high, low).otherwise(low + (high - low) * (at[p] - F.floor(at[p])))
        out.append(F.when(low.isNull() | high.isNull(), missed).otherwise(between).cast("double").alias(quantile_name(p)))
    return found.select(*keys, *out)


def column_quantiles(
    df: DataFrame, columns: list[str], probs: list[float], keys: list[str] | None = None, also: dict[str, Column] | None = None,
    accuracy: int = ACCURACY,
) -> DataFrame:
    """Exact, linearly interpolated quantiles ``p25``, ``p50``, ... of numeric columns, a row per column.

    Columns: ``keys``, ``column``, ``n`` (values that are not null), the figures
    ``also`` (aggregates of the value ``_v``, made in the first scan), the
    quantiles. With ``keys`` there is a row per group and column; null is a group
    like any other. Without, a column has its row even if the table is empty.
    Without values ``n`` is 0 and the quantiles are null. NaN is the largest value.

    All columns share both scans. A value outside the brackets is never moved, and
    a group's values are never gathered: of a group of n rows at most about
    8/``accuracy`` of them per quantile are ordered, and repeated values are one row.
    """
    keys, also = list(keys or []), dict(also or {})
    rows, by = _long_form(df, columns, keys), [*keys, "_column"]
    brackets = _brackets(rows, by, probs, also, accuracy)
    few = _small(brackets)
    if few is not None and not keys:
        missing = [i for i in range(len(columns)) if i not in {r["_column"] for r in few.select("_column").collect()}]
        empty = [tuple(i if f.name == "_column" else 0 if f.name == "_n" else None for f in few.schema) for i in missing]
        few = few.unionByName(df.sparkSession.createDataFrame(empty, few.schema)) if empty else few
    chosen = _selected(rows, brackets if few is None else few, by, probs, few is not None)
    known = brackets if few is None else few
    found = chosen.select(*[F.col(k).alias(f"_f_{k}") for k in by], *map(quantile_name, probs))
    joined = known.join(found, same_keys(by, "_f_"), "left")
    names = F.array(*[F.lit(c) for c in columns])
    return joined.select(
        *keys, F.get(names, F.col("_column")).alias("column"), F.col("_n").alias("n"), *also, *map(quantile_name, probs))
