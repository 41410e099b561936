"""Keys too large for one task, cut into blocks at fixed points of their order.

A narrow scan draws a sample. Keys that hold more than a block's share of it get
split points, taken from their sampled order and sent back as constants. So a
row's block depends on the row alone: nothing is written, every task finds the
same blocks whenever it runs, and a lost executor repeats only its own.
"""

from __future__ import annotations

from itertools import groupby

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

BLOCKS = 400  # blocks the table would be cut into if one key held all of it
SAMPLED = 32  # sampled rows a block: at most about twice BLOCKS * SAMPLED reach the driver
PROBE = 1 / 32  # share of the first sample
_SEED = 17


def same_keys(keys: list[str], prefix: str) -> Column:
    """Null-safe equality of each key with its prefixed copy."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"{prefix}{k}"))
    return cond


def split_points(
    df: DataFrame, keys: list[str], order: list[Column], blocks: int = BLOCKS, sampled: int = SAMPLED
) -> DataFrame | None:
    """The large keys with the sorted points at which their order is cut; None if there are none.

    A key is large if it holds more than about a block and a half of the sample,
    so fewer than ``blocks`` keys are, and all points together are fewer than
    ``blocks``, whatever the size of the table. Which keys are split changes no
    result: a large key that is missed only costs a larger task.

    A first sample of a fixed share is enough for tables of middle size; a smaller
    table has no large keys. Of a larger one the rows are counted and a second
    sample of the right size is drawn.
    """
    spark, size = df.sparkSession, blocks * sampled
    narrow = df.select(*keys, F.struct(*order).alias("_at"))
    sample = narrow.sample(fraction=PROBE, seed=_SEED)
    rows = sample.limit(2 * size + 1).collect()
    if len(rows) < size // 4:
        return None
    if len(rows) > 2 * size:
        sample = narrow.sample(fraction=min(1.0, size / df.count()), seed=_SEED)
        rows = sample.orderBy(*keys, "_at").collect()
    else:  # put in Spark's own order
        rows = spark.createDataFrame(rows, sample.schema).orderBy(*keys, "_at").collect()
    found = []
    for key, own in groupby(rows, lambda r: tuple(r)[:-1]):
        at = [r["_at"] for r in own]
        parts = round(len(at) * blocks / len(rows))
        if parts > 1:
            points = [at[i * len(at) // parts] for i in range(1, parts)]
            found.append((*key, [p for p, _ in groupby(points)]))
    if not found:
        return None
    fields = [sample.schema[k] for k in keys] + [T.StructField("_points", T.ArrayType(sample.schema["_at"].dataType))]
    return spark.createDataFrame(found, T.StructType(fields))


def with_blocks(df: DataFrame, keys: list[str], order: list[Column], points: DataFrame) -> DataFrame:
    """``df`` with ``_block``: of a large key's rows how many of its points are not after them, else 0."""
    most = points.agg(F.max(F.size("_points"))).first()[0]
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(int(most).bit_length()))])
    at, at_most = F.struct(*order), F.coalesce(F.size("_points"), F.lit(0))
    block = F.aggregate(  # a binary search
        steps, F.lit(0), lambda low, step: F.when(
            (low + step <= at_most) & (F.get("_points", low + step - 1) <= at), low + step).otherwise(low))
    if not keys:  # one key: its points are a constant of the plan
        marked = df.withColumn("_points", points.select("_points").scalar())
        return marked.withColumn("_block", block).drop("_points")
    beside = F.broadcast(points.withColumnsRenamed({k: f"_p_{k}" for k in keys}))  # at most BLOCKS points
    joined = df.join(beside, same_keys(keys, "_p_"), "left")
    return joined.withColumn("_block", F.when(F.col("_points").isNotNull(), block).otherwise(F.lit(0))).drop(
        "_points", *[f"_p_{k}" for k in keys])


def carried_in(blocked: DataFrame, keys: list[str], points: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Sums over the earlier blocks of each large key, a row per block but the first; as few rows as there are points."""
    large = large_and_other(blocked, keys, points)[0] if keys else blocked
    spans = large.groupBy(*keys, "_block").agg(*[c.alias(n) for n, c in sums.items()])
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    return spans.select(
        *[F.col(k).alias(f"_c_{k}") for k in keys], F.col("_block").alias("_c_block"), *[F.sum(n).over(before).alias(n) for n in sums])


def join_carried(blocked: DataFrame, keys: list[str], carried: DataFrame) -> DataFrame:
    on = same_keys(keys, "_c_") & (F.col("_block") == F.col("_c_block"))
    return blocked.join(F.broadcast(carried), on, "left").drop("_c_block", *[f"_c_{k}" for k in keys])


def with_position_within(
    df: DataFrame, keys: list[str], order: list[Column], name: str = "position", blocks: int = BLOCKS,
    points: DataFrame | None = None,
) -> DataFrame:
    """The 1-based position of each row among the rows of its key, for keys of any size.

    ``order`` sorts ascending, nulls first, and has to end in a unique column. One
    shuffle of the rows; the counts before a block come from a narrow scan of the
    large keys alone. ``points`` are split points known already.
    """
    points = split_points(df, keys, order, blocks) if points is None else points
    if points is None:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(F.struct(*order))).cast("bigint"))
    blocked = with_blocks(df, keys, order, points)
    carried = carried_in(blocked, keys, points, {"_rows_before": F.count(F.lit(1))})
    inside = F.row_number().over(Window.partitionBy(*keys, "_block").orderBy(F.struct(*order)))
    return (
        join_carried(blocked, keys, carried)
        .withColumn(name, inside + F.coalesce(F.col("_rows_before"), F.lit(0)))
        .drop("_block", "_rows_before")
    )


def with_position(df: DataFrame, order: list[Column], name: str = "position", blocks: int = BLOCKS) -> DataFrame:
    """The 1-based position of each row in the whole table, as ``with_position_within`` without keys."""
    return with_position_within(df, [], order, name, blocks)


def running_sum(
    df: DataFrame, value: str, keys: list[str], order: list[Column], name: str, blocks: int = BLOCKS
) -> DataFrame:
    """Running sum of ``value`` per key; a block of a large key starts from the total of the blocks before it."""
    points = split_points(df, keys, order, blocks)
    upto = Window.partitionBy(*keys).orderBy(F.struct(*order)).rowsBetween(Window.unboundedPreceding, 0)
    if points is None:
        return df.withColumn(name, F.sum(value).over(upto))
    blocked = with_blocks(df, keys, order, points)
    carried = carried_in(blocked, keys, points, {"_sum_before": F.sum(value)})
    local = Window.partitionBy(*keys, "_block").orderBy(F.struct(*order)).rowsBetween(Window.unboundedPreceding, 0)
    inside, before = F.sum(value).over(local), F.col("_sum_before")
    # null only while no value at all has been seen
    total = F.coalesce(before + inside, before, inside)
    return join_carried(blocked, keys, carried).withColumn(name, total).drop("_block", "_sum_before")


def large_and_other(df: DataFrame, keys: list[str], points: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of large keys, rows of the others)."""
    marks = F.broadcast(points.select(*[F.col(k).alias(f"_m_{k}") for k in keys]))
    on = same_keys(keys, "_m_")
    return df.join(marks, on, "left_semi"), df.join(marks, on, "left_anti")
