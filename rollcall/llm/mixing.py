"""Mixing sources to target weights by the cube method: balanced sampling on token and document totals."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from rollcall.llm.store import Kept
from rollcall.llm.text import need, words_of

WEIGHTS = (5, 2, 1)  # of the sources in their order, repeating
SHARE = 1.5  # words to take, as a part of all words
MOST = 2.0  # words a source may give, as a part of its own
GROUP = 2_048  # units whose flight one group works out
SEED = 5
_EDGE = 1e-9


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``source``, ``source_size`` and ``target`` from one row per source (``source``, ``source_size``).

    Weights go round the sources in code point order, null last. Sources whose
    share exceeds ``most`` times their size get just that, and the rest is shared
    again: these are the first in the order of size by weight, so running sums in
    that order tell the level at which sharing settles. The windows hold one row
    per source.
    """
    by_name, by_ratio = Window.orderBy(F.col("source").isNull(), "source"), Window.orderBy("ratio", "place")
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("place") - 1) % len(weights)).cast("int"))
    ranked = sizes.withColumn("place", F.row_number().over(by_name)).withColumn("weight", weight)
    ranked = ranked.withColumn("cap", most * F.col("source_size")).withColumn("ratio", F.col("cap") / F.col("weight"))
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = (
        share * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    ) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    levels = ranked.withColumn("level", level)
    # the first source that stays below its cap sets the level for all after it; further on it only falls
    settled = F.max(F.when(F.col("ratio") > F.col("level"), F.col("level"))).over(everything)
    goal = F.when((F.col("ratio") <= F.col("level")) | settled.isNull(), F.col("cap")).otherwise(settled * F.col("weight"))
    return levels.select("source", "source_size", F.least(goal, F.col("cap")).alias("target"))


def flight(p: np.ndarray, x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Move probabilities along the null space of the balance constraints until few are left open.

    ``x`` has a row of figures per unit, whose totals under ``p`` stay as they
    are. While more units are open than there are figures, the first of them, one
    more than figures, move along the one direction that changes no total, to
    where the first of them reaches 0 or 1; a coin of the right odds picks which
    way, so each keeps its expectation.
    """
    p = p.copy()
    n = x.shape[1]
    waiting = [i for i in range(len(p)) if _EDGE < p[i] < 1 - _EDGE]
    waiting.reverse()
    held: list[int] = []
    while True:
        while len(held) <= n and waiting:
            held.append(waiting.pop())
        if len(held) <= n:
            return p
        u = _null(x[held])
        q = p[held]
        with np.errstate(divide="ignore", invalid="ignore"):
            up = np.where(u > 0, (1 - q) / u, np.where(u < 0, -q / u, np.inf)).min()
            down = np.where(u > 0, q / u, np.where(u < 0, (q - 1) / u, np.inf)).min()
        q = q + up * u if rng.random() * (up + down) < down else q - down * u
        p[held] = q
        held = [i for i, v in zip(held, q) if _EDGE < v < 1 - _EDGE]


def _null(a: np.ndarray) -> np.ndarray:
    """A direction u of n + 1 units, each with n figures, that changes no total: a.T @ u = 0."""
    if a.shape[1] == 2:  # words and documents: a cross product
        u = np.cross(a[:, 0], a[:, 1])
        if np.abs(u).max() > 1e-12:
            return u / np.abs(u).max()
    return np.linalg.svd(a.T)[2][-1]


def landing(p: np.ndarray, x: np.ndarray, rng: np.random.Generator, most: int = 12) -> np.ndarray:
    """Flight of all but ten units, then the small problem that is left: of all ways to round it the best balanced."""
    p = p.copy()
    open_ = np.flatnonzero((p > _EDGE) & (p < 1 - _EDGE))
    kept = open_[rng.permutation(len(open_))[: most - x.shape[1]]]
    flying = np.setdiff1d(open_, kept)
    p[flying] = flight(p[flying], x[flying], rng)
    at = np.flatnonzero((p > _EDGE) & (p < 1 - _EDGE))
    if len(at):
        ways = (np.arange(1 << len(at))[:, None] >> np.arange(len(at))) & 1
        words, units = np.abs((ways - p[at]) @ x[at]).T
        p[at] = ways[int(np.argmin(words / max(1.0, x[at, 0].mean()) + 0.1 * units))]
    return np.rint(p)


def _settle(last: bool, seed: int):
    def run(key: tuple, units: pd.DataFrame) -> pd.DataFrame:
        units = units.sort_values(["doc_id", "size"], kind="stable", na_position="last").reset_index(drop=True)
        rng = np.random.default_rng([seed, int(key[1]), len(units), int(units["size"].sum()) & 0xFFFFFFFF])
        n, words = units["n"].to_numpy(float), (units["size"] * units["n"]).to_numpy(float)
        x = np.stack([words, n], axis=1)
        move = landing if last else flight
        order = np.lexsort((rng.random(len(units)), -x[:, 0]))  # what stays open to the end is small
        units.loc[order, "p"] = move(units["p"].to_numpy(float)[order], x[order], rng)
        return units[["source", "doc_id", "size", "n", "p"]]

    return run


def decisions(units: DataFrame, seed: int = SEED, group: int = GROUP) -> DataFrame:
    """``units`` (source, doc_id, size, n, p) with every ``p`` moved to 0 or 1.

    Flights run in groups of about ``group`` units of one source, so a large
    source is many groups. Each leaves at most two units open; these form the
    groups of the next level, until one group per source is left and lands. The
    group of a unit depends on its id and size only, hence reruns agree.
    """
    schema, done, level = units.schema, None, 0
    now = units
    while True:
        counts = now.groupBy("source").agg(F.count(F.lit(1)).alias("units"))
        wide = counts.agg(F.max("units")).first()[0] or 0
        last = wide <= group
        of = F.pmod(F.xxhash64("doc_id", "size", F.lit(level)), F.ceil(F.col("units") / group))
        grouped = now.join(counts.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
        moved = Kept(grouped.withColumn("part", F.lit(0).cast("long") if last else of).drop("_source", "units").groupBy(
            "source", "part").applyInPandas(_settle(last, seed + level), schema), "mixing").rows
        open_ = F.col("p").between(_EDGE, 1 - _EDGE)
        settled = moved.where(~open_)
        done = settled if done is None else done.unionByName(settled)
        if last:
            return done
        now, level = moved.where(open_), level + 1


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) of every document.

    A document is taken as often as the whole part of target / source size says,
    and once more if the sample picks it, with the fraction as its probability:
    words and documents taken from a source meet their totals up to one landing
    per source. A null text has size 0; null sources are one source, the last; a
    null doc_id is a unit like others. Rows equal in source, id and size are one
    unit, taken together. Other columns are not read; no rows give no rows. Only
    ids and sizes are shuffled.
    """
    sized = Kept(need(docs, "doc_id", "source", "text").select(
        "doc_id", "source", F.size(words_of(F.col("text"))).cast("long").alias("size")), "mixing").rows
    units = sized.groupBy("source", "doc_id", "size").agg(F.count(F.lit(1)).alias("n"))
    goals = Kept(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most), "mixing").rows
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    goals = goals.withColumn("whole", F.floor(rate)).withColumn("part", rate - F.floor(rate)).withColumnRenamed("source", "_source")
    of_source = lambda df: df.join(goals, df["source"].eqNullSafe(goals["_source"])).drop("_source")
    decided = decisions(of_source(units).selectExpr("source", "doc_id", "size", "n", "part p"), seed)
    chosen = of_source(decided).select(
        "source", "doc_id", "size", "source_size", "target", "n", (F.col("whole") + F.rint("p")).cast("long").alias("copies"))
    each = chosen.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    return each.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs``, each as often as ``mix`` takes it, with all their columns."""
    plan = mix(docs, **settings).select(
        F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size"), "copies"
    ).groupBy("_id", "_source", "_size").agg(F.max("copies").alias("_copies")).where("_copies > 0")
    sized = docs.withColumn("_words", F.size(words_of(F.col("text"))).cast("long"))
    same = sized["doc_id"].eqNullSafe(plan["_id"]) & sized["source"].eqNullSafe(plan["_source"]) & (sized["_words"] == plan["_size"])
    return sized.join(plan, same).withColumn(
        "_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).select(*[F.col(f"`{c}`") for c in docs.columns])
