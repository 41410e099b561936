"""Connected components over links between long ids."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from rollcall.llm.store import Kept

EDGES = "a long, b long"


def smallest_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0 to n - 1 the smallest node that links (a[i], b[i]) lead to."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:  # follow the labels to their ends
            further = label[label]
            if np.array_equal(further, label):
                break
            label = further
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    return label


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewer links with the same components: each id beside the smallest of its component."""
    if not len(a):
        return a, b
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    label = smallest_labels(len(ids), at[: len(a)], at[len(a):])
    moved = label != np.arange(len(ids))
    return ids[moved], ids[label[moved]]


def shortest_forest(a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Places of the links of a shortest spanning forest: some of the links (a[i], b[i]), with the same components."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a):]
    label, open_, taken = np.arange(len(ids)), np.lexsort((y, x, length)), [np.empty(0, np.int64)]
    while len(open_ := open_[label[x[open_]] != label[y[open_]]]):
        p, q = label[x[open_]], label[y[open_]]
        best = np.full(len(ids), len(open_))  # the first open link of each component; places break ties, so no circle arises
        np.minimum.at(best, p, np.arange(len(open_)))
        np.minimum.at(best, q, np.arange(len(open_)))
        first = np.unique(best[best < len(open_)])
        taken.append(open_[first])
        label = smallest_labels(len(ids), p[first], q[first])[label]
    return np.concatenate(taken)


def contracted(batches: Iterator[pd.DataFrame], limit: int = 1_000_000) -> Iterator[pd.DataFrame]:
    """The links of one task as forests, each of at most about ``limit`` links before it is reduced."""
    a, b = np.empty(0, np.int64), np.empty(0, np.int64)
    for batch in batches:
        a = np.concatenate([a, batch["a"].to_numpy(np.int64)])
        b = np.concatenate([b, batch["b"].to_numpy(np.int64)])
        if len(a) > limit:
            a, b = forest(a, b)
            if len(a) > limit:  # that many components: pass them on
                yield pd.DataFrame({"a": a, "b": b})
                a, b = a[:0], b[:0]
    a, b = forest(a, b)
    yield pd.DataFrame({"a": a, "b": b})


def _beside_smallest(links: DataFrame) -> tuple[DataFrame, Kept]:
    """(u, v, m): links with the smallest v of their u.

    The smallest are written first, so that the join reads two plain shuffles and
    Spark can split a hub's rows over several tasks.
    """
    smallest = Kept(links.groupBy("u").agg(F.min("v").alias("m")), "components")
    return links.join(smallest.rows, "u"), smallest


def connected(edges: DataFrame, most_rounds: int = 60, reduced: bool = False) -> DataFrame:
    """(node, root): every node of a link beside the smallest node of its component.

    Links are reduced inside each task first, unless ``reduced`` says that the
    tasks that made them did so: a second Python step in one task would hold a
    second worker. Then large-star and small-star rounds alternate until nothing
    changes, each a grouped minimum and a join. Self-links, repeated links and
    links with null are ignored.
    """
    clean = edges.where("a is not null and b is not null and a <> b").select("a", "b")
    now = Kept((clean if reduced else clean.mapInPandas(contracted, EDGES)).distinct(), "components")
    mark = None
    for _ in range(most_rounds):
        both = now.rows.selectExpr("a u", "b v").union(now.rows.selectExpr("b u", "a v"))
        joined, one = _beside_smallest(both)
        large = Kept(joined.where("v > u").selectExpr("v a", "least(u, m) b").distinct(), "components")
        joined, two = _beside_smallest(large.rows.selectExpr("a u", "b v"))
        stars = joined.selectExpr("v a", "m b").union(joined.selectExpr("u a", "m b")).where("a <> b").distinct()
        new = Kept(stars, "components")
        for old in (now, one, large, two):
            old.drop()
        now = new
        r = now.rows.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if tuple(r) == mark:
            break
        mark = tuple(r)
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return now.rows.selectExpr("a node", "b root").union(now.rows.selectExpr("b node", "b root")).distinct()
