"""Embedding near-duplicates: collision counts over many sorted one-dimensional projections, verified by cosine."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product
from math import comb, erf, sqrt

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from rollcall.llm.components import connected, contracted, smallest_labels
from rollcall.llm.store import Kept
from rollcall.llm.text import need

COSINE = 0.98
PROJECTIONS = 24
RECALL = 0.9995  # of the count alone, for a pair just at the threshold
HALF_WIDTH = 2.0  # of a window, in deviations of the projected distance of such a pair
CELL = 4.0  # width of a cell in the same measure: a pair farther apart in one projection is 1 in 16,000
BLOCK = 512
DENSE = 2_048  # vectors a cell should hold, before one more projection is cut into cells
SEED = 7


def directions(dim: int, m: int = PROJECTIONS, seed: int = SEED) -> np.ndarray:
    """Up to ``m`` orthonormal directions, the same for all tasks and runs."""
    q, _ = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return np.ascontiguousarray(q[:, : min(m, dim)])


def windows(dim: int, cosine: float, m: int = PROJECTIONS, recall: float = RECALL) -> tuple[float, float, int]:
    """Half width of a window, width of a cell, and the collisions a pair needs.

    A pair at the threshold is sqrt(2 - 2 cosine) apart, and no projection can
    part it farther. Its projected distance is about normal with that over
    sqrt(dim) as deviation. The count is the largest that such a pair reaches
    with probability ``recall``.
    """
    apart, m = sqrt(max(0.0, 2 - 2 * cosine)) + 1e-9, min(m, dim)
    half, cell = min(HALF_WIDTH * apart / sqrt(dim), apart), min(CELL * apart / sqrt(dim), apart)
    hit = 1.0 if half == apart else erf(half * sqrt(dim) / apart / sqrt(2))
    tail, needed = 0.0, m + 1
    while tail < recall and needed > 0:
        needed -= 1
        tail += comb(m, needed) * hit ** needed * (1 - hit) ** (m - needed)
    return half, cell, needed


def _projected(cosine: float, cut: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cells, first = [], []
            for v in batch["embedding"]:
                x = np.asarray(v, float)
                p = (x / np.linalg.norm(x)) @ directions_of(len(x))
                cells.append(np.floor(p[:cut] / windows(len(x), cosine)[1]).astype(np.int32).tolist())
                first.append(float(p[min(cut, len(p) - 1)]))
            yield batch.assign(cells=cells, first=first)[["label", "dim", "cells", "first", "node", "n", "embedding"]]

    return run


_DIRECTIONS: dict[int, np.ndarray] = {}


def directions_of(dim: int) -> np.ndarray:
    if dim not in _DIRECTIONS:
        _DIRECTIONS[dim] = directions(dim)
    return _DIRECTIONS[dim]


def _blocks(size: int):
    """Consecutive vectors of a sorted task and of one cell, as blocks of at most ``size``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, key, held = TaskContext.get().partitionId() << 32, None, []

        def block() -> dict:
            return {"block": number, "label": key[0], "dim": key[1], "cells": list(key[2]), "nodes": [h[0] for h in held],
                    "ns": [h[1] for h in held], "vectors": np.array([h[2] for h in held], "<f8").tobytes()}

        for batch in batches:
            out = []
            for label, dim, cells, node, n, v in zip(*(batch[c] for c in ("label", "dim", "cells", "node", "n", "embedding"))):
                now = (label, dim, tuple(cells))
                if held and (now != key or len(held) == size):
                    out.append(block())
                    number, held = number + 1, []
                key = now
                held.append((node, n, v))
            if out:
                yield pd.DataFrame(out)
        if held:
            yield pd.DataFrame([block()])

    return run


def collisions(queries: np.ndarray, points: np.ndarray, half: float) -> np.ndarray:
    """For every query and point the projections in which the point lies in the window centred on the query."""
    counts = np.zeros((len(queries), len(points)), np.int16)
    rows = np.arange(len(queries))
    for j in range(queries.shape[1]):
        order = np.argsort(points[:, j], kind="stable")
        line = points[order, j]
        steps = np.zeros((len(queries), len(points) + 1), np.int16)
        np.add.at(steps, (rows, np.searchsorted(line, queries[:, j] - half, "left")), 1)
        np.add.at(steps, (rows, np.searchsorted(line, queries[:, j] + half, "right")), -1)
        counts[:, order] += np.cumsum(steps[:, :-1], axis=1, dtype=np.int16)
    return counts


def _linked(cosine: float):
    """Of pairs of blocks: how many vectors each vector links with (kind 0), and links that keep components (kind 1)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        edges = []
        for batch in batches:
            for r in batch.itertuples(index=False):
                x = np.frombuffer(r.vectors_x, "<f8").reshape(-1, r.dim)
                y = np.frombuffer(r.vectors_y, "<f8").reshape(-1, r.dim)
                nx, ny = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
                half, _, needed = windows(r.dim, cosine)
                d = directions_of(r.dim)
                i, j = np.nonzero(collisions((x / nx[:, None]) @ d, (y / ny[:, None]) @ d, half + 1e-9) >= needed)
                if r.block_x == r.block_y:
                    i, j = i[i < j], j[i < j]
                near = np.zeros(len(i), bool)
                for at in range(0, len(i), 1 << 15):
                    a, b = i[at:at + (1 << 15)], j[at:at + (1 << 15)]
                    near[at:at + (1 << 15)] = np.einsum("ij,ij->i", x[a], y[b]) / (nx[a] * ny[b]) >= cosine
                i, j = i[near], j[near]
                if not len(i):
                    continue
                nodes = np.concatenate([r.nodes_x, r.nodes_y])
                links = np.zeros(len(nodes), np.int64)
                np.add.at(links, i, np.asarray(r.ns_y)[j])
                np.add.at(links, j + len(x), np.asarray(r.ns_x)[i])
                hit = links > 0
                yield pd.DataFrame({"kind": 0, "a": nodes[hit], "b": links[hit]})
                label = smallest_labels(len(nodes), i, j + len(x))
                edges.append(pd.DataFrame({"a": nodes, "b": nodes[label]}))
                if len(edges) > 500:
                    edges = list(contracted(iter(edges)))
        for e in contracted(iter(edges)):
            yield e.assign(kind=1)[["kind", "a", "b"]]

    return run


def near_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors`` (vec_id, embedding, label).

    Vectors of one label and length link at a cosine of ``cosine`` or more in
    double precision. Null labels, and vectors that are null, empty, zero or hold
    null or non-finite components link with nothing. Equal vectors are one node of
    the search, so a huge group of copies costs one row. Null ids are counted as
    links but name no component, and are not kept; repeated rows count each. Other
    columns are not read; no rows give no rows.

    Vectors of a label are dealt to cells of a few projections and blocks of 512;
    blocks of the same and of neighbouring cells meet by a join on the cell. For
    two blocks every projection is sorted, the window around each query is found
    in it, and pairs with enough collisions are verified by their cosine. As a
    label grows, more projections are cut into cells.
    """
    spark = vectors.sparkSession
    rows = need(vectors, "vec_id", "embedding", "label")
    fine = F.col("label").isNotNull() & (F.size("embedding") > 0) & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    valid = rows.where(fine).withColumn("label", F.col("label").cast("long"))
    nodes = Kept(valid.groupBy("label", "embedding").agg(
        F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("first")
    ).withColumn("dim", F.size("embedding")).withColumn("node", F.monotonically_increasing_id()), "vectors").rows
    largest = nodes.groupBy("label").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    shortest = nodes.agg(F.min("dim")).first()[0] or 1
    cut = 0
    while cut < min(6, shortest) and largest > DENSE * 6 ** cut:
        cut += 1
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    floats = nodes.withColumn("embedding", F.col("embedding").cast("array<double>"))
    dealt = floats.select("label", "dim", "node", "n", "embedding").mapInPandas(
        _projected(cosine, cut), "label long, dim int, cells array<int>, first double, node long, n long, embedding array<double>")
    order = ["label", "dim", "cells", "first"]
    blocks = Kept(dealt.repartitionByRange(tasks, *order).sortWithinPartitions(*order).mapInPandas(
        _blocks(BLOCK), "block long, label long, dim int, cells array<int>, nodes array<long>, ns array<long>, vectors binary"),
        "vector-blocks").rows
    shifts = F.array(*[F.array(*[F.lit(s) for s in o]).cast("array<int>") for o in product((-1, 0, 1), repeat=cut)])
    place = blocks.select("block", "label", "dim", "cells")
    around = place.select(F.col("block").alias("block_x"), "label", "dim", F.explode(shifts).alias("o"), "cells").select(
        "block_x", "label", "dim", F.zip_with("cells", "o", lambda c, s: c + s).alias("cells"))
    pairs = around.join(place.withColumnRenamed("block", "block_y"), ["label", "dim", "cells"]).where(
        "block_x <= block_y").select("block_x", "block_y")
    side = lambda s: blocks.select(F.col("block").alias(f"block_{s}"), *([] if s == "y" else ["dim"]), *[
        F.col(c).alias(f"{c}_{s}") for c in ("nodes", "ns", "vectors")])
    found = Kept(pairs.join(side("x"), "block_x").join(side("y"), "block_y").repartition(4 * tasks).mapInPandas(
        _linked(cosine), "kind int, a long, b long"), "vector-links").rows
    links = found.where("kind = 0").groupBy(F.col("a").alias("node")).agg(F.sum("b").alias("links"))
    roots = connected(found.where("kind = 1"))
    placed = nodes.join(links, "node", "left").join(roots, "node", "left").select(
        "label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("root", "node").alias("root"), "first")
    placed = Kept(placed, "vectors").rows
    smallest = Kept(placed.groupBy("root").agg(F.min("first").alias("component_id")), "vectors").rows
    known = Kept(placed.join(smallest, "root").select("label", "embedding", "n_links", "component_id"), "vectors").rows
    linked = valid.join(known, ["label", "embedding"]).select("vec_id", "n_links", F.col("component_id").cast("long"))
    alone = rows.where(~F.coalesce(fine, F.lit(False))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").cast("long").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
