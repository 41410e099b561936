"""SimHash near-duplicates by a hierarchical index over fingerprints in Gray order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from rollcall.llm.components import EDGES, connected, contracted, shortest_forest, smallest_labels
from rollcall.llm.store import Kept
from rollcall.llm.text import need

SEED = 42
SHINGLE = 3
DISTANCE = 2
LEAF = 128  # fingerprints in a leaf of the index; a task receives pairs of leaves
FANOUT = 16  # children of a node
WIDE = 12  # differing bits within a leaf; sets of a Jaccard coefficient of 0.8 differ in about 9.7
TURNS = 4  # Gray orders whose leaves are compared so
PAIRS = "a long, b long, bits int, chunk long"
_HASHES = 1 << 16  # shingle hashes held at once


def fingerprint(text: str | None) -> int:
    """The fingerprint of one text as a signed long; 0 without words."""
    if not text:
        return 0
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    plain = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths) - 1
    starts = ends - lengths + 1
    k = min(SHINGLE, len(words))
    starts, ends = starts[: len(words) - k + 1].tolist(), ends[k - 1:].tolist()
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for i in range(0, len(starts), _HASHES):
        h = np.array([digest(plain[s:e], SEED) for s, e in zip(starts[i:i + _HASHES], ends[i:i + _HASHES])], ">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    bits = (2 * ones > len(starts)).astype(np.uint8)
    return int(np.packbits(bits).view(">i8")[0])


def of_set(hashes: np.ndarray) -> int:
    """The fingerprint, as a signed long, of shingle hashes that were made already; 0 of none."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _HASHES):
        h = hashes[i:i + _HASHES].astype(">i8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits((2 * ones > len(hashes)).astype(np.uint8)).view(">i8")[0])


def with_fingerprint(docs: DataFrame) -> DataFrame:
    @F.pandas_udf("long")
    def of_texts(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t) for t in texts], dtype="int64")

    return docs.withColumn("fp", of_texts(F.col("text")))


def gray_rank(fp: Column) -> Column:
    """Place of a fingerprint in Gray order, as a long whose signed order is that order."""
    rank = fp
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    return rank.bitwiseXOR(F.lit(-(1 << 63)))


def _leaves(leaf: int):
    """Consecutive fingerprints of a sorted task as leaves: members, and the bits all have and any has."""
    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, number, rest = TaskContext.get().partitionId(), 0, np.empty(0, np.int64)

        def row(x: np.ndarray) -> dict:
            return {"task": task, "number": number, "fps": x, "every": np.bitwise_and.reduce(x), "some": np.bitwise_or.reduce(x)}

        for batch in batches:
            rest, out = np.concatenate([rest, batch["fp"].to_numpy(np.int64)]), []
            while len(rest) >= leaf:
                out.append(row(rest[:leaf]))
                number, rest = number + 1, rest[leaf:]
            if out:
                yield pd.DataFrame(out)
        if len(rest):
            yield pd.DataFrame([row(rest)])

    return build


def _compare(distance: int):
    """Links between the members of two leaves, as a forest of each pair of leaves and then of the task."""
    def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for left, right in zip(batch["fps_x"], batch["fps_y"]):
                # as unsigned numbers: of a negative one numpy counts the bits of its amount
                differ = np.bitwise_count(left.view(np.uint64)[:, None] ^ right.view(np.uint64)[None, :])
                i, j = np.nonzero((differ > 0) & (differ <= distance))
                if len(i):
                    ids = np.concatenate([left, right])
                    label = smallest_labels(len(ids), i, j + len(left))
                    yield pd.DataFrame({"a": ids, "b": ids[label]})

    return lambda batches: contracted(links(batches))


def _near(left: np.ndarray, right: np.ndarray, distance: int, chunk: int) -> pd.DataFrame:
    """A shortest forest of the pairs of at most ``distance`` differing bits, one of ``left`` with one of ``right``."""
    differ = np.bitwise_count(left.view(np.uint64)[:, None] ^ right.view(np.uint64)[None, :])
    i, j = np.nonzero((differ > 0) & (differ <= distance))
    a, b, bits = left[i], right[j], differ[i, j].astype(np.int32)
    some = shortest_forest(a, b, bits)
    return pd.DataFrame({"a": a[some], "b": b[some], "bits": bits[some], "chunk": np.full(len(some), chunk)})


def _close(distance: int, limit: int = 1_000_000):
    """Pairs between the members of two leaves: a shortest forest of the task's, or of each ``limit`` or so."""
    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        base, number = TaskContext.get().partitionId() << 40, 0
        found, count = [], 0
        for batch in batches:
            for left, right in zip(batch["fps_x"], batch["fps_y"]):
                found.append(_near(left, right, distance, base + number))
                number, count = number + 1, count + len(found[-1])
                if count > limit:
                    found = [_shortest(found)]
                    count = len(found[0])
                    if count > limit // 2:  # that many fingerprints: pass them on
                        yield found[0]
                        found, count = [], 0
        if found:
            yield _shortest(found)

    return pairs


def _shortest(found: list[pd.DataFrame]) -> pd.DataFrame:
    all_ = pd.concat(found, ignore_index=True)
    return all_.iloc[shortest_forest(all_["a"].to_numpy(), all_["b"].to_numpy(), all_["bits"].to_numpy())]


def _beside(distance: int, leaf: int):
    """Pairs between fingerprints of one leaf, a shortest forest of each; a leaf is ``leaf`` rows of a sorted task in a row."""
    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        base, number, rest = TaskContext.get().partitionId() << 40, 0, np.empty(0, np.int64)
        for batch in batches:
            rest, out = np.concatenate([rest, batch["fp"].to_numpy(np.int64)]), []
            while len(rest) >= leaf:
                out.append(_near(rest[:leaf], rest[:leaf], distance, base + number))
                number, rest = number + 1, rest[leaf:]
            if out:
                yield pd.concat(out, ignore_index=True)
        if len(rest):
            yield _near(rest, rest, distance, base + number)

    return pairs


def near_pairs(fps: DataFrame, distance: int = DISTANCE, wide: int = WIDE, turns: int = TURNS, leaf: int = LEAF) -> DataFrame:
    """Pairs (a, b) of different fingerprints ``fp`` of few differing bits, in how many, and the chunk they were found in.

    Pairs of at most ``distance`` bits, found by the index, join all fingerprints
    that such pairs join. The index cannot pass over much at a wider distance, so
    pairs of up to ``wide`` bits are found within leaves only, in ``turns`` orders:
    Gray order of the fingerprints turned by 0, 64 / turns ... bits, each of which
    puts other near ones side by side. This costs the same a fingerprint, however
    large a group is. What lies in different leaves of every order is left to the
    caller.
    """
    tasks = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    turned = fps.select("fp").distinct().withColumn("turn", F.explode(F.array(*map(F.lit, range(0, 64, 64 // turns)))))
    ordered = turned.withColumn("rank", gray_rank(F.expr("shiftleft(fp, turn) | shiftrightunsigned(fp, 64 - turn)")))
    ordered = ordered.repartitionByRange(tasks, "turn", "rank").sortWithinPartitions("turn", "rank").select("fp")
    beside = ordered.mapInPandas(_beside(wide, leaf), PAIRS)
    return _near_leaves(fps, distance, leaf).mapInPandas(_close(distance), PAIRS).union(beside)


def near_fingerprints(fps: DataFrame, distance: int = DISTANCE, leaf: int = LEAF) -> DataFrame:
    """Links (a, b) that join all fingerprints ``fp`` of at most ``distance`` differing bits, not every pair."""
    return _near_leaves(fps, distance, leaf).mapInPandas(_compare(distance), EDGES)


def _near_leaves(fps: DataFrame, distance: int, leaf: int) -> DataFrame:
    """Members (fps_x, fps_y) of the pairs of leaves that may hold fingerprints ``fp`` of at most ``distance`` differing bits.

    The different fingerprints are sorted in Gray order and cut into leaves; above
    them stand nodes of up to 16 children. A node keeps the bit pattern that all
    fingerprints below it share. Pairs of nodes are followed from the root
    downwards, level by level: where the patterns of two nodes differ in more than
    ``distance`` shared bits, no pair below can link and both subtrees are passed
    over together. Children are found by joins on their parent.
    """
    spark = fps.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = fps.select("fp").distinct().withColumn("rank", gray_rank(F.col("fp")))
    ordered = ordered.repartitionByRange(tasks, "rank").sortWithinPartitions("rank").select("fp")
    leaves = Kept(ordered.mapInPandas(
        _leaves(leaf), "task int, number long, fps array<long>, every long, some long"), "gray-leaves").rows
    top = leaves.agg(F.max("number"), F.max("task")).first()
    wide, depth = 1, 0
    while top[0] is not None and wide <= top[0]:
        wide *= FANOUT
    while top[0] is not None and FANOUT ** depth < wide * (top[1] + 1):
        depth += 1
    numbered = leaves.withColumn("node", F.col("task").cast("long") * wide + F.col("number"))
    pairs = spark.createDataFrame([(0, 0)], "x long, y long")
    for level in range(depth - 1, -1, -1):
        nodes = numbered.groupBy(F.floor(F.col("node") / FANOUT ** level).cast("long").alias("node")).agg(
            F.bit_and("every").alias("every"), F.bit_or("some").alias("some"))
        nodes = nodes.select("node", F.floor(F.col("node") / FANOUT).cast("long").alias("parent"), "every", "some")
        left = nodes.selectExpr("parent x", "node nx", "every ex", "some sx")
        right = nodes.selectExpr("parent y", "node ny", "every ey", "some sy")
        shared = "bit_count((ex ^ ey) & ~(ex ^ sx) & ~(ey ^ sy))"
        pairs = Kept(
            pairs.join(left, "x").join(right, "y").where(f"nx <= ny and {shared} <= {distance}").selectExpr("nx x", "ny y"),
            "gray-pairs").rows
    members = numbered.select("node", "fps")
    return (
        pairs.join(members.selectExpr("node x", "fps fps_x"), "x").join(members.selectExpr("node y", "fps fps_y"), "y")
        .select("fps_x", "fps_y")
    )


def near_duplicates(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fp, component_id): fingerprints and the smallest doc_id that links lead to.

    A null or wordless text has fingerprint 0 and links like any other. Equal
    fingerprints are one node of the search, so a huge group of copies costs one
    row there. Rows with a null doc_id get a fingerprint and a component, but name
    none, unless no row of theirs has an id (null). Repeated rows get equal
    results. Other columns are not read; no rows give no rows.
    """
    prints = Kept(with_fingerprint(need(docs, "doc_id", "text")).select("doc_id", "fp"), "fingerprints").rows
    different = Kept(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprints").rows
    roots = connected(near_fingerprints(different, distance), reduced=True)
    placed = different.join(roots, different["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = Kept(placed.groupBy("root").agg(F.min("first").alias("component_id")), "fingerprints").rows
    of_print = Kept(placed.join(smallest, "root").select("fp", "component_id"), "fingerprints").rows
    return prints.join(of_print, "fp").select("doc_id", "fp", "component_id")
