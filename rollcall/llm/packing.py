"""Best-fit packing: a configuration linear program over the length histogram, multiplicative weights, rounding."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StructField, StructType
from tokenizers import Tokenizer

from rollcall.llm.store import Kept
from rollcall.llm.text import need

CAPACITY = 2048
END = 0  # id after every document
ROUNDS = 96  # knapsacks solved at most; what is left then goes by best fit
_WORDS, _PARTS = 150_000, 100_000  # words kept with their ids by a worker: a cache, no part of the result
_CHUNK = 1 << 20


class Ids:
    """Token ids of whole texts, worked out word by word and remembered for frequent words.

    The vocabulary drops white space and never joins across it, so the ids of a
    text are those of its words in turn.
    """

    # visible ASCII and the composed letters of Latin-1: normal form is the word itself, and lower case has the same length
    PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
    PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")  # the vocabulary's own split, for these

    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        self.words: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}
        added = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, added)) or "(?!)")
        self.code = [i.to_bytes(4, "little") for i in range(self.whole.get_vocab_size())]
        # the vocabulary's own letters for the bytes of ß to ÿ
        self.letters = {c: self.whole.pre_tokenizer.pre_tokenize_str(chr(c))[0][0] for c in range(0xDF, 0x100)}

    def _part(self, part: str) -> bytes:
        letters = part if part.isascii() else part.translate(self.letters)
        ids = b"".join([self.code[t.id] for t in self.whole.model.tokenize(letters)])
        if len(self.parts) < _PARTS:
            self.parts[part] = ids
        return ids

    def _word(self, word: bytes) -> bytes:
        text = word.decode()
        if self.PLAIN.fullmatch(text) and not self.special.search(text):
            known = self.parts.get
            ids = b"".join([known(p) or self._part(p) for p in self.PIECES.findall(text.lower())])
        else:
            ids = b"".join([self.code[i] for i in self.whole.encode(text, add_special_tokens=False).ids])
        if len(self.words) < _WORDS:
            self.words[word] = ids
        return ids

    def of(self, text: str | None) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of a text, in chunks that end with a word."""
        data, at = (text or "").encode("utf-8", "replace"), 0
        while at < len(data):
            stop = at + _CHUNK
            if stop < len(data):
                gap = re.compile(rb"[\x20\x09-\x0D]").search(data, stop)
                stop = gap.start() if gap else len(data)
            known = self.words.get
            yield b"".join([known(w) or self._word(w) for w in data[at:stop].split()])
            at = stop


_IDS: dict[str, Ids] = {}


def ids_of(path: str) -> Ids:
    if path not in _IDS:
        _IDS[path] = Ids(path)
    return _IDS[path]


def _pieces(path: str, capacity: int, schema: pa.Schema):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, task, ranks, size = ids_of(path), TaskContext.get().partitionId(), Counter(), 4 * capacity

        def row(doc, number: int, piece: bytes) -> tuple:
            n = len(piece) // 4
            ranks[n] += 1
            return doc, number, number * capacity, n, zlib.crc32(piece), task, ranks[n] - 1

        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rest, number = b"", 0
                for chunk in ids.of(text):
                    rest += chunk
                    whole = len(rest) // size * size
                    for at in range(0, whole, size):
                        rows.append(row(doc, number, rest[at:at + size]))
                        number += 1
                    rest = rest[whole:]
                rows.append(row(doc, number, rest + END.to_bytes(4, "little")))
                while len(rows) > 50_000:
                    part, rows = rows[:50_000], rows[50_000:]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), schema.types)], schema=schema)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    return cut


def cheapest(value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knapsack over capacities 0 to len(value) - 1: best total value, and the last length put in (0: none)."""
    capacity = len(value) - 1
    best, last = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for c in range(1, capacity + 1):
        total = best[c - 1::-1] + value[1:c + 1]
        i = c - 1 - int(total[::-1].argmax())  # of equal values the longest piece: short ones fill gaps later
        if total[i] > best[c - 1]:
            best[c], last[c] = total[i], i + 1
        else:
            best[c], last[c] = best[c - 1], -1  # one place stays free
    return best, last


def _fillings(last: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The most valuable configuration around a piece of each length: (row of ``lengths``, length, pieces of it), by row."""
    capacity = len(last) - 1
    room, at = capacity - lengths, np.arange(len(lengths))
    rows, put = [at], [lengths]
    while len(at := at[room[at] > 0]):
        n = last[room[at]]
        rows.append(at[n > 0])
        put.append(n[n > 0])
        room[at] -= np.abs(n)  # -1: one place stays free
    kinds, pieces = np.unique(np.concatenate(rows) * (capacity + 1) + np.concatenate(put), return_counts=True)
    return kinds // (capacity + 1), kinds % (capacity + 1), pieces


def fractional(demand: np.ndarray, rounds: int, eta: float = 2.0, steps: int = 8) -> dict[tuple, float]:
    """A fractional solution: configurations ((lengths), (pieces of each)) with how often each is used.

    Each length has a weight, at first its share of the capacity. A round prices
    configurations by one knapsack over the weights, the best around every length
    still in demand, and uses each as far as no length is used beyond its demand,
    in some steps that share what is left; then weights shrink by exp(-eta * the
    part of the demand met), so that lengths in arrears rise.
    """
    capacity = len(demand) - 1
    left, weight = demand.astype(float), np.arange(capacity + 1) / capacity
    solution: dict[tuple, float] = {}
    for _ in range(rounds):
        live = np.nonzero(left > 1e-3 * demand)[0]
        if not len(live):
            break
        value = np.full(capacity + 1, -np.inf)
        value[live] = weight[live]
        row, length, pieces = _fillings(cheapest(value)[1], live)
        times, before = np.zeros(len(live)), left.copy()
        for _ in range(steps):
            wish = np.full(len(live), np.inf)
            np.minimum.at(wish, row, left[length] / pieces)
            use = np.bincount(length, pieces * wish[row], capacity + 1)
            part = np.ones(len(live))
            np.minimum.at(part, row, left[length] / np.maximum(use[length], 1e-300))
            times += wish * part
            left = np.maximum(left - np.bincount(length, pieces * (wish * part)[row], capacity + 1), 0)
        weight *= np.exp(-eta * (before - left) / np.maximum(demand, 1))
        start = np.searchsorted(row, np.arange(len(live) + 1))
        for i in np.nonzero(times)[0]:
            key = tuple(length[start[i]:start[i + 1]].tolist()), tuple(pieces[start[i]:start[i + 1]].tolist())
            solution[key] = solution.get(key, 0.0) + times[i]
    return solution


def plan(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS) -> Counter:
    """Configurations (sorted lengths of one sequence) with their numbers, covering the histogram.

    The linear program: fewest sequences such that configurations hold every
    length as often as it occurs. Its ``fractional`` solution is rounded down, then
    up, largest fractions first, as far as the demand reaches; pieces that neither
    takes, and those the rounds did not reach, go by best fit.
    """
    demand = np.zeros(capacity + 1, np.int64)
    for n, k in histogram.items():
        demand[n] = k
    left, done = demand.copy(), Counter()
    solution = fractional(demand, rounds)
    for up in (False, True):
        for (lengths, pieces), times in sorted(solution.items(), key=lambda s: (-(s[1] % 1), s[0])):
            most = min(int(left[n]) // k for n, k in zip(lengths, pieces))
            whole = min(most, int(times % 1 > 0) if up else int(times))
            if whole:
                done[tuple(n for n, k in zip(lengths, pieces) for _ in range(k))] += whole
                for n, k in zip(lengths, pieces):
                    left[n] -= k * whole
    return done + best_fit({int(n): int(left[n]) for n in np.nonzero(left)[0]}, capacity)


def best_fit(histogram: dict[int, int], capacity: int = CAPACITY) -> Counter:
    """Longest first, each into the fullest sequence that has room; equal sequences are handled together."""
    room: dict[int, Counter] = {}
    for n in sorted(histogram, reverse=True):
        left = histogram[n]
        while left:
            free = min((f for f in room if f >= n and room[f]), default=None)
            if free is None:
                each = min(capacity // n, left)
                times = left // each
                room.setdefault(capacity - each * n, Counter())[(n,) * each] += times
                left -= each * times
                continue
            filled, times = next(iter(room[free].items()))
            each = min(free // n, left)
            times = min(times, left // each)
            room[free][filled] -= times
            room[free] += Counter()
            if not room[free]:
                del room[free]
            room.setdefault(free - each * n, Counter())[tuple(sorted(filled + (n,) * each))] += times
            left -= each * times
    return sum(room.values(), Counter())


def _runs(configurations: Counter) -> dict[int, np.ndarray]:
    """For every length: rows (first rank, first sequence, pieces a sequence, offset of the first), by rank."""
    runs: dict[int, list] = {}
    given: Counter = Counter()
    sequence = 0
    for lengths, times in sorted(configurations.items()):
        offsets = [0, *accumulate(lengths)]
        for n, k in sorted(Counter(lengths).items()):
            runs.setdefault(n, []).append((given[n], sequence, k, offsets[lengths.index(n)]))
            given[n] += k * times
        sequence += times
    return {n: np.array(r, np.int64) for n, r in runs.items()}


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every document.

    A null or empty text is the end id alone; a null doc_id is passed on; repeated
    rows are packed each. Other columns are not read; no rows give no rows. The
    driver sees one count per length, at most ``capacity`` of them, and sends back
    the plan, in each round at most one configuration per length. A piece's rank among those of its
    length is its place within its task plus the counts of the tasks before, so no
    length is sorted or gathered anywhere, however common.
    """
    docs = need(docs, "doc_id", "text")
    spark, key = docs.sparkSession, docs.schema["doc_id"].dataType
    fields = "piece int, start long, length long, ids_crc32 long, task int, place long"
    schema = StructType([StructField("doc_id", key), *StructType.fromDDL(fields).fields])
    from pyspark.sql.pandas.types import to_arrow_schema

    cut = Kept(docs.mapInArrow(_pieces(tokenizer, capacity, to_arrow_schema(schema)), schema), "pieces").rows
    counts = cut.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = _runs(plan(histogram, capacity))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    ranked = cut.join(firsts, ["length", "task"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("place")).alias("rank"))
    shared = spark.sparkContext.broadcast(runs)
    out = StructType([StructField("doc_id", key), *StructType.fromDDL(
        "piece int, start long, length long, ids_crc32 long, sequence_id long, offset long").fields])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            for n in np.unique(lengths):
                at, run = np.nonzero(lengths == n)[0], shared.value[int(n)]
                r = run[np.searchsorted(run[:, 0], ranks[at], "right") - 1]
                beyond = ranks[at] - r[:, 0]
                sequence[at] = r[:, 1] + beyond // r[:, 2]
                offset[at] = r[:, 3] + beyond % r[:, 2] * n
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(place, out)
