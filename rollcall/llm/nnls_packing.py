"""Packing by non-negative least squares: shallow combinations of lengths that fill a window, solved against the histogram."""

from __future__ import annotations

import json
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StructField, StructType
from tokenizers import Tokenizer

from rollcall.llm.store import Kept
from rollcall.llm.text import need

CAPACITY = 1024
END = 0  # id after every document
DEEPEST = 16  # copies of one length in a combination at most
_CHUNK = 1 << 20  # characters that are split into ids at once
_ROWS = 4_096  # rows handed on at once

# The split that byte-level vocabularies of this form state by "use_regex": fixed value.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
GAP = re.compile(r"(?<=\S) (?=\S)")  # no piece of that split goes on across the start of such a blank


# --- ids -----------------------------------------------------------------------------

def _letters() -> dict[str, int]:
    """The visible letters that byte-level vocabularies write for bytes."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Ids:
    """Token ids of whole texts by a tokenizer file, special tokens included where their strings occur.

    A plain byte-level vocabulary whose ids grow with the order of its merges is
    read as ranks, which are several times faster and give the same ids. A file of
    any other form is left to its own library.
    """

    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        self.ranks = self._ranks(json.loads(self.whole.to_str()))

    @staticmethod
    def _ranks(form: dict) -> tiktoken.Encoding | None:
        split, model, added = form["pre_tokenizer"] or {}, form["model"], form["added_tokens"]
        plain = (
            form["normalizer"] is None and form["post_processor"] is None and form["truncation"] is None and form["padding"] is None
            and split.get("type") == "ByteLevel" and not split["add_prefix_space"] and split["use_regex"] and model["type"] == "BPE"
            and not any(model[k] for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added)
        )
        if not plain:
            return None
        byte, vocabulary = _letters(), dict(model["vocab"])
        for t in added:
            vocabulary.pop(t["content"], None)
        merged = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if merged != list(range(256, 256 + len(merged))) or len(vocabulary) != 256 + len(merged):
            return None
        return tiktoken.Encoding(
            "ranks", pat_str=SPLIT, mergeable_ranks={bytes(byte[c] for c in t): i for t, i in vocabulary.items()},
            special_tokens={t["content"]: t["id"] for t in added})

    def _of(self, text: str) -> np.ndarray:
        if self.ranks:
            return self.ranks.encode_to_numpy(text, allowed_special="all")
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)

    def of(self, text: str) -> Iterator[np.ndarray]:
        """The ids of a text in chunks; a long text of ranks is cut only where no piece of its split goes on."""
        at = 0
        while self.ranks and len(text) - at > _CHUNK:
            gap = GAP.search(text, at + _CHUNK)
            if not gap:
                break
            yield self._of(text[at:gap.start()])
            at = gap.start()
        yield self._of(text[at:])


_IDS: dict[str, Ids] = {}


def ids_of(path: str) -> Ids:
    if path not in _IDS:
        _IDS[path] = Ids(path)
    return _IDS[path]


def _windows(path: str, capacity: int, schema: pa.Schema):
    """Documents as full windows and a rest each, with the place of each among its task's pieces of that length.

    The ids of a rest are kept, since it may be cut again; those of a full window are not.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, task, places = ids_of(path), TaskContext.get().partitionId(), Counter()
        rows: list[tuple] = []

        def flushed() -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)]
            rows.clear()
            return pa.RecordBatch.from_arrays(columns, schema=schema)

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums, rest, start = [], b"", 0
                for chunk in ids.of((text or b"").decode("utf-8", "replace")):
                    rest += chunk.astype("<u4").tobytes()
                    whole = len(rest) // (4 * capacity) * (4 * capacity)
                    sums += [zlib.crc32(rest[at:at + 4 * capacity]) for at in range(0, whole, 4 * capacity)]
                    rest = rest[whole:]
                rest += END.to_bytes(4, "little")
                total = len(sums) * capacity + len(rest) // 4
                if len(rest) == 4 * capacity:
                    sums, rest = [*sums, zlib.crc32(rest)], b""
                for crc in sums:
                    rows.append((doc, start, capacity, crc, total, task, places[capacity], None))
                    places[capacity] += 1
                    start += capacity
                    if len(rows) == _ROWS:
                        yield flushed()
                if rest:
                    n = len(rest) // 4
                    rows.append((doc, start, n, zlib.crc32(rest), total, task, places[n], rest))
                    places[n] += 1
                    if len(rows) >= _ROWS:
                        yield flushed()
        if rows:
            yield flushed()

    return cut


# --- combinations and their repeat counts ------------------------------------------------

def combinations_of(present: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Shallow combinations of present lengths whose sum is the capacity: lengths and how often each, three columns.

    One or two lengths, three lengths, and up to ``DEEPEST`` copies of one length
    beside one other. Unused columns have length 0.
    """
    has = np.zeros(capacity + 1, bool)
    has[present] = True
    n = np.arange(1, capacity)
    pair = n[(n <= capacity - n) & has[n] & has[capacity - n]]
    parts = [np.stack([pair, capacity - pair, 0 * pair], 1)]
    times = [np.tile([1, 1, 0], (len(pair), 1))]
    for a in n[(3 * n <= capacity) & has[n]]:
        b = np.arange(a, (capacity - a) // 2 + 1)
        b = b[has[b] & has[capacity - a - b]]
        parts.append(np.stack([np.full(len(b), a), b, capacity - a - b], 1))
        times.append(np.ones((len(b), 3), np.int64))
    for k in range(3, DEEPEST + 1):
        a = n[(k * n < capacity) & has[n]]
        a = a[has[capacity - k * a]]
        parts.append(np.stack([a, capacity - k * a, 0 * a], 1))
        times.append(np.tile([k, 1, 0], (len(a), 1)))
    return np.concatenate(parts), np.concatenate(times)


def _met(lengths: np.ndarray, times: np.ndarray, x: np.ndarray, capacity: int) -> np.ndarray:
    """Pieces of every length that combinations use when each is repeated ``x`` times."""
    return np.bincount(lengths.ravel(), (times * x[:, None]).ravel(), capacity + 1)


def _descended(lengths: np.ndarray, times: np.ndarray, demand: np.ndarray, x: np.ndarray, steps: int) -> np.ndarray:
    """Accelerated projected gradient on the squared difference of pieces used and pieces there."""
    capacity = len(demand) - 1
    v = np.ones(len(x))
    for _ in range(15):  # the largest curvature, for the step
        v /= np.linalg.norm(v)
        v = (times * _met(lengths, times, v, capacity)[lengths]).sum(1)
    step, y, t = 1 / (1.05 * np.linalg.norm(v) + 1e-12), x, 1.0
    for _ in range(steps):
        slope = (times * (_met(lengths, times, y, capacity) - demand)[lengths]).sum(1)
        new = np.maximum(0, y - step * slope)
        if np.dot(slope, new - x) > 0:
            t = 1.0  # start the momentum anew
        later = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y, x, t = new + (t - 1) / later * (new - x), new, later
    return x


def repeat_counts(
    lengths: np.ndarray, times: np.ndarray, demand: np.ndarray, rounds: int = 12, steps: int = 250,
) -> tuple[np.ndarray, np.ndarray]:
    """(rows, repeats): non-negative least squares of combinations against the demand of every length.

    A working set grows by the steepest combination of every length that is still
    short; the rest of the combinations stay at zero. It ends when none outside the
    set would lower the difference, or after ``rounds``.
    """
    capacity = len(demand) - 1
    demand = np.where(np.arange(capacity + 1) > 0, demand, 0).astype(float)
    chosen, x = np.empty(0, np.int64), np.empty(0)
    size = np.sqrt((times * times).sum(1))
    for _ in range(rounds):
        short = demand - _met(lengths[chosen], times[chosen], x, capacity)
        short[0] = 0
        gain = (times * short[lengths]).sum(1) / size
        if len(gain) == 0 or gain.max() <= 0.25:
            break
        order = np.argsort(gain, kind="stable")
        best = np.full(capacity + 1, -1)
        for column in range(lengths.shape[1]):
            best[lengths[order, column]] = np.where(
                gain[order] >= gain[best[lengths[order, column]]], order, best[lengths[order, column]])
        best[0] = -1
        fresh = np.unique(best[best >= 0])
        fresh = np.setdiff1d(fresh[gain[fresh] > 0.25], chosen)
        if not len(fresh):
            break
        chosen, x = np.concatenate([chosen, fresh]), np.concatenate([x, np.zeros(len(fresh))])
        x = _descended(lengths[chosen], times[chosen], demand, x, steps)
        chosen, x = chosen[x > 1e-6], x[x > 1e-6]
    return chosen, x


# --- the plan ----------------------------------------------------------------------------

class Plan:
    """Where the pieces of each length go, by their rank among equals: rows of ranks that share one rule."""

    def __init__(self, histogram: dict[int, int], capacity: int):
        self.capacity, self.sequences = capacity, 0
        # pieces that wait, by length: (length before any cut, start in it, first rank, how many)
        self.waiting: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
        self.count = np.zeros(capacity + 1, np.int64)
        # by (length before any cut, start): (first rank, how many, length, first sequence, place of the first, pieces a sequence, offset)
        self.rules: dict[tuple[int, int], list[tuple[int, ...]]] = defaultdict(list)
        for n, k in histogram.items():
            self._add(n, (n, 0, 0, k))

    def _add(self, n: int, lot: tuple[int, int, int, int]) -> None:
        self.waiting[n].append(lot)
        self.count[n] += lot[3]

    def _take(self, n: int, many: int) -> Iterator[tuple[int, int, int, int]]:
        self.count[n] -= many
        while many:
            origin, start, rank, k = self.waiting[n].pop()
            used = min(k, many)
            if used < k:
                self.waiting[n].append((origin, start, rank + used, k - used))
            many -= used
            yield origin, start, rank, used

    def use(self, lengths: list[tuple[int, int]], repeat: int, cut: tuple[int, int] | None = None) -> None:
        """``repeat`` sequences, each of ``k`` pieces of ``n`` for (n, k) in ``lengths``, then the first ``cut[1]`` ids of a piece of ``cut[0]``."""
        offset = 0
        for n, k in lengths:
            done = 0
            for origin, start, rank, used in self._take(n, k * repeat):
                self.rules[origin, start].append((rank, used, n, self.sequences, done, k, offset))
                done += used
            offset += n * k
        if cut:
            n, part = cut
            done = 0
            for origin, start, rank, used in list(self._take(n, repeat)):
                self.rules[origin, start].append((rank, used, part, self.sequences, done, 1, offset))
                self._add(n - part, (origin, start + part, rank, used))
                done += used
        self.sequences += repeat

    def greedy(self) -> None:
        """Longest pieces first, each gap filled with the longest that fit; a gap that is left takes the head of one more piece.

        So every sequence but the last is full. What is left then is dealt to
        sequences whose lengths are powers of two, which need no padding either.
        """
        sizes = np.arange(self.capacity + 1)
        while left := int((self.count * sizes).sum()):
            room = self.capacity if left >= self.capacity else 1 << (left.bit_length() - 1)
            free, gap, used = self.count.copy(), room, []
            while gap:
                fits = np.nonzero(free[:gap + 1])[0]
                if not len(fits):
                    break
                n = int(fits[-1])
                k = min(gap // n, int(free[n]))
                used.append((n, k))
                free[n] -= k
                gap -= n * k
            cut = (gap + int(np.nonzero(free[gap:])[0][0]), gap) if gap else None
            spent = Counter(dict(used)) + Counter({cut[0]: 1} if cut else {})
            self.use(used, min(left // room, *(int(self.count[n]) // k for n, k in spent.items())), cut)

    def tables(self) -> dict[tuple[int, int], np.ndarray]:
        return {k: np.array(sorted(v), np.int64) for k, v in self.rules.items()}


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[Plan, int]:
    """A plan for all pieces of the histogram, and how many pieces the combinations left to the greedy step.

    Repeats are rounded down, then up by one in the order of what was lost, as far
    as there are pieces.
    """
    out = Plan(histogram, capacity)
    if histogram.get(capacity):
        out.use([(capacity, 1)], histogram[capacity])
    short = {n: k for n, k in histogram.items() if n < capacity and k}
    if short:
        lengths, times = combinations_of(np.array(sorted(short)), capacity)
        rows, x = repeat_counts(lengths, times, out.count)
        order = np.argsort(np.floor(x) - x, kind="stable")
        for more, at in ((0, np.argsort(-x, kind="stable")), (1, order)):
            for i in at:
                c = Counter()
                for n, k in zip(lengths[rows[i]].tolist(), times[rows[i]].tolist()):
                    c[n] += k
                c = +c
                c.pop(0, None)
                repeat = min(1 if more else int(x[i]), *(int(out.count[n]) // k for n, k in c.items()))
                if repeat > 0:
                    out.use(sorted(c.items()), repeat)
    rest = int(out.count.sum())
    out.greedy()
    return out, rest


# --- the operator --------------------------------------------------------------------------

def _placed(shared, names: list[str]):
    """Every part of every piece at its place; ``ids_crc32`` is null for parts of a piece that is cut."""
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = shared.value
        for batch in batches:
            lengths, ranks = batch.column("piece").to_numpy(), batch.column("rank").to_numpy()
            at, cut, size, sequence, offset = [], [], [], [], []
            for n in np.unique(lengths).tolist():
                waiting, start = np.nonzero(lengths == n)[0], np.zeros(int((lengths == n).sum()), np.int64)
                while len(waiting):
                    later, later_start = [], []
                    for s in np.unique(start).tolist():
                        rows, rule = waiting[start == s], rules[n, s]
                        r = rule[np.searchsorted(rule[:, 0], ranks[rows], "right") - 1]
                        place_ = r[:, 4] + ranks[rows] - r[:, 0]
                        at.append(rows)
                        cut.append(np.full(len(rows), s))
                        size.append(r[:, 2])
                        sequence.append(r[:, 3] + place_ // r[:, 5])
                        offset.append(r[:, 6] + place_ % r[:, 5] * r[:, 2])
                        more = s + r[:, 2] < n
                        later.append(rows[more])
                        later_start.append(s + r[more, 2])
                    waiting, start = np.concatenate(later), np.concatenate(later_start)
            if not at:
                continue
            at, cut, size, sequence, offset = map(np.concatenate, (at, cut, size, sequence, offset))
            own = batch.take(pa.array(at))
            whole = size == own.column("piece").to_numpy()
            found = {name: own.column(name) for name in ("doc_id", "doc_tokens", "piece", "task", "place")} | {
                "start": pa.array(own.column("start").to_numpy() + cut), "length": pa.array(size), "cut": pa.array(cut),
                "ids_crc32": pa.array(own.column("ids_crc32").to_numpy(), mask=~whole),
                "sequence_id": pa.array(sequence), "offset": pa.array(offset)}
            yield pa.RecordBatch.from_arrays([found[n] for n in names], names=names)

    return place


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of every piece of every document.

    A null or empty text is the end id alone; a null doc_id is passed on; repeated
    rows are packed each. Other columns are not read; no rows give no rows. Invalid
    UTF-8 is read with replacement characters. Documents longer than a sequence
    are cut into full ones and a rest. Of the pieces left, shallow combinations
    fill sequences whole; only what rounding leaves over is cut further, at most
    one piece a sequence, so that no sequence needs padding: each is full, or, of
    the last few, as long as a power of two.

    The driver sees one count per length, at most ``capacity``, and sends back the
    plan, a few rows per combination used. A piece's rank among those of its length
    is its place within its task plus the counts of the tasks before, so no length
    is sorted or gathered anywhere, however common. The ids of rests are written
    once, and only those of the pieces cut are read again.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark, key = docs.sparkSession, docs.schema["doc_id"].dataType
    texts = need(docs, "doc_id", "text").select("doc_id", F.col("text").cast("binary"))
    made = StructType([StructField("doc_id", key), *StructType.fromDDL(
        "start long, piece int, ids_crc32 long, doc_tokens long, task int, place long, ids binary").fields])
    pieces = Kept(texts.mapInArrow(_windows(tokenizer, capacity, to_arrow_schema(made)), made), "windows").rows
    counts = pieces.groupBy("piece", "task").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["piece"]: r["n"] for r in counts.groupBy("piece").agg(F.sum("n").alias("n")).collect()}
    shared = spark.sparkContext.broadcast(plan(histogram, capacity)[0].tables())
    before = Window.partitionBy("piece").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("piece", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    ranked = pieces.drop("ids").join(firsts, ["piece", "task"]).withColumn("rank", F.col("first") + F.col("place")).drop("first")
    out = StructType([StructField("doc_id", key), *StructType.fromDDL(
        "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
        "piece int, task int, place long, cut long").fields])
    placed = Kept(ranked.mapInArrow(_placed(shared, out.names), out), "placed").rows
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    ids = pieces.where("ids is not null").select("piece", "task", "place", "ids")
    crc = F.crc32(F.substring("ids", (4 * F.col("cut") + 1).cast("int"), (4 * F.col("length")).cast("int")))
    parts = placed.where("ids_crc32 is null").join(ids, ["piece", "task", "place"]).withColumn("ids_crc32", crc)
    return placed.where("ids_crc32 is not null").select(*names).unionByName(parts.select(*names))

