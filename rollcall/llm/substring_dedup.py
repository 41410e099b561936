"""Substring dedup: word windows that also start earlier are removed; a count-min prefilter finds them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

WINDOW = 20
ROWS = 2  # rows of the sketch; a window's estimate is the smallest of its counters
ROOM = 4  # counters of a sketch row for each window of the corpus
BUCKETS_PER_TASK = 2  # so that hashing deals them out evenly enough
_SLICE = 1 << 16  # windows looked up at once
_TEXTS = 256  # texts put together at once
DIGEST = 12  # bytes that name a window in the exact pass, beside its shard
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


# --- packed columns of sorted numbers ---------------------------------------------------------------------------

def packed(x: np.ndarray) -> bytes:
    """Ascending numbers as the bytes of their differences, plane by plane, compressed."""
    gaps = np.diff(x.astype(np.uint64), prepend=np.uint64(0))
    width = 4 if not len(gaps) or gaps.max() < 1 << 32 else 8
    planes = gaps.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T
    return bytes([width]) + zstandard.compress(np.ascontiguousarray(planes).tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data[1:]), np.uint8).reshape(data[0], -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(f"<u{data[0]}").ravel().astype(np.uint64))


# --- words and windows of a bucket of documents -----------------------------------------------------------------

class Bucket:
    """The documents of one bucket in their order, and the hashes of their windows.

    Texts stay in the Arrow columns they came in, in the order they came; a pass
    takes one after another out of them.
    """

    def __init__(self, table: pa.Table, window: int, hashes: bool = True):
        self.window, self.table = window, table
        self.order = pc.sort_indices(table.select(["doc_id", "text"]), [("doc_id", "ascending"), ("text", "ascending")],
                                     null_placement="at_end")
        self._rows, self._column = self.order.to_numpy(), table["text"]
        self.ids = table["doc_id"].take(self.order).to_pylist()
        self.counts = np.zeros(len(self.ids), np.int64)
        # no text has more words than half its bytes; pages never written to take no memory
        room = (self._column.nbytes + len(self.ids)) // 2 + 1 if hashes else 0
        self.hashes, at = np.empty(room, np.uint64), 0
        for d in range(len(self.ids)):
            words = self.text(d).split()
            n = self.counts[d] = max(0, len(words) - window + 1)
            if n and hashes:
                self._roll(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)), self.hashes[at:at + n])
                at += n
        self.hashes = self.hashes[:at]
        self.firsts = np.concatenate([[0], np.cumsum(self.counts)])  # place of a document's first window

    def text(self, d: int) -> bytes:
        """The text of a document in UTF-8; nothing for null."""
        data = self._column[int(self._rows[d])].as_buffer()
        return b"" if data is None else data.to_pybytes()

    def _roll(self, h: np.ndarray, out: np.ndarray) -> None:
        out[:] = 0
        for k in range(self.window):
            out *= np.uint64(0x9FB21C651E98DF25)
            out += h[k:k + len(out)]

    def cells(self, row: int, bits: int, some: slice = slice(None)) -> np.ndarray:
        """The counter of every window, or of some, in a row of the sketch."""
        h = self.hashes[some]
        x = h >> np.uint64(32)
        x ^= h
        x += np.uint64((2 * row + 1) * int(_FACTORS[1]) & (1 << 64) - 1)
        x *= _FACTORS[row % 4]
        x ^= x >> np.uint64(29)
        x *= _FACTORS[(row + 1) % 4]
        x >>= np.uint64(64 - bits)
        return x

    def digests(self, places: np.ndarray) -> np.ndarray:
        """16 bytes of each named window's words, as two numbers; the places ascend."""
        out = np.empty((len(places), 2), "<u8")
        docs = np.searchsorted(self.firsts, places, "right") - 1
        for d in np.unique(docs):
            words = self.text(d).split()
            plain = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            starts = np.concatenate([[0], ends[:-1] + 1])
            begin, end = np.searchsorted(docs, d), np.searchsorted(docs, d, "right")
            i = places[begin:end] - self.firsts[d]
            found = [xxhash.xxh3_128_digest(plain[s:e]) for s, e in zip(starts[i].tolist(), ends[i + self.window - 1].tolist())]
            out[begin:end] = np.frombuffer(b"".join(found), "<u8").reshape(-1, 2)
        return out


def _distinct(x: np.ndarray) -> np.ndarray:
    """The different numbers, ascending; ``x`` is sorted in place."""
    x.sort()
    first = np.ones(len(x), bool)
    first[1:] = x[1:] != x[:-1]
    return x[first]


def _shard_slices(ordered: np.ndarray, shards: int, bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """Ascending counters by shard, each a range of the row."""
    edges = [(s << bits) // shards for s in range(shards)]
    cuts = np.append(np.searchsorted(ordered, np.array(edges, np.uint64)), len(ordered))
    for s in range(shards):
        if cuts[s] < cuts[s + 1]:
            yield s, ordered[cuts[s]:cuts[s + 1]]


def _flagged(bucket: Bucket, row: int, bits: int, elsewhere: np.ndarray) -> np.ndarray:
    """Windows whose counter is 2 or more: it occurs twice here, or here and in another bucket."""
    ordered = bucket.cells(row, bits)
    ordered.sort()
    known = np.union1d(ordered[1:][ordered[1:] == ordered[:-1]], elsewhere)
    del ordered
    out = np.zeros(len(bucket.hashes), bool)
    for i in range(0, len(out) if len(known) else 0, _SLICE):
        mine = bucket.cells(row, bits, slice(i, i + _SLICE))
        out[i:i + _SLICE] = known[np.minimum(np.searchsorted(known, mine), len(known) - 1)] == mine
    return out


# --- the passes -------------------------------------------------------------------------------------------------

_SKETCH = "shard int, bucket int, line int, cells binary"
_MARKS = "shard int, bucket int, part int, docs binary, data binary"


def _sketch(window: int, rows: int, bits: int, shards: int):
    def one(table: pa.Table) -> pa.Table:
        bucket, number, out = Bucket(table, window), table["bucket"][0].as_py(), []
        for row in range(rows):
            for s, part in _shard_slices(_distinct(bucket.cells(row, bits)), shards, bits):
                out.append((row * shards + s, number, row, packed(part)))
        return _table(out, _SKETCH)

    return one


def _merged(table: pa.Table) -> pa.Table:
    """One range of one sketch row, of all buckets: the counters that several buckets count, for each of them."""
    rows = table.to_pylist()
    cells = [unpacked(r["cells"]) for r in rows]
    ordered = np.sort(np.concatenate(cells))
    several = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    out = []
    for r, own in zip(rows, cells):
        common = np.intersect1d(own, several, assume_unique=True)
        if len(common):
            out.append((r["shard"], r["bucket"], r["line"], packed(common)))
    return _table(out, _SKETCH)


def _exact(window: int, rows: int, bits: int, shards: int):
    """The windows of a bucket estimated repeated, named by digest, each with its document; repeats inside at once."""
    def one(key: tuple, table: pa.Table, common: pa.Table) -> pa.Table:
        out = []
        if table.num_rows:
            number, bucket = key[0].as_py(), Bucket(table, window)
            hit = np.ones(len(bucket.hashes), bool)
            for row in range(rows):
                mine = [unpacked(x) for x in common.filter(pc.equal(common["line"], row))["cells"].to_pylist()]
                elsewhere = np.sort(np.concatenate(mine)) if mine else np.empty(0, np.uint64)
                hit &= _flagged(bucket, row, bits, elsewhere)
            places = np.nonzero(hit)[0]
            halves = bucket.digests(places)
            order = np.lexsort((places, halves[:, 1], halves[:, 0]))
            same = np.zeros(len(places), bool)
            same[1:] = (halves[order[1:]] == halves[order[:-1]]).all(axis=1)
            again = np.sort(places[order[same]])
            out.append((int(number % shards), number, -1, b"", packed(again)))  # repeats of this bucket
            first = np.ones(len(places), bool)
            first[order[same]] = False
            places, halves = places[first], halves[first]
            docs = np.searchsorted(bucket.firsts, places, "right") - 1
            shard = (halves[:, 0] >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)
            order = np.argsort(shard, kind="stable")
            cuts = np.searchsorted(shard[order], np.arange(shards + 1))
            keys = _order_keys(bucket, number)
            for s in range(shards):
                at = order[cuts[s]:cuts[s + 1]]
                if not len(at):
                    continue
                of, starts = np.unique(docs[at], return_index=True)  # places ascend, so documents do
                runs = np.diff(np.append(starts, len(at))).astype("<u4")
                lines = np.ascontiguousarray(np.concatenate([keys[of].view(np.uint8).reshape(len(of), -1), runs.view(np.uint8).reshape(-1, 4)], axis=1))
                data = halves[at].astype("<u8").view(np.uint8).reshape(-1, 16)[:, :DIGEST]
                out.append((s, number, 0, zstandard.compress(lines.tobytes(), 1), np.ascontiguousarray(data).tobytes()))
                out.append((s, number, 1, b"", packed(places[at])))
        return _table(out, _MARKS)

    return one


_KEY = np.dtype([("null", "<i4"), ("id", "<i8"), ("bucket", "<i4"), ("place", "<i4")])


def _order_keys(bucket: Bucket, number: int) -> np.ndarray:
    """The global order of documents: id, null last; rows of one id by text, which share a bucket."""
    keys = np.zeros(len(bucket.ids), _KEY)
    for i, d in enumerate(bucket.ids):
        keys[i] = (d is None, 0 if d is None else d, number, i)
    return keys


def _decided(table: pa.Table) -> pa.Table:
    """One shard of windows: of equal ones all but the earliest, as places in their buckets."""
    rows = sorted(table.to_pylist(), key=lambda r: (r["bucket"], r["part"]))
    out = [(r["shard"], r["bucket"], -1, b"", r["data"]) for r in rows if r["part"] == -1]
    named = [r for r in rows if r["part"] == 0]
    places = {r["bucket"]: r["data"] for r in rows if r["part"] == 1}
    if named:
        names, keys = [], []
        for r in named:
            lines = np.frombuffer(zstandard.decompress(r["docs"]), np.dtype([("key", _KEY), ("n", "<u4")]))
            x = np.frombuffer(r["data"], np.uint8).reshape(-1, DIGEST)
            names.append(x)
            keys.append(np.repeat(lines["key"], lines["n"]))
        cuts = np.cumsum([0, *map(len, names)])  # a bucket's windows are in a row
        name = np.zeros((cuts[-1], 16), np.uint8)
        name[:, :DIGEST] = np.concatenate(names)
        halves, keys = name.view("<u8"), np.concatenate(keys)
        order = np.lexsort((keys["place"], keys["bucket"], keys["id"], keys["null"], halves[:, 1], halves[:, 0]))
        again = np.zeros(len(order), bool)
        again[order[1:]] = (halves[order[1:]] == halves[order[:-1]]).all(axis=1)
        for k, r in enumerate(named):
            mine = unpacked(places[r["bucket"]])[again[cuts[k]:cuts[k + 1]]]
            if len(mine):
                out.append((r["shard"], r["bucket"], -1, b"", packed(mine)))
    return _table(out, _MARKS)


def _table(rows: list[tuple], ddl: str) -> pa.Table:
    names = [f.split()[0] for f in ddl.split(", ")]
    types = [pa.int32() if f.endswith("int") else pa.binary() for f in ddl.split(", ")]
    columns = list(zip(*rows)) or [[] for _ in names]
    return pa.table({n: pa.array(c, t) for n, c, t in zip(names, columns, types)})


def _removed(window: int, schema: pa.Schema):
    """Texts without the words that repeated windows cover."""
    def one(key: tuple, table: pa.Table, marks: pa.Table) -> pa.Table:
        if not table.num_rows:
            return schema.empty_table()
        bucket = Bucket(table, window, hashes=False)
        parts = [unpacked(x) for x in marks["data"].to_pylist()]
        places = np.sort(np.concatenate(parts)).astype(np.int64) if parts else np.empty(0, np.int64)
        cuts = np.searchsorted(places, bucket.firsts)
        text_type = schema.field("text").type
        null, chunks, texts = bucket.table["text"].is_null().take(bucket.order).to_pylist(), [], []
        n_words, n_removed, shas = [], [], []
        for d in range(len(bucket.ids)):
            text = bucket.text(d)
            words = text.split()
            starts = places[cuts[d]:cuts[d + 1]] - bucket.firsts[d]
            gone = np.zeros(len(words) + 1, np.int64)
            if len(starts):
                np.add.at(gone, starts, 1)
                np.add.at(gone, starts + window, -1)
            kept = np.cumsum(gone)[:-1] == 0
            left = words if kept.all() else [w for w, k in zip(words, kept.tolist()) if k]
            texts.append(None if null[d] else text if kept.all() else _without(text, words, kept))
            n_words.append(len(words))
            n_removed.append(len(words) - len(left))
            shas.append(hashlib.sha256(b" ".join(left)).hexdigest())
            if len(texts) == _TEXTS:
                chunks.append(pa.array(texts, text_type))
                texts = []
        chunks.append(pa.array(texts, text_type))
        own = {"n_words": n_words, "n_removed": n_removed, "kept_sha256": shas}
        columns = {n: pa.array(x, schema.field(n).type) for n, x in own.items()} | {"text": pa.chunked_array(chunks, text_type)}
        rest = [f for f in schema if f.name not in columns]
        columns |= {f.name: bucket.table[f.name].take(bucket.order).cast(f.type) for f in rest}
        return pa.table({f.name: columns[f.name] for f in schema})

    return one


def _without(text: bytes, words: list[bytes], kept: np.ndarray) -> bytes:
    """The kept stretches of a text as they stand in it, joined by a blank."""
    spans, at = [], 0
    edges = np.flatnonzero(np.diff(np.concatenate([[False], kept, [False]]).astype(np.int8)))
    wanted = dict(zip(edges[::2].tolist(), edges[1::2].tolist()))
    begin, stop = None, None
    for i, w in enumerate(words):
        at = text.index(w, at)
        if i in wanted:
            begin, stop = at, wanted[i]
        at += len(w)
        if stop == i + 1:
            spans.append(text[begin:at])
            begin, stop = None, None
    return b" ".join(spans)


def substring_dedup(docs: DataFrame, window: int = WINDOW, rows: int = ROWS) -> DataFrame:
    """All columns of ``docs``, ``text`` without repeated passages, and ``n_words``, ``n_removed``, ``kept_sha256``.

    A word goes if a window of ``window`` consecutive words that covers it also
    starts earlier: in a document of smaller id, or before in the same one.
    Windows are those of the input. Rows of one id are ordered by text, rows
    without an id come last, in an order that depends on the texts alone. A null
    text stays null and has no words; a text whose words all go becomes empty; no
    row is dropped. Columns named as the added ones are replaced.

    1. Documents are dealt to buckets by id, once; all passes read that shuffle.
       Each bucket sketches its windows: per row of a count-min sketch the
       counters it raises, as packed ascending numbers.
    2. The sketches are merged by range of counters. Every bucket gets back those
       of its counters that other buckets raise too. Counts are overestimates, so
       no repeated window is lost.
    3. Only windows whose every counter is 2 or more are named exactly, by a
       digest of their words, once per bucket, and grouped by digest; all but the
       earliest are marked. A window that everyone shares is one name per bucket.
    4. Each bucket removes the words its marked windows cover.

    The sketch grows with the corpus and is never gathered in one place.
    """
    spark = docs.sparkSession
    own = ["n_words", "n_removed", "kept_sha256", "bucket"]
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = BUCKETS_PER_TASK * tasks
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = int(max(16, min(56, np.ceil(np.log2(ROOM * (size / 5 + 1))))))  # words have five bytes or more on average
    key = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64(F.col("doc_id").cast("long")))
    rest = docs.drop(*own).withColumn("doc_id", F.col("doc_id").cast("long"))
    dealt = rest.withColumn("bucket", F.pmod(key, F.lit(buckets)).cast("int")).repartition(tasks, "bucket")
    sketches = dealt.groupBy("bucket").applyInArrow(_sketch(window, rows, bits, tasks), _SKETCH)
    common = sketches.groupBy("shard").applyInArrow(_merged, _SKETCH)
    named = dealt.groupBy("bucket").cogroup(common.groupBy("bucket")).applyInArrow(_exact(window, rows, bits, tasks), _MARKS)
    marks = named.groupBy("shard").applyInArrow(_decided, _MARKS)
    added = StructType.fromDDL("n_words long, n_removed long, kept_sha256 string").fields
    schema = StructType([StructField(f.name, StringType()) if f.name == "text" else f for f in rest.schema.fields] + added)
    from pyspark.sql.pandas.types import to_arrow_schema

    return dealt.groupBy("bucket").cogroup(marks.groupBy("bucket")).applyInArrow(
        _removed(window, to_arrow_schema(schema)), schema)
