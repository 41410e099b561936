"""Cross-entropy difference: matched target and background bigram models over one vocabulary that grows with the corpus."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from rollcall.llm.substring_dedup import packed, unpacked
from rollcall.llm.text import need

ADD = 0.5  # added to the count of every word of the vocabulary
WORD_WEIGHT = 1000.0  # words of the corpus that stand behind each model's own words
PAIR_WEIGHT = 4.0  # words of the model that stand behind what follows one word
BUCKETS_PER_TASK = 2  # so that hashing deals documents out evenly enough
DRAWS = 1 << 30  # a document's draw is a number below this, by its id
START = np.uint64(0x5851F42D4C957F2D)  # stands before the first word of every document
END = np.uint64(0x14057B7EF767814F)  # follows the last word: a word of the vocabulary
SLICE = 1 << 17  # names scored at once, in whole documents
MODELS = 3  # target, matched background, whole corpus


def names_of(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit names of a text's words and its end, of what stands before each, and of the pairs; A-Z count as a-z."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return (np.empty(0, np.uint64),) * 3
    named = np.array([START, *map(xxhash.xxh3_64_intdigest, words), END], np.uint64)
    word, before = named[1:], named[:-1]
    pair = (before * np.uint64(0x9E3779B97F4A7C15)) ^ word
    pair = (pair ^ (pair >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return word, before, pair ^ (pair >> np.uint64(29))


class Bucket:
    """The documents of one bucket and the names in them; rows marked ``good`` name target documents.

    ``cuts`` are the draws below which a target document and one of the rest are counted by their model.
    """

    def __init__(self, table: pa.Table, cuts: tuple[int, int]):
        good = table["good"].to_numpy()
        marked = {d for d, g in zip(table["doc_id"].to_pylist(), good.tolist()) if g}
        self.table = table.filter(pa.array(~good))
        target = np.array([d in marked for d in self.table["doc_id"].to_pylist()], bool)
        draw = self.table["draw"].to_numpy()
        # which documents each model counts
        self.member = np.stack([target & (draw < cuts[0]), ~target & (draw < cuts[1]), np.ones(len(target), bool)])
        parts = [names_of(t) for t in self.table["text"].to_pylist()]
        self.lengths = np.array([len(p[0]) for p in parts], np.int64)  # words and the end
        self.word, self.before, self.pair = (
            np.concatenate([np.empty(0, np.uint64), *(p[k] for p in parts)]) for k in range(3))

    def counted(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Different names in ascending order and their counts by model: of words with START, of pairs."""
        full, out = np.nonzero(self.lengths)[0], []
        doc = np.repeat(np.arange(len(self.lengths)), self.lengths)
        words = np.concatenate([self.word, np.full(len(full), START, np.uint64)])
        for names, docs in ((words, np.concatenate([doc, full])), (self.pair, doc)):
            different, at = np.unique(names, return_inverse=True)
            counts = [np.bincount(at[m[docs]], minlength=len(different)) for m in self.member]
            out.append((different, np.stack(counts).astype("<i8")))
        return out


def _shrunk(x: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(x, "<i8").tobytes(), 1)


def _grown(data: bytes) -> np.ndarray:
    """Counts as one row per model."""
    return np.frombuffer(zstandard.decompress(data), "<i8").reshape(MODELS, -1)


_COUNTED = "shard int, bucket int, words binary, word_counts binary, pairs binary, pair_counts binary"
_MERGED = "shard int, bucket int, word_counts binary, pair_counts binary, used long, target long, matched long, corpus long"


def _table(rows: list[tuple], ddl: str) -> pa.Table:
    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in ddl.split(", ")]
    columns = list(zip(*rows)) or [[] for _ in fields]
    return pa.table({name: pa.array(c, types[t]) for (name, t), c in zip(fields, columns)})


def _counts(shards: int, limits: tuple[int, int]):
    """The counts of one bucket, cut into ranges of names."""
    edges = np.array([(s << 64) // shards for s in range(1, shards)], np.uint64)

    def one(table: pa.Table) -> pa.Table:
        number, kinds = table["bucket"][0].as_py(), Bucket(table, limits).counted()
        cuts = [[0, *np.searchsorted(names, edges).tolist(), len(names)] for names, _ in kinds]
        out = []
        for s in range(shards):
            ranges = [slice(c[s], c[s + 1]) for c in cuts]
            if any(r.start < r.stop for r in ranges):
                out.append((s, number, *(x for (names, counts), r in zip(kinds, ranges) for x in (packed(names[r]), _shrunk(counts[:, r])))))
        return _table(out, _COUNTED)

    return one


def _summed(parts: list[tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Different names of all parts, the sums of their counts, and for each part the sums of its names."""
    names = [unpacked(n) for n, _ in parts]
    different, at = np.unique(np.concatenate(names), return_inverse=True)
    sums, places = np.zeros((MODELS, len(different)), np.int64), np.split(at, np.cumsum([len(n) for n in names])[:-1])
    for place, (_, counts) in zip(places, parts):
        sums[:, place] += _grown(counts)  # the names of one part differ
    return different, sums, [_shrunk(sums[:, place]) for place in places]


def _merged(buckets: int):
    """One range of names, of all buckets: to each the whole corpus' counts of its names, and the range's totals."""
    def one(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        names, sums, words = _summed([(r["words"], r["word_counts"]) for r in rows])
        pairs = _summed([(r["pairs"], r["pair_counts"]) for r in rows])[2]
        known = {r["bucket"]: counts for r, *counts in zip(rows, words, pairs)}
        word = names != START
        totals = (int(word.sum()), *map(int, sums[:, word].sum(1)))
        return _table([(rows[0]["shard"], b, *known.get(b, (None, None)), *totals) for b in range(buckets)], _MERGED)

    return one


def _own(doc: np.ndarray, places: np.ndarray) -> np.ndarray:
    """For each position, how often its document holds the name at that position."""
    _, at, counts = np.unique(doc * (int(places.max()) + 1) + places, return_inverse=True, return_counts=True)
    return counts[at]


def _slices(lengths: np.ndarray) -> Iterator[tuple[slice, slice]]:
    """Consecutive whole documents of about ``SLICE`` names, and the positions of their names."""
    ends = np.concatenate([[0], np.cumsum(lengths)])
    first = 0
    while first < len(lengths):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + SLICE, "right")) - 1)
        yield slice(first, last), slice(int(ends[first]), int(ends[last]))
        first = last


def _losses(bucket: Bucket, rows: list[dict]) -> np.ndarray:
    """Loss per prediction under each model (rows) of each document, its own counts taken out of every model that holds them."""
    rows = sorted(rows, key=lambda r: r["shard"])
    words, pairs = (np.concatenate([_grown(r[c]) for r in rows if r[c] is not None], axis=1) for c in ("word_counts", "pair_counts"))
    names, pair_names = np.unique(np.concatenate([bucket.word, [START]])), np.unique(bucket.pair)
    used, totals = sum(r["used"] for r in rows), [sum(r[m] for r in rows) for m in ("target", "matched", "corpus")]
    out = np.zeros((MODELS, len(bucket.lengths)))
    for docs, at in _slices(bucket.lengths):
        if at.start == at.stop:
            continue
        lengths = bucket.lengths[docs]
        doc = np.repeat(np.arange(len(lengths)), lengths)
        word, before = np.searchsorted(names, bucket.word[at]), np.searchsorted(names, bucket.before[at])
        pair, length = np.searchsorted(pair_names, bucket.pair[at]), lengths[doc]
        own_word, own_pair = _own(doc, word), _own(doc, pair)
        first = (np.cumsum(lengths) - lengths)[doc] == np.arange(len(doc))
        own_before = np.where(first, 1, np.roll(own_word, 1))  # what stands before is the word one place earlier
        prior = (words[2][word] - own_word + ADD) / (totals[2] - length + ADD * used)
        for k in range(MODELS):
            mine = bucket.member[k][docs][doc]
            p = (words[k][word] - mine * own_word + WORD_WEIGHT * prior) / (totals[k] - mine * length + WORD_WEIGHT)
            p = (pairs[k][pair] - mine * own_pair + PAIR_WEIGHT * p) / (words[k][before] - mine * own_before + PAIR_WEIGHT)
            out[k, docs] = np.bincount(doc, -np.log(p), len(lengths)) / np.maximum(lengths, 1)
    return out


def _scored(schema: pa.Schema, limits: tuple[int, int]):
    """The documents of one bucket, scored from the corpus' counts of its names."""
    def one(key: tuple, table: pa.Table, merged: pa.Table) -> pa.Table:
        bucket = Bucket(table, limits) if table.num_rows else None
        if bucket is None or not bucket.table.num_rows:
            return schema.empty_table()
        n = bucket.lengths
        losses = _losses(bucket, merged.to_pylist()) if len(bucket.word) else np.zeros((MODELS, len(n)))
        scores = [pa.array(x, mask=n == 0) for x in (*losses, losses[0] - losses[1])]
        columns = [bucket.table["doc_id"], pa.array(np.maximum(n - 1, 0)), *scores]
        return pa.table([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    return one


def matched_limits(docs: DataFrame, good: DataFrame) -> tuple[int, int]:
    """Draws below which target documents and the others are counted, so that both models hold about as many characters."""
    sizes = docs.select("doc_id", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("_size")).groupBy("doc_id").agg(
        F.sum("_size").alias("_size"))  # one number per id goes to the join, no text
    marked = sizes.join(good.select("doc_id", F.lit(True).alias("_good")), "doc_id", "left")
    size, is_good = F.col("_size"), F.col("_good").isNotNull()
    target, rest = marked.agg(F.sum(F.when(is_good, size)), F.sum(F.when(~is_good, size))).first()
    target, rest = target or 0, rest or 0
    return (DRAWS if target <= rest else DRAWS * rest // target), (DRAWS if rest <= target else DRAWS * target // rest)


def cross_entropy_difference(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, n_words, target_loss, matched_loss, background_loss, difference) of every row of ``docs``.

    Three bigram models share one vocabulary, every word of the corpus and the end
    of a document. The target model counts the documents that ``labels`` call good
    (quality 1); the matched background counts others of about the same number of
    characters, drawn by a digest of the id (where the good ones are the larger
    part, they are drawn instead); the corpus model counts all of ``docs``.

    A model's share of a word is its own count with ``WORD_WEIGHT`` words of the
    corpus' shares behind it (``ADD`` added to each word there); what follows a
    word is the model's count with ``PAIR_WEIGHT`` words of the model's shares
    behind it. So every distribution adds up to 1, after an unseen word too. A
    document's own words are taken out of each model that counts it, so labelled
    and unlabelled documents are scored alike. Losses are in nats per prediction
    (words and the end); ``background_loss`` is the corpus model's. ``difference``
    is target less matched loss: negative speaks for the target, 0 is the value
    without any label. A null or wordless text has n_words 0 and null losses; null
    ids match no label; repeated rows are counted and scored each, the others still
    counted; labels may repeat. Other columns are not read; no rows give no rows.

    1. One scan adds up the characters of good and other documents.
    2. Documents and the ids of target documents are dealt to buckets by id, once.
       Each bucket counts its words and pairs; different names go to the merge as
       packed ascending numbers, so that a frequent word is one number per bucket.
    3. Counts are added by range of names. Each bucket gets back the corpus' counts
       of just its names, in its order, and the totals of the range.
    4. Each bucket scores its documents.

    Nothing is kept in a table of fixed size or sent to the driver: what is counted
    grows with the corpus and stays dealt out. Words and pairs are named by 64
    bits; two names clash for about n * n / 2**65 of n different pairs.
    """
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = BUCKETS_PER_TASK * tasks
    kind = docs.schema["doc_id"].dataType
    good = labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").cast(kind)).distinct()
    texts = need(docs, "doc_id", "text")
    limits = matched_limits(texts, good)
    one = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    rows = texts.select("*", F.lit(False).alias("good"), F.pmod(F.xxhash64(one), F.lit(DRAWS)).alias("draw")).unionByName(
        good.select("doc_id", F.lit(None).cast("string").alias("text"), F.lit(True).alias("good"), F.lit(0).cast("long").alias("draw")))
    dealt = rows.withColumn("bucket", F.pmod(one, F.lit(buckets)).cast("int")).repartition(tasks, "bucket")
    counted = dealt.groupBy("bucket").applyInArrow(_counts(tasks, limits), _COUNTED)
    merged = counted.groupBy("shard").applyInArrow(_merged(buckets), _MERGED)
    out = StructType([docs.schema["doc_id"], *StructType.fromDDL(
        "n_words long, target_loss double, matched_loss double, background_loss double, difference double").fields])
    from pyspark.sql.pandas.types import to_arrow_schema

    return dealt.groupBy("bucket").cogroup(merged.groupBy("bucket")).applyInArrow(_scored(to_arrow_schema(out), limits), out)
