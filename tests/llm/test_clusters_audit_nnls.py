"""Centroid clusters, the audit of filter orders and packing by least squares beside plain Python on small tables."""

import hashlib
import math
import random
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from rollcall.llm import centroid_clusters, filter_audit, nnls_packing

from tests.llm.test_text_operators import docs, made, none, rows, words_of  # noqa: F401

BYTES = public_tokenizers.path("byte_bpe_50k.json")


# --- clusters --------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<double>, label int, cluster string, distance int"


def clusters_of(table, k, rounds, dim):
    kept = [(i, [max(-(1 << 27), min((1 << 27) - 1, math.floor(256 * x))) for x in v]) for i, v in table
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    c = [v for _, v in start[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, x)), j) for j, x in enumerate(c)) for _, v in kept]

    for _ in range(rounds):
        near = assign()
        for j in range(len(c)):
            own = [v for (_, v), (_, at) in zip(kept, near) if at == j]
            if own:
                c[j] = [sum(x) // len(own) for x in zip(*own)]
    near = assign()
    total = Counter()
    for d, j in near:
        total[j] += d
    sha = [hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for x in c]
    return Counter((i, j, d, total[j], sum(total.values()), sha[j]) for (i, _), (d, j) in zip(kept, near))


def of_spark(spark, table, **how):
    df = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in table], VECTORS).repartition(3)
    return Counter(map(tuple, centroid_clusters.cluster(df, **how).collect()))


@pytest.mark.parametrize("k", [1, 5, 500])
def test_clusters(spark, k):
    r = random.Random(k)
    table = [(i, [r.gauss(i % 4, 0.5) for _ in range(6)]) for i in range(150)]
    table += [(7, table[7][1]), (200, table[3][1]), (7, table[8][1]), (None, table[5][1]), (None, [0.0] * 6)]
    table += [(300 + i, [1.5] * 6) for i in range(40)]  # a group of copies
    table += [(400, None), (401, []), (402, [1.0] * 5), (403, [None] + [1.0] * 5), (404, [float("nan")] * 6), (405, [float("inf")] + [0.0] * 5)]
    table += [(406, [1e300, -1e300, 1e9, -1e9, 0.0, -0.001])]
    assert of_spark(spark, table, clusters=k, dim=6, rounds=5) == clusters_of(table, k, 5, 6)


def test_no_vectors(spark):
    assert not of_spark(spark, []) and not of_spark(spark, [(1, None), (2, [1.0])])
    df = spark.createDataFrame([], VECTORS)
    assert centroid_clusters.cluster(df).dtypes == centroid_clusters.cluster(
        spark.createDataFrame([(1, [0.5] * 64, 1, "x", 2)], VECTORS)).dtypes


# --- audit -----------------------------------------------------------------------------

def audit_of(table, labels):
    """Every order played out document by document."""
    smallest, fails = {}, []
    for d, text, _ in table:
        if d is not None:
            smallest[text or ""] = min(d, smallest.get(text or "", d))
    for d, text, lang in table:
        t, w = text or "", words_of(text)
        f = "".join(c for c, bad in (
            ("A", len(w) < 100), ("B", 100 * len(set(w)) < 80 * len(w)), ("C", 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t)),
            ("D", any(c in "#$%&*|" for c in t)), ("E", d is not None and d > smallest[t])) if bad)
        good = any(q == 1 for i, q, _ in labels if i is not None and i == d)
        toxic = any(x == 1 for i, _, x in labels if i is not None and i == d)
        fails.append((lang or "", f, good, toxic))
    out, shapley = [], Counter()
    for part in {p for p, *_ in fails}:
        own = [x for x in fails if x[0] == part]
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                here = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                shapley[part, f] += len(here)
                out.append((part, order, step, len(left), len(here), sum(f in x[1] for x in own) - len(here), sum(x[1] == f for x in own),
                            sum(x[2] for x in here), sum(x[3] for x in here)))
    return Counter((*x, shapley[x[0], x[1][x[2] - 1]]) for x in out)


def test_audit(spark, rows):  # noqa: F811
    r = random.Random(3)
    long = " ".join(f"Word{i}" for i in range(150))
    table = [(d, t, r.choice(["en", "de", None, ""])) for d, t, _ in rows]
    table += [(900 + i, t, "en") for i, t in enumerate([long, long.lower(), long.lower(), long + " #", "A" * 10 + " b" * 100, "ß" * 300, "", None, " "])]
    table += [(i, long.lower(), ("en", "de", None)[i % 3]) for i in range(2000, 2150)]  # a group of copies over parts
    table += [(None, long.lower(), "en"), (None, long.lower(), "de"), (None, None, None), (2000, long.lower(), "de"), (2001, long.lower(), "fr")]
    labels = [(d, r.randint(0, 1), r.randint(0, 1)) for d, *_ in table if r.random() < 0.6] + [(None, 1, 1), (905, None, 1), (905, 1, None), (2000, 0, 0)]
    df = spark.createDataFrame([(d, t, x, 0, "y", 9) for d, t, x in table], "doc_id long, text string, lang string, mask int, part string, n int")
    marks = spark.createDataFrame([(*x, "z") for x in labels], "doc_id long, quality int, toxic int, part string")
    got = filter_audit.audit(df.repartition(4), marks)
    assert Counter(map(tuple, got.collect())) == audit_of(table, labels)
    assert filter_audit.audit(df.limit(0), marks).count() == 0
    assert Counter(map(tuple, filter_audit.audit(df, marks.limit(0)).collect())) == audit_of(table, [])


def test_packed_fields_never_run_over():
    orders = list(permutations(range(5)))
    for n in (1, 2, 3, 255, 256, 10**12):  # every field full: the next one must not change
        width = n.bit_length()
        removed, redundant = filter_audit.outcomes(31, orders, width)
        assert filter_audit.unpacked(n * removed, 600, width) == [n, 0, 0, 0, 0] * 120
        assert filter_audit.unpacked(n * redundant, 600, width) == [0, n, n, n, n] * 120
    assert filter_audit.outcomes(0, orders, 9) == (0, 0)


# --- packing ---------------------------------------------------------------------------

def test_ids_are_those_of_the_tokenizer():
    ids, whole = nnls_packing.Ids(BYTES), Tokenizer.from_file(BYTES)
    assert ids.ranks
    r = random.Random(5)
    letters = "abC '\n\t    é漢🙂١2.#!s"
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 60))) for _ in range(400)]
    texts += ["<|endoftext|>", "a <|endoftext|>  b<|endoftext|>", "it's 's <|endoftext", "x" * 5000, " " * 3000, "\x00\x1c\x85"]
    for t in texts:
        assert np.concatenate(list(ids.of(t))).tolist() == whole.encode(t, add_special_tokens=False).ids, t
    other = nnls_packing.Ids(public_tokenizers.path("word_bpe_49k.json"))
    assert not other.ranks and next(other.of("Some Words")).tolist() == other.whole.encode("Some Words", add_special_tokens=False).ids


def test_long_texts_are_cut_between_pieces(monkeypatch):
    ids, whole = nnls_packing.Ids(BYTES), Tokenizer.from_file(BYTES)
    monkeypatch.setattr(nnls_packing, "_CHUNK", 10)
    r = random.Random(6)
    for _ in range(200):
        t = "".join(r.choice("ab1.'s \n\t ") for _ in range(300))
        assert np.concatenate(list(ids.of(t))).tolist() == whole.encode(t, add_special_tokens=False).ids


def test_repeat_counts_meet_the_histogram():
    r = np.random.default_rng(2)
    demand = np.bincount(np.clip(r.lognormal(5, 1.0, 200_000).astype(int), 1, 1023), minlength=1025).astype(float)
    lengths, times = nnls_packing.combinations_of(np.nonzero(demand)[0], 1024)
    assert ((lengths * times).sum(1) == 1024).all()
    rows_, x = nnls_packing.repeat_counts(lengths, times, demand)
    used = nnls_packing._met(lengths[rows_], times[rows_], x, 1024)
    assert (x >= 0).all() and np.abs(demand - used)[1:].sum() < 0.05 * demand.sum()


@pytest.mark.parametrize("histogram,most", [
    ({n: 200 + n % 7 for n in range(1, 1025)}, 0.02), ({600: 5000}, 1), ({1: 3}, 1), ({1024: 7, 3: 1, 2: 5}, 1), ({}, 0), ({700: 100_000, 324: 99_990, 5: 9}, 0.01)])
def test_plan(histogram, most):
    p, rest = nnls_packing.plan(histogram)
    assert rest <= most * sum(histogram.values())
    fill, parts = Counter(), Counter()
    for (n, start), rules in p.rules.items():
        for rank, many, size, sequence, done, each, offset in rules:
            parts[n] += many * size
            for at in {0, many - 1} if many > 3000 else range(many):
                assert offset + ((done + at) % each + 1) * size <= 1024
            first, last = done // each, (done + many - 1) // each
            for q in range(first, last + 1):
                fill[sequence + q] += size * (min(done + many, (q + 1) * each) - max(done, q * each))
    assert parts == Counter({n: n * k for n, k in histogram.items()})
    assert set(fill) == set(range(p.sequences))
    short = [v for v in fill.values() if v != 1024]
    assert len(short) <= 10 and all(v & (v - 1) == 0 for v in short)


def checked(rows_, out, capacity):
    """Every id of every document is in one piece, every sequence has no gap, and nothing is padded."""
    whole, want = Tokenizer.from_file(BYTES), Counter()
    for d, t, _ in rows_:
        want[d, tuple(whole.encode(t or "", add_special_tokens=False).ids + [0])] += 1
    by_doc, by_sequence = {}, {}
    for r in out:
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at == capacity or at < capacity and at & (at - 1) == 0
    for (d, n), pieces in by_doc.items():
        own = [x for (e, x), k in want.items() if e == d and len(x) == n for _ in range(k)]
        assert sorted(Counter(p.start for p in pieces).items())[0] == (0, len(own))
        data = [np.array(x, "<u4").tobytes() for x in own]
        for p in pieces:
            assert any(zlib.crc32(b[4 * p.start:4 * (p.start + p.length)]) == p.ids_crc32 for b in data)
        assert sum(p.length for p in pieces) == n * len(own)
    assert sum(len(x) * k for (_, x), k in want.items()) == sum(r.length for r in out)


@pytest.mark.parametrize("capacity", [64, 1024])
def test_packing_without_padding(spark, docs, rows, none, capacity):  # noqa: F811
    out = nnls_packing.pack(docs.repartition(4), BYTES, capacity).collect()
    checked(rows, out, capacity)
    assert nnls_packing.pack(none, BYTES).count() == 0


def test_equal_documents_are_packed_each(spark):
    table = [(i % 5, "the same words " * 250, "a") for i in range(40)]
    checked(table, nnls_packing.pack(made(spark, table), BYTES).collect(), 1024)
