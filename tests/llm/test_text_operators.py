"""The text operators beside plain Python on small tables: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import hashlib
import os
import random
import re
import subprocess
import sys
import unicodedata
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from rollcall.llm import (
    embedding_dedup, license_scan, lm_scoring, mixing, near_copies, packing, quality_classifier, quality_rules, simhash, substring_dedup, warc,
)
from rollcall.llm.components import connected, shortest_forest
from rollcall.llm.queries import importable

TOKENS = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, bucket int, fp int, n_words string, kept string"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def made(spark, rows):
    importable(spark)
    return spark.createDataFrame(
        [(d, t, "en", s, len(t or ""), 1, 2, "x", "y") for d, t, s in rows], DOCS)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(4)
    vocabulary = ["the", "of", "And", "énorme", "Wort", "naïve", "x1", "don't", "it's", "…"] + [f"w{i}" for i in range(150)]
    base = [" ".join(r.choice(vocabulary) for _ in range(r.randint(1, 150))) for _ in range(60)]
    passage = " ".join(f"p{i}" for i in range(60))
    texts = base + base[:15] + [b.replace("w1 ", "w2 ", 1) for b in base[15:35]]
    texts += [f"{b}\n{passage}\t{b[:30]}" for b in base[40:50]] + ["", None, "  \n\t ", "one", "two words", passage, passage]
    texts += ["again and " * 400, " ".join(r.choice(vocabulary) for _ in range(9000))]
    out = [(i * 3 % 1000, t, (None, "a", "b", "c", "d")[i % 5]) for i, t in enumerate(texts)]
    return out + [(None, "no id here at all", "a"), (None, passage, None), out[2], out[2]]


@pytest.fixture
def docs(spark, rows):
    return made(spark, rows)


@pytest.fixture
def none(spark):
    return made(spark, [])


def components(ids, linked):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {i: find(i) for i in ids}


def test_components_of_random_links(spark):
    importable(spark)
    r = random.Random(1)
    links = [(r.randint(-300, 300), r.randint(-300, 300)) for _ in range(260)] + [(1000, 1000 + i) for i in range(200)]
    links += [(2000 + i, 2001 + i) for i in range(100)] + [(5, 5)]
    nodes = sorted({x for a, b in links if a != b for x in (a, b)})
    got = {r.node: r.root for r in connected(spark.createDataFrame(links, "a long, b long").repartition(5)).collect()}
    assert got == components(nodes, [x for x in links if x[0] != x[1]])


def test_quality_counts(docs, rows, none):
    def counts(text):
        w = words_of(text)
        three = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
        covered = {i + k for i in range(len(w) - 2) if three[tuple(w[i:i + 3])] > 1 for k in range(3)}
        lines = [x for x in (text or "").split("\n") if words_of(x)]
        return (len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))

    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                  for r in quality_rules.quality_rules(docs).collect())
    want = Counter((d, *(c := counts(t)), c[0] < 50 or 100 * c[4] > 50 * c[0]) for d, t, _ in rows)
    assert got == want
    assert quality_rules.quality_rules(none).count() == 0


def test_quality_verdict(spark):
    good = " ".join(f"the cat{i} sat{i} on a mat{i} near river{i}" for i in range(20))
    texts = [good, good.upper(), good.replace(" ", " ### "), good.replace("the", "x").replace(" on ", " q ").replace(" a ", " z ")]
    got = quality_rules.quality_rules(made(spark, [(i, t, "a") for i, t in enumerate(texts)])).orderBy("doc_id").collect()
    assert [r.kept for r in got] == [True, False, False, False]
    assert got[1].broken_rules == "stop_words" and "symbols" in got[2].broken_rules


def test_classifier_held_out(spark):
    r = random.Random(2)
    rows, labels = [], []
    for i in range(800):
        bad = i % 4 == 0
        w = [r.choice("abcdefghij") * r.randint(1, 6) for _ in range(80)]
        rows.append((i, " ".join(x.upper() + "!!" for x in w) if bad else " ".join(w), f"s{i % 7}"))
        if i % 2 or i % 8 == 0:
            labels.append((i, 0 if bad else 1, 0))
    rows += [(None, None, None), (900, "", None)]
    labels.append((None, 1, 0))
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = quality_classifier.classify(made(spark, rows), table).collect()
    assert len(out) == len(rows)
    held = [x for x in out if x.doc_id is not None and x.doc_id < 800 and x.doc_id % 8 in (2, 4, 6)]
    assert np.mean([x.kept == (x.doc_id % 4 != 0) for x in held]) > 0.98
    assert all(0 < x.host_posterior < 1 and 0 < x.path_posterior < 1 for x in out)
    assert quality_classifier.classify(made(spark, []), table).count() == 0
    unlabelled = quality_classifier.classify(made(spark, rows), table.limit(0)).collect()
    assert len(unlabelled) == len(rows) and all(abs(x.evidence) < 1e-9 for x in unlabelled)


def test_sparse_paths_shrink_towards_their_host(spark):
    rows = [("h", "big", 0.9)] * 500 + [("h", "tiny", 0.0)] + [("g", "big", 0.2)] * 500 + [(None, None, 0.5)]
    got = {(r.host, r.path): r for r in quality_classifier.site_posteriors(
        spark.createDataFrame(rows, "host string, path string, p double")).collect()}
    assert 0.3 < got["h", "tiny"].path_posterior < got["h", "big"].path_posterior
    assert got["g", "big"].path_posterior < 0.3 and (None, None) in got


def features_of(text):
    text = text or ""
    w, lines = words_of(text), [x for x in text.split("\n") if words_of(x)]
    n = max(len(w), 1)
    return (np.log(n), sum(map(len, w)) / n, min(len(re.findall("[#*$%&|<>!]", text)) / n, 1.0),
            sum(unicodedata.category(c) == "Lu" for c in text) / max(len(text), 1), len(set(w)) / n,
            (len(lines) - len(set(lines))) / max(len(lines), 1))


def strength_of(groups):
    """Prior strength of (total, number, mean) by moments."""
    n = sum(g[1] for g in groups)
    noise = [m * (1 - m) for _, _, m in groups]
    spread = max(0.0, (sum(k * (t / k - m) ** 2 for t, k, m in groups) - sum(noise)) / n)
    return min(1e6, max(1.0, np.mean(noise) / spread if spread else 1e6))


def posteriors_of(rows, labels):
    """(evidence, host, path, posterior) of every row, by sums over all rows and a fit by plain gradient steps."""
    quality, texts = {}, {}
    for d, q in labels:
        if d is not None and q in (0, 1):
            quality[d] = min(q, quality.get(d, 1))
    for d, t, _, _ in rows:
        if d in quality:
            texts[d] = min(features_of(t), texts.get(d, (np.inf,)))
    x, y = np.array(list(texts.values())), np.array([quality[d] for d in texts], float)
    centre, scale = x.mean(0), np.maximum(x.std(0), 1e-9)
    z = np.hstack([(x - centre) / scale, np.ones((len(x), 1))])
    w, ridge = np.zeros(z.shape[1]), np.array([1.0] * x.shape[1] + [1e-6])
    for _ in range(60_000):
        w += 0.5 * (z.T @ (y - 1 / (1 + np.exp(-z @ w))) - ridge * w) / len(y)
    prior = (y.sum() + 1) / (len(y) + 2)
    base = np.log(prior / (1 - prior))
    evidence = [np.clip((np.array(features_of(t)) - centre) / scale @ w[:-1] + w[-1], -30, 30) - base for _, t, _, _ in rows]
    p = [1 / (1 + np.exp(-(e + base))) for e in evidence]
    mu = np.clip(np.mean(p), 1e-4, 1 - 1e-4)
    hosts, paths = {}, {}
    for (_, _, host, path), q in zip(rows, p):
        for table, key in ((hosts, host), (paths, (host, path))):
            table.setdefault(key, []).append(q)
    k = strength_of([(sum(v), len(v), mu) for v in hosts.values()])
    hosts = {h: (sum(v) + k * mu) / (len(v) + k) for h, v in hosts.items()}
    k = strength_of([(sum(v), len(v), hosts[h]) for (h, _), v in paths.items()])
    paths = {hp: (sum(v) + k * hosts[hp[0]]) / (len(v) + k) for hp, v in paths.items()}
    out = []
    for (_, _, host, path), e in zip(rows, evidence):
        at = np.clip(paths[host, path], 1e-4, 1 - 1e-4)
        out.append((e, hosts[host], paths[host, path], 1 / (1 + np.exp(-(e + np.log(at / (1 - at)))))))
    return out


def test_classifier_by_plain_sums(spark):
    """Every figure of every row: repeated rows, one id with two texts or two labels, null and empty cells, a very long text."""
    r = random.Random(12)
    rows, labels = [], []
    for i in range(160):
        bad = r.random() < 0.4
        w = [r.choice(["alpha", "Beta", "ÉTÉ", "x1", "gamma"]) + ("!!#" if bad and r.random() < 0.6 else "") for _ in range(r.randint(1, 60))]
        rows.append((i, r.choice([" ", "\n"]).join(w), r.choice(["a", "a", "a", "b", "c", None]), r.choice(["en", "de", None])))
        if i % 2:
            labels.append((i, int(bad != (r.random() < 0.1)) ^ 1))
    rows += [rows[3], rows[3], (5, "another text of five", "b", "en"), (None, None, None, None), (None, "no id", "a", "en"), (500, "", "only", "en")]
    rows.append((501, "Very long text! " * 40_000, "b", "de"))
    labels += [(7, 0), (7, 1), (None, 1), (9, None), (9999, 1), labels[0]]
    table = spark.createDataFrame([(d, q, "x") for d, q in labels], "doc_id long, quality int, kept string")
    docs = spark.createDataFrame([(*x, 1, n) for n, x in enumerate(rows)], "doc_id long, text string, source string, lang string, evidence int, n int")
    for keep in (True, False):
        got = {x.n: x for x in quality_classifier.classify(docs, table, keep_text=keep).collect()}
        want = posteriors_of(rows, labels)
        assert len(got) == len(rows) == len(want)
        for n, figures in enumerate(want):
            x = got[n]
            assert (x.evidence, x.host_posterior, x.path_posterior, x.posterior) == pytest.approx(figures, rel=1e-6, abs=1e-6)
            assert abs(figures[3] - 0.5) < 1e-5 or x.kept == (figures[3] >= 0.5)
    # without labels every posterior equals the threshold, and is kept
    assert {(x.posterior, x.kept) for x in quality_classifier.classify(docs, table.limit(0)).collect()} == {(0.5, True)}


def test_license_scan(spark, none):
    texts = ["Intro.\nLicensed under CC BY-NC 4.0.\nmore", "released   under the MIT license", "ALL RIGHTS RESERVED", None, "",
             "Licensed under the Apache License, Version 2.0, see file", "nothing here", "All rights reserved.\nReleased under the MIT License."]
    rows = [(i, t, "a") for i, t in enumerate(texts)] + [(2, texts[2], "a")]
    got = license_scan.license_scan(made(spark, rows)).collect()
    names = {r.doc_id: r.license for r in got}
    assert len(got) == 9 and [names[i] for i in range(8)] == [
        "CC-BY-NC-4.0", "MIT", "Proprietary", None, None, "Apache-2.0", None, "MIT"]
    assert license_scan.license_scan(none).count() == 0


def license_of(text, templates, t=0.8):
    """(matches of lines and the whole text, templates reached, best, its coefficient) by all windows."""
    def dice(w, b):
        g = set(zip(w, w[1:]))
        return 2.0 * len(g & b) / (len(g) + len(b)) if g else 0.0

    norm = lambda x: re.sub("[^A-Za-z0-9]+", " ", x).strip().lower().split()
    lines = (text or "").split("\n")
    units, whole = [norm(u) for u in lines + ([text] if len(lines) > 1 else [])], norm(text or "")
    found, n = [], 0
    for k, template in templates.items():
        w = norm(template)
        b = set(zip(w, w[1:]))
        reached = [d for d in (dice(u, b) for u in units) if d >= t]
        n += len(reached)
        reached += [d for d in (dice(whole[i:i + len(w)], b) for i in range(len(whole) - len(w) + 1)) if d >= t]
        if reached:
            found.append((-max(reached), k))
    return n, len(found), min(found)[1] if found else None, -min(found)[0] if found else None


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:"""


def test_license_windows_of_whole_texts(spark):
    """Wrapped and unwrapped licence texts, notices within longer lines, altered, cut and repeated ones, very long texts."""
    r = random.Random(9)
    notices = list(license_scan.TEMPLATES.values())
    filler = "the of license software under a public and permission version rights to in".split()
    texts = [MIT, MIT.replace("\n", " "), "Copyright 2020 Acme. All rights reserved.", None, "", "one", "all rights", "all rights rights reserved",
             "This software is released under the MIT License, see LICENSE.txt"]
    for _ in range(60):
        words = r.choice(notices).split()
        for _ in range(r.randint(0, 4)):  # words changed, doubled or left out
            i = r.randrange(len(words))
            words[i:i + 1] = r.choice([["x"], [words[i]] * 2, []]) or (["y"] if len(words) < 3 else [])
        around = [r.choice(filler) for _ in range(r.randint(0, 40))]
        at = r.randint(0, len(around))
        texts.append("".join(w + r.choice([" ", " ", "\n", ", "]) for w in around[:at] + words + around[at:]))
    texts.append(" ".join(r.choice(filler) for _ in range(30_000)) + "\n" + MIT)
    got = {x.doc_id: (x.n_matches, x.n_templates, x.license, x.dice)
           for x in license_scan.license_scan(made(spark, [(i, t, "a") for i, t in enumerate(texts)])).collect()}
    assert got == {i: license_of(t, license_scan.TEMPLATES) for i, t in enumerate(texts)}
    assert [got[i][2] for i in (0, 1, 2, 8, len(texts) - 1)] == ["MIT-text", "MIT-text", "Proprietary", "MIT", "MIT-text"]
    assert {x.license for x in license_scan.license_scan(made(spark, [(1, MIT, "a")]), {"none": "word"}).collect()} == {None}


def fingerprint(text):
    w = [x.encode().lower() for x in words_of(text)]
    h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 3]), 42) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(docs, rows, none):
    prints = {t: fingerprint(t) for _, t, _ in rows}
    different = sorted(set(prints.values()))
    root = components(different, [(a, b) for i, a in enumerate(different) for b in different[i + 1:] if (a ^ b).bit_count() <= 2])
    first = {}
    for d, t, _ in rows:
        if d is not None:
            first[root[prints[t]]] = min(d, first.get(root[prints[t]], d))
    got = Counter((r.doc_id, r.fp % (1 << 64), r.component_id) for r in simhash.near_duplicates(docs).collect())
    assert got == Counter((d, prints[t], first.get(root[prints[t]])) for d, t, _ in rows)
    assert simhash.near_duplicates(none).count() == 0


def test_index_finds_every_close_pair(spark):
    importable(spark)
    r = random.Random(9)
    centres = [r.getrandbits(64) for _ in range(150)]
    x = {c ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 3))) for c in centres for _ in range(12)} | {0, 1 << 63, 2**64 - 1}
    signed = sorted(v - (v >> 63 << 64) for v in x)
    near = [(a, b) for i, a in enumerate(signed) for b in signed[i + 1:] if ((a ^ b) % (1 << 64)).bit_count() <= 2]
    links = simhash.near_fingerprints(spark.createDataFrame([(v,) for v in signed], "fp long"), leaf=16).collect()
    assert components(signed, near) == components(signed, [(e.a, e.b) for e in links])


def test_near_pairs_of_fingerprints(spark):
    """Pairs are as near as they say, join what the index joins, and wider groups by way of their nearest."""
    importable(spark)
    r = random.Random(10)
    centres = [r.getrandbits(64) for _ in range(40)]
    x = {c ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 5))) for c in centres for _ in range(12)} | {0, 1 << 63, 2**64 - 1}
    signed = sorted(v - (v >> 63 << 64) for v in x)
    apart = lambda a, b: ((a ^ b) % (1 << 64)).bit_count()
    pairs = simhash.near_pairs(spark.createDataFrame([(v,) for v in signed], "fp long"), leaf=32).collect()
    assert all(0 < p.bits == apart(p.a, p.b) <= simhash.WIDE for p in pairs) and len(pairs) <= 5 * 2 * len(x)
    root = components(signed, [(p.a, p.b) for p in pairs])
    close = [(a, b) for i, a in enumerate(signed) for b in signed[i + 1:] if apart(a, b) <= simhash.DISTANCE]
    assert close and all(root[a] == root[b] for a, b in close)
    wide = [(a, b) for i, a in enumerate(signed) for b in signed[i + 1:] if apart(a, b) <= simhash.WIDE]
    assert len(set(root.values())) <= 1.1 * len(set(components(signed, wide).values()))
    assert simhash.near_pairs(spark.createDataFrame([], "fp long")).count() == 0


def test_shortest_forest():
    r = random.Random(12)
    links = [(r.randint(0, 60), r.randint(0, 60), r.randint(1, 4)) for _ in range(150)] + [(100, 101, 3), (101, 102, 1), (100, 102, 2)]
    a, b, n = map(np.array, zip(*links))
    some = shortest_forest(a, b, n)
    ids = set(a) | set(b)
    root = components(ids, [x[:2] for x in links])
    assert root == components(ids, [links[i][:2] for i in some]) and len(some) == len(ids) - len(set(root.values()))
    shortest, known = 0, {i: i for i in ids}  # one link after another, the shortest first
    for x, y, m in sorted(links, key=lambda x: x[2]):
        if known[x] != known[y]:
            shortest, known = shortest + m, {i: known[y] if k == known[x] else k for i, k in known.items()}
    assert sum(links[i][2] for i in some) == shortest
    assert len(shortest_forest(a[:0], b[:0], n[:0])) == 0


def test_substring_dedup(docs, rows, none):
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or ""))
    seen, want = set(), Counter()
    with_id = [r for r in order if r[0] is not None]
    for d, t, _ in with_id:
        w = words_of(t)
        gone = set()
        for i in range(len(w) - 19):
            key = tuple(w[i:i + 20])
            if key in seen:
                gone.update(range(i, i + 20))
            seen.add(key)
        kept = [x for i, x in enumerate(w) if i not in gone]
        want[d, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()] += 1
    out = substring_dedup.substring_dedup(docs).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in out if r.doc_id is not None) == want
    for r in out:
        assert hashlib.sha256(" ".join(words_of(r.text)).encode()).hexdigest() == r.kept_sha256
    assert sum(r.n_removed for r in out if r.doc_id is None) == 60
    assert len(out) == len(rows) and {r.text for r in out if r.n_words == 0} == {None, "", "  \n\t "}
    assert substring_dedup.substring_dedup(none).count() == 0



_PEAKS = """
import numpy as np, pyarrow as pa, pyarrow.compute as pc
from rollcall.llm import substring_dedup as s

words = np.random.default_rng(3).integers(0, 1 << 40, 900_000).astype(str)
texts = pa.array([" ".join(words[i:i + 450]) for i in range(0, len(words), 450)])
texts = pa.concat_arrays([texts.slice(0, 1800), texts.slice(0, 200)])
del words
size = texts.nbytes
schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])
table = pa.table({"doc_id": pa.array(range(2000), pa.int64()), "text": texts, "bucket": pa.array([7] * 2000, pa.int32())})

def peak(step, *more):
    field = lambda n: int(next(x for x in open("/proc/self/status") if x.startswith(n)).split()[1]) * 1024
    open("/proc/self/clear_refs", "w").write("5")
    before = field("VmRSS")
    out = step(*more)
    print((field("VmHWM") - before) / size)
    return out

sketch = peak(s._sketch(20, 2, 24, 8), table)
marks = peak(s._exact(20, 2, 24, 8), (pa.scalar(7),), table, sketch.slice(0, 1))
out = schema.append(pa.field("n_words", pa.int64())).append(pa.field("n_removed", pa.int64())).append(pa.field("kept_sha256", pa.string()))
left = peak(s._removed(20, out), (pa.scalar(7),), table, marks.filter(pc.equal(marks["part"], -1)))
print(pc.sum(left["n_removed"]).as_py())
"""


def test_substring_dedup_memory_of_a_bucket():
    """What each pass takes beside its bucket of 11 MB, as a multiple of it."""
    root = str(Path(corpus_pipeline.__file__).parent)
    done = subprocess.run([sys.executable, "-c", _PEAKS], cwd=root, env=os.environ | {"PYTHONPATH": root}, capture_output=True, text=True)
    assert not done.returncode, done.stderr
    sketch, exact, removed, words = map(float, done.stdout.split())
    assert words == 200 * 450
    assert sketch < 4 and exact < 4 and removed < 1.5, (sketch, exact, removed)


def test_mixing(docs, rows, none):
    got = mixing.mix(docs).collect()
    assert Counter(r.doc_id for r in got) == Counter(d for d, _, _ in rows)
    assert sorted(map(repr, got)) == sorted(map(repr, mixing.mix(docs.repartition(3)).collect()))
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(words_of(t))
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight, capped, total = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}, set(), 1.5 * sum(sizes.values())
    while True:
        left, share = total - sum(2 * sizes[s] for s in capped), sum(weight[s] for s in names if s not in capped)
        over = {s for s in names if s not in capped and left * weight[s] / share > 2 * sizes[s]}
        if not over:
            break
        capped |= over
    for s in names:
        mine = [r for r in got if r.source == s]
        goal = 2 * sizes[s] if s in capped else left * weight[s] / share
        assert all(abs(r.target - goal) < 1e-6 and r.source_size == sizes[s] and 0 <= r.taken <= 2 * r.size for r in mine)
        longest = max(r.size for r in mine)  # a document of a third of its source cannot be balanced away
        assert abs(sum(r.taken for r in mine) - goal) < 0.05 * goal + 20 + (longest if longest > sizes[s] / 3 else 0)
    assert mixing.mix(none).count() == 0
    assert mixing.mixed(docs).count() == sum(r.copies for r in got)


def test_flight_keeps_totals_and_probabilities():
    rng = np.random.default_rng(0)
    x = np.stack([rng.integers(1, 500, 200), np.ones(200)], axis=1).astype(float)
    runs = np.array([mixing.flight(np.full(200, 0.3), x, np.random.default_rng(k)) for k in range(300)])
    assert np.allclose(runs @ x, 0.3 * x.sum(0)) and (((runs > 1e-9) & (runs < 1 - 1e-9)).sum(1) <= 2).all()
    assert abs(runs.mean(0) - 0.3).max() < 0.12


class Bigrams:
    """The models of the scorer in plain Python, counts by Counter."""

    def __init__(self, texts, corpus=None):
        self.words, self.pairs, self.before, self.corpus = Counter(), Counter(), Counter(), corpus or self
        for t in texts:
            self.add(t, 1)

    def add(self, t, sign):
        w = [x.encode().lower() for x in words_of(t)]
        if w:
            self.words.update({x: sign * n for x, n in Counter([*w, "end"]).items()})
            self.before.update({x: sign * n for x, n in Counter(["start", *w]).items()})
            self.pairs.update({x: sign * n for x, n in Counter(zip(["start", *w], [*w, "end"])).items()})

    def p(self, a, b):
        c = self.corpus.words
        prior = (c[b] + lm_scoring.ADD) / (c.total() + lm_scoring.ADD * len(c))  # a count of 0 stays a key
        word = (self.words[b] + lm_scoring.WORD_WEIGHT * prior) / (self.words.total() + lm_scoring.WORD_WEIGHT)
        return (self.pairs[a, b] + lm_scoring.PAIR_WEIGHT * word) / (self.before[a] + lm_scoring.PAIR_WEIGHT)

    def loss(self, t):
        w = [x.encode().lower() for x in words_of(t)]
        return -sum(np.log(self.p(a, b)) for a, b in zip(["start", *w], [*w, "end"])) / (len(w) + 1)


def test_lm_scoring(spark, docs, rows, none):
    marked = {d for d, _, _ in rows if d is not None and d % 4 == 0}
    labels = spark.createDataFrame(
        [*((d, 1, 0) for d in sorted(marked)), (0, 1, 0), (6, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    # which of the others are drawn is read from the operator's own limits and digest
    texts = docs.select("doc_id", "text")
    limits = lm_scoring.matched_limits(texts, labels.where("quality = 1").select("doc_id").distinct().dropna())
    one = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    drawn = {(r.doc_id, r.text) for r in texts.where(F.pmod(F.xxhash64(one), F.lit(lm_scoring.DRAWS)) < limits[1]).collect()}
    good = [t for d, t, _ in rows if d in marked]
    others = [t for d, t, _ in rows if d not in marked and (d, t) in drawn]
    assert limits[0] == lm_scoring.DRAWS and others
    corpus = Bigrams([t for _, t, _ in rows])
    target, matched = Bigrams(good, corpus), Bigrams(others, corpus)
    vocabulary = list(corpus.words)
    for model in (target, matched, corpus):
        for a in ("start", vocabulary[0], vocabulary[-1], b"never seen"):
            assert sum(model.p(a, b) for b in vocabulary) == pytest.approx(1, abs=1e-9)
    out = lm_scoring.cross_entropy_difference(docs, labels).collect()
    assert Counter((r.doc_id, r.n_words) for r in out) == Counter((d, len(words_of(t))) for d, t, _ in rows)
    scores = {(r.doc_id, r.n_words): r for r in out}
    for d, t, _ in rows:
        if words_of(t):
            held = [corpus] + [target] * (d in marked) + [matched] * (d not in marked and (d, t) in drawn)
            for m in held:
                m.add(t, -1)
            x, y, z = target.loss(t), matched.loss(t), corpus.loss(t)
            for m in held:
                m.add(t, 1)
            r = scores[d, len(words_of(t))]
            assert (r.target_loss, r.matched_loss, r.background_loss, r.difference) == pytest.approx((x, y, z, x - y), rel=1e-9, abs=1e-9)
    assert all(r.difference is None for r in out if not r.n_words) and any(not r.n_words for r in out)
    assert lm_scoring.cross_entropy_difference(none, labels).count() == 0
    unlabelled = lm_scoring.cross_entropy_difference(docs, labels.limit(0)).collect()
    assert {r.difference for r in unlabelled} == {0.0, None} and len(unlabelled) == len(rows)


def test_lm_scoring_of_documents_without_a_label(spark):
    """Good documents whose label is hidden score like those whose label is known."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    scored = lm_scoring.cross_entropy_difference(docs, labels.where("doc_id % 2 = 0")).where("n_words > 0").join(
        labels.select("doc_id", "quality"), "doc_id")
    middle = {(r.quality, r.known): r.d for r in scored.groupBy("quality", (F.col("doc_id") % 2 == 0).alias("known")).agg(
        F.median("difference").alias("d")).collect()}
    assert abs(middle[1, True] - middle[1, False]) < 0.5
    assert middle[1, False] < 0 < middle[0, False]


def test_embeddings(spark):
    importable(spark)
    rng = np.random.default_rng(3)
    rows = []
    for i in range(60):
        centre = rng.standard_normal(64)
        for _ in range(int(rng.integers(1, 8))):
            v = centre + rng.standard_normal(64) * 0.09 * rng.random()
            rows.append((len(rows), [float(np.float32(a)) for a in v], i % 3))
    rows += [(900 + k, rows[0][1], 0) for k in range(5)] + [(950, rows[0][1], None), (951, None, 1), (952, [0.0] * 64, 1),
             (953, [float("nan")] * 64, 1), (954, [1.0, None], 1), (955, [1.0, 2.0], 1), (956, [2.0, 4.0], 1), (957, [], 1),
             (None, rows[1][1], rows[1][2]), (958, [float("inf")] + [1.0] * 63, 1)]
    table = spark.createDataFrame([(*r, 7) for r in rows], "vec_id long, embedding array<float>, label int, node int")
    ok = [i for i, (_, v, label) in enumerate(rows) if label is not None and v and all(a is not None and np.isfinite(a) for a in v) and any(v)]
    near = []
    for n, i in enumerate(ok):
        for j in ok[n + 1:]:
            a, b = np.array(rows[i][1]), np.array(rows[j][1])
            if rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.98:
                near.append((i, j))
    degree, root = Counter(x for p in near for x in p), components(range(len(rows)), near)
    first = {}
    for i in range(len(rows)):
        if rows[i][0] is not None:
            first[root[i]] = min(rows[i][0], first.get(root[i], rows[i][0]))
    got = Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_vectors(table).collect())
    want = Counter((rows[i][0], degree[i], first.get(root[i]), rows[i][0] is not None and rows[i][0] == first.get(root[i])) for i in range(len(rows)))
    assert len(near) > 50 and got == want
    assert embedding_dedup.near_vectors(table.limit(0)).count() == 0


def test_collision_count_recall():
    half, _, needed = embedding_dedup.windows(64, 0.98)
    rng, d = np.random.default_rng(5), embedding_dedup.directions(64)
    x = rng.standard_normal((400, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    side = rng.standard_normal((400, 64))
    side -= (side * x).sum(1)[:, None] * x
    side /= np.linalg.norm(side, axis=1)[:, None]
    y = 0.98 * x + np.sqrt(1 - 0.98**2) * side
    found = np.diag(embedding_dedup.collisions(x @ d, y @ d, half)) >= needed
    plain = (np.abs((x @ d)[:, None] - (y @ d)[None]) <= half).sum(-1)
    assert found.mean() > 0.99 and (embedding_dedup.collisions(x @ d, y @ d, half) == plain).all()


def test_packing(docs, rows, none):
    tokens = Tokenizer.from_file(TOKENS)
    want = Counter()
    for d, t, _ in rows:
        ids = np.array(tokens.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        for p in range(0, len(ids), 2048):
            want[d, p // 2048, p, len(ids[p:p + 2048]), zlib.crc32(ids[p:p + 2048].tobytes())] += 1
    out = packing.pack(docs, TOKENS).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
    placed = {}
    for r in out:
        placed.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in placed.values():
        s.sort()
        assert s[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(s, s[1:])) and sum(n for _, n in s) <= 2048
    assert len(placed) <= -(-sum(r.length for r in out) // 2048) + 1
    assert packing.pack(none, TOKENS).count() == 0


@pytest.mark.parametrize("rounds", [0, 3, 400])
def test_plan_covers_the_histogram(rounds):
    histogram = {2048: 3, 1500: 7, 700: 20, 500: 9, 48: 31, 1: 2}
    plan = packing.plan(histogram, rounds=rounds)
    used = Counter()
    for lengths, times in plan.items():
        assert sum(lengths) <= 2048 and times > 0
        for n in lengths:
            used[n] += times
    assert used == histogram


@pytest.mark.parametrize("total", [3_000, 20_000_000])
def test_plan_comes_from_the_fractional_solution(total):
    """Never beyond the demand, full configurations for most pieces' tokens, and a plan near the bound of whole sequences."""
    n = np.arange(1, 2049)
    share = np.exp(-(np.log(n) - 5.8) ** 2 / 1.6) / n
    demand = np.concatenate([[0], np.random.default_rng(5).multinomial(total, share / share.sum())])
    solution = packing.fractional(demand, packing.ROUNDS)
    used = np.zeros(2049)
    for (lengths, pieces), times in solution.items():
        assert times > 0 and sum(a * b for a, b in zip(lengths, pieces)) <= 2048
        for a, b in zip(lengths, pieces):
            used[a] += b * times
    assert (used <= demand * (1 + 1e-9)).all()
    tokens = (demand * np.arange(2049)).sum()
    assert (used * np.arange(2049)).sum() > 0.6 * tokens
    plan = packing.plan({i: int(k) for i, k in enumerate(demand) if k})
    covered = Counter()
    for lengths, times in plan.items():
        for a in lengths:
            covered[a] += times
    assert covered == {i: k for i, k in enumerate(demand) if k}
    assert sum(plan.values()) <= 1.001 * tokens / 2048 + 2


def test_warc_round_trip(spark, tmp_path):
    importable(spark)
    long = "ü" * 70_000
    pages = [(5, "http://a/x y", "p" * 100), (2, None, "p" * 100), (9, "u", "p" * 100), (3, "u", None), (4, "u", ""), (6, "u", "short"),
             (7, "u", "short"), (8, "u", long), (1, "u", "WARC/1.1\r\n\r\n" + "z" * 200), (None, "u", "n" * 150), (2, None, "p" * 100),
             (10, "u", long)]
    table = spark.createDataFrame([(*p, 1) for p in pages], "page_id long, url string, html string, digest int")
    warc.write_warc(table, f"{tmp_path}/w", records=4)
    out = warc.page_records(spark, f"{tmp_path}/w").collect()
    first = {"p" * 100: 2, long: 8}
    want = Counter()
    for p, _, html in pages:
        data = (html or "").encode()
        other = first.get(html, p)
        want[p, len(data), hashlib.sha256(data).hexdigest(), "response" if other == p else "revisit", None if other == p else other] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out) == want
    assert all(r.complete for r in out)
    payloads = {r.page_id: r.payload for r in warc.read_warc(spark, f"{tmp_path}/w").where("record_type <> 'revisit'").collect()}
    assert bytes(payloads[8]).decode() == long and bytes(payloads[3]) == b""
    warc.write_warc(table.limit(0), f"{tmp_path}/none")
    assert warc.page_records(spark, f"{tmp_path}/none").count() == 0


def test_broken_framing_and_segments():
    assert warc.payload_of(b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n" + warc.chunked(b"abc" * 5000)) == b"abc" * 5000
    assert warc.payload_of(b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n5\r\nab") is None
    assert warc.payload_of(b"HTTP/1.1 200 OK\r\n\r\nplain") == b"plain"


def first_rows(cells):
    """Of each group of near copies the row with the smallest id, null last; of one id's rows that of the smallest digest."""
    root = copies_of([t for _, t, _ in cells])
    groups = {}
    for i, (d, t, s) in enumerate(cells):
        groups.setdefault(root[i], []).append((d is None, d or 0))
    return Counter(min(g) for g in groups.values())


@pytest.mark.parametrize("kind", ["all", "repeated", "none"])
def test_pipeline_stages(spark, rows, kind):
    """Each stage beside the definition of what it keeps, on its predecessor's rows; null ids, repeated rows, no rows."""
    labels = "/root/testdata/sf0.001"
    cells = {"all": rows, "repeated": rows + rows[::3], "none": []}[kind]
    docs = made(spark, cells).select(*corpus_pipeline.COLUMNS)
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["quality", "near_dedup", "passages", "mixing", "packing"]
    kept = corpus_pipeline.near_dedup(spark, docs, labels)
    assert kept.columns == corpus_pipeline.COLUMNS
    first = first_rows(cells)
    assert Counter((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == first
    texts = corpus_pipeline.passages(spark, kept, labels)
    assert texts.columns == corpus_pipeline.COLUMNS and texts.count() == first.total()
    assert all(r.n_chars == len(r.text) for r in texts.collect() if r.text is not None)
    mixed = corpus_pipeline.mixing(spark, texts, labels)
    assert Counter(r.doc_id for r in mixed.collect()) == sum(
        (Counter({r.doc_id: r.copies}) for r in mixing.mix(texts).collect() if r.copies), Counter())
    packed = corpus_pipeline.packing(spark, mixed, labels)
    assert packed.where("piece = 0").count() == mixed.count()


def test_pipeline_quality_rejects_bad_documents(spark, tmp_path):
    """Junk goes, prose stays, labelled or not; null and empty texts and ids have a verdict; no rows give none."""
    r = random.Random(8)
    prose = lambda: " ".join(r.choice("the river runs past old mills and slow green fields in early light".split()) for _ in range(120))
    junk = lambda: " ".join(r.choice(["BUY!!", "$$$", "NOW!!", "###", "WIN"]) for _ in range(120))
    cells = [(i, junk() if i % 3 == 0 else prose(), "ab"[i % 2]) for i in range(300)] + [(None, prose(), None), (None, junk(), "a"), (500, None, "a"), (501, "", None)]
    spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(0, 300, 2)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = made(spark, cells).select(*corpus_pipeline.COLUMNS)
    kept = Counter((x.doc_id, x.text) for x in corpus_pipeline.quality(spark, docs, str(tmp_path)).collect())
    good = Counter((d, t) for d, t, _ in cells if t and "river" in t)
    bad = Counter((d, t) for d, t, _ in cells if t and "BUY" in t)
    assert good <= kept and not kept & bad
    assert corpus_pipeline.quality(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_parities_bound_the_difference():
    r = np.random.default_rng(3)
    for n in (0, 1, 5, 40, 700, 5000):
        x = np.unique(r.integers(-2**63, 2**63 - 1, n, np.int64))
        y = np.unique(np.concatenate([x[: round(n * 0.9)], r.integers(-2**63, 2**63 - 1, n // 9, np.int64)]))
        p, q = near_copies.parities(x), near_copies.parities(y)
        while len(p) != len(q):
            long, short = (p, q) if len(p) > len(q) else (q, p)
            long = long[: len(long) // 2] ^ long[len(long) // 2:]
            p, q = long, short
        assert sum(int(v).bit_count() for v in (p ^ q).view(np.uint64)) <= len(np.setxor1d(x, y))


def copies_of(texts):
    """Components of the texts by brute force: Jaccard of five-word shingles of at least 0.8."""
    sets = []
    for t in texts:
        w = [x.encode().lower() for x in words_of(t)]
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    near = [(i, j) for j, y in enumerate(sets) for i, x in enumerate(sets[:j]) if x == y or 10 * len(x & y) >= 8 * len(x | y)]
    return components(range(len(texts)), near)


@pytest.fixture(scope="module")
def edited():
    """Texts in all degrees of likeness: edited words, cut ends, chains of edits, one passage in many."""
    r = random.Random(11)
    word = lambda: f"v{r.randint(0, 5000)}"
    out = []
    for _ in range(25):
        base = [word() for _ in range(r.randint(3, 200))]
        out.append(base)
        for edits in (1, 1, 2, 4, 7):
            new = list(r.choice(out[-3:]))
            for i in r.sample(range(len(new)), min(edits, len(new))):
                new[i] = word()
            out.append(new)
        out.append(base[: round(len(base) * r.choice((0.78, 0.8, 0.82, 0.9)))])
    passage = [word() for _ in range(90)]
    out += [passage + [word() for _ in range(r.randint(5, 40))] for _ in range(40)]
    return [" ".join(w) for w in out] + [" ".join(out[0]).upper()] + ["", None, " \n"]


@pytest.mark.parametrize("sample", [1, 16])
def test_near_copies(spark, edited, sample):
    root = copies_of(edited)
    got = near_copies.first_of_copies(made(spark, [(i, t, "a") for i, t in enumerate(edited)]).repartition(5), "doc_id", sample=sample)
    assert len(set(root.values())) < len(edited) - 60 and sorted(r.doc_id for r in got.collect()) == sorted(set(root.values()))


def test_near_copies_of_a_large_group(spark, monkeypatch):
    """Fingerprints join most of a group of near copies before pairs of a shared shingle are listed."""
    r = random.Random(13)
    word = lambda: f"v{r.randint(0, 9000)}"
    base, texts = [word() for _ in range(150)], []
    for _ in range(400):
        new = list(base)
        for i in r.sample(range(150), r.choice((1, 2, 2))):
            new[i] = word()
        texts.append(" ".join(new))
    steps, candidates = [], near_copies._candidates

    def counted(pairs, *rest):
        steps.append(pairs.count())
        return candidates(pairs, *rest)

    monkeypatch.setattr(near_copies, "_candidates", counted)
    got = near_copies.first_of_copies(made(spark, [(i, t, "a") for i, t in enumerate(texts)]).repartition(4), "doc_id")
    assert sorted(x.doc_id for x in got.collect()) == sorted(set(copies_of(texts).values()))
    assert sum(steps) < 8 * len(texts)


def test_pipeline_near_dedup_by_jaccard(spark, edited):
    docs = made(spark, [(i, t, "a") for i, t in enumerate(edited)]).select(*corpus_pipeline.COLUMNS)
    kept = corpus_pipeline.near_dedup(spark, docs, "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(copies_of(edited).values()))
    assert corpus_pipeline.near_dedup(spark, docs.limit(0), "").count() == 0


def test_pipeline_near_dedup_without_or_with_shared_ids(spark, rows):
    alone, other, third = ("".join(f"{c}{i} " for i in range(40)) for c in "xyz")
    cells = [*rows, (None, alone, "a"), (None, alone + "more", None), (7000, other, None), (7000, third, "b"), (7000, other, "c"),
             (7001, third, "a"), (None, other, "a"), (None, None, None)]
    docs = made(spark, cells).select(*corpus_pipeline.COLUMNS)
    extra = [(9000, alone + "more and", None, None, None), (9001, "no language " * 9, None, "a", None), (9001, "no length", "en", None, None)]
    docs = docs.union(spark.createDataFrame(extra, docs.schema))
    texts = [t for _, t, _ in cells] + [e[1] for e in extra]
    root = copies_of(texts)
    ids = [d for d, _, _ in cells] + [e[0] for e in extra]
    least = {}
    for i, d in enumerate(ids):
        least[root[i]] = min(least.get(root[i], (True, 0)), (d is None, d or 0))
    kept = corpus_pipeline.near_dedup(spark, docs.repartition(3), "").collect()
    groups = [root[texts.index(r.text)] for r in kept]
    assert len(groups) == len(set(groups)) == len(set(root.values()))
    assert all((r.doc_id is None, r.doc_id or 0) == least[g] for r, g in zip(kept, groups))
    assert any(r.doc_id is None for r in kept) and sum(r.doc_id == 7000 for r in kept) == 2
    again = corpus_pipeline.near_dedup(spark, docs.repartition(7, "text"), "").collect()
    assert sorted(map(repr, again)) == sorted(map(repr, kept))


def test_pipeline_run(spark):
    folder = "/root/testdata/sf0.001"
    importable(spark)
    good = corpus_pipeline.quality(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
    clean = spark.read.parquet(f"{folder}/labels.parquet").where("quality = 1")
    found = good.join(clean, "doc_id").count() / clean.count()
    assert found > 0.97 and corpus_pipeline.run(spark, folder).count() > 0
