"""How document filters act on one another in every order: packed counters over the sets of filters a document fails."""

from __future__ import annotations

from itertools import permutations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from rollcall.llm.text import need, number_of, words_of

FILTERS = "ABCDE"
_SAME = "E"  # fails a text that a smaller id has too; the others look at the text alone
OUT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


def _fails(text: Column, words: Column) -> dict[str, Column]:
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        "C": 100 * number_of(text, "A-Z") > 10 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def masks(docs: DataFrame) -> DataFrame:
    """(doc_id, part, digest, mask): a bit for each filter on the text alone that a document fails."""
    plain = need(docs, "doc_id", "text", "lang").select(
        "doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    fails = _fails(F.col("text"), F.col("_w"))
    bits = [F.when(fails[f], F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(FILTERS) if f in fails]
    mask = bits[0]
    for b in bits[1:]:
        mask = mask + b
    return plain.withColumn("_w", words_of(F.col("text"))).select(
        "doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), mask.alias("mask"))


def _marked(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows with ``good`` and ``toxic``. Rows without an id carry their digest as key, so that they are spread over all tasks."""
    marks = need(labels, "doc_id", "quality", "toxic").where("doc_id is not null").groupBy(
        F.col("doc_id").cast("string").alias("key")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    keyed = rows.withColumn("key", F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("no id "), F.hex("digest"))))
    no = F.lit(False)
    return keyed.join(marks, "key", "left").drop("key").withColumns(
        {"good": F.coalesce("good", no), "toxic": F.coalesce("toxic", no)})


def counts_by_mask(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents by the filters they fail, a row per part and mask.

    Equal texts fail alike but for the last filter: of each digest's rows those of
    its smallest id pass it, and those without an id. A digest's rows are counted
    by id, then by part and label, before any window sees them, so a group of
    copies of any size is a few rows.
    """
    once = masks(docs).groupBy("doc_id", "digest", "mask", "part").agg(F.count(F.lit(1)).alias("c"))
    known = F.col("doc_id").isNotNull()
    alike = _marked(once, labels).groupBy("digest", "mask", "part", "good", "toxic").agg(
        F.sum("c").alias("n"), F.sum(F.when(known, F.lit(0)).otherwise(F.col("c"))).alias("nameless"),
        F.min(F.when(known, F.struct("doc_id", "c"))).alias("first"))
    smallest = F.min("first.doc_id").over(Window.partitionBy("digest"))
    passing = F.col("nameless") + F.when(F.col("first.doc_id") == F.col("smallest"), F.col("first.c")).otherwise(F.lit(0))
    bit = F.lit(1 << FILTERS.index(_SAME))
    both = alike.withColumn("smallest", smallest).withColumn("passing", passing).select(
        "part", "good", "toxic", F.explode(F.array(
            F.struct(F.col("mask"), F.col("passing").alias("n")),
            F.struct(F.col("mask").bitwiseOR(bit).alias("mask"), (F.col("n") - F.col("passing")).alias("n")))).alias("x"))
    of = lambda c: F.sum(F.when(F.col(c), F.col("x.n")).otherwise(F.lit(0)))
    return both.groupBy("part", F.col("x.mask").alias("mask")).agg(
        F.sum("x.n").alias("n"), of("good").alias("good"), of("toxic").alias("toxic")).where("n > 0")


def outcomes(mask: int, orders: list[tuple[int, ...]], width: int) -> tuple[int, int]:
    """Two integers with a field of ``width`` bits per order and step: removed at this step, and failing it but removed before."""
    removed = redundant = 0
    for k, order in enumerate(orders):
        gone = False
        for step, f in enumerate(order):
            if mask >> f & 1:
                at = 1 << (k * len(order) + step) * width
                removed, redundant = (removed, redundant + at) if gone else (removed + at, redundant)
                gone = True
    return removed, redundant


def unpacked(total: int, fields: int, width: int) -> list[int]:
    """The fields of a packed integer, the lowest first."""
    return [total >> i * width & (1 << width) - 1 for i in range(fields)]


def part_report(counts: pd.DataFrame) -> pd.DataFrame:
    """All orders and steps of one part from its at most 2^5 counts by mask.

    Each count times its mask's integer is added up once for all documents, the
    good and the toxic ones. A field is wide enough for the part's number of
    documents, and no field can hold more, so none runs over into the next.
    """
    rows = [tuple(map(int, r)) for r in counts[["mask", "n", "good", "toxic"]].itertuples(index=False)]
    size = sum(n for _, n, _, _ in rows)
    width, orders = size.bit_length(), list(permutations(range(len(FILTERS))))
    fields = len(orders) * len(FILTERS)
    removed = redundant = good = toxic = 0
    for mask, n, g, t in rows:
        here, before = outcomes(mask, orders, width)
        removed, redundant, good, toxic = removed + n * here, redundant + n * before, good + g * here, toxic + t * here
    removed, redundant, good, toxic = (unpacked(x, fields, width) for x in (removed, redundant, good, toxic))
    alone = {1 << f: sum(n for m, n, _, _ in rows if m == 1 << f) for f in range(len(FILTERS))}
    share = [0] * len(FILTERS)
    for k, order in enumerate(orders):
        for step, f in enumerate(order):
            share[f] += removed[k * len(order) + step]
    out = []
    for k, order in enumerate(orders):
        kept, name = size, "".join(FILTERS[f] for f in order)
        for step, f in enumerate(order):
            i = k * len(order) + step
            kept -= removed[i]
            out.append((name, step + 1, kept, removed[i], redundant[i], alone[1 << f], good[i], toxic[i], share[f]))
    names = [c.split()[0] for c in OUT.split(", ")]
    return pd.DataFrame(out, columns=names[1:]).assign(part=counts["part"].iloc[0])[names]


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What every filter removes at every place of every order, per ``lang``: the columns of ``OUT``.

    A null text is an empty one and equal to it; a null lang is the empty part. A
    null id is no smaller id and has no label. A repeated row counts each time; of
    rows that share their smallest id and text all pass the last filter. A
    document is good or toxic if any of its labels says so. Other columns are not
    read; no rows give no rows. Texts are compared by SHA-256.

    Texts are read once and leave the scan as (id, part, digest, mask). One part's
    counts are at most 32 rows, so a part with most of the documents is no larger
    a task than another.
    """
    return counts_by_mask(docs, labels).groupBy("part").applyInPandas(part_report, OUT)
