"""Quality rules: a table of thresholds compiled into one projection of built-in functions."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from rollcall.llm.text import let, lines_of, need, number_of, words_of

SYMBOLS = "#*$%&|<>"

# Frequent function words of English, German, French and Spanish
STOP_WORDS = (
    "the of and to a in is that it for on was with as be by this are at from or an "
    "der die und den von zu das mit sich des auf für ist im nicht ein eine dem "
    "de la le et les en un du une que est pour dans qui au par sur pas il ne "
    "el y los se del las con una su al lo como más pero sus"
).split()


@dataclass(frozen=True)
class Rule:
    """A metric of ``metrics`` and the closed range it has to lie in (None: open)."""

    name: str
    metric: str
    low: float | None = None
    high: float | None = None

    def holds(self, values: dict[str, Column]) -> Column:
        value, ok = values[self.metric], F.lit(True)
        if self.low is not None:
            ok = ok & (value >= self.low)
        if self.high is not None:
            ok = ok & (value <= self.high)
        return ok


RULES = (
    Rule("length", "n_words", 50, None),
    Rule("word_length", "mean_word_length", 3.0, 12.0),
    Rule("symbols", "symbols_per_word", None, 0.10),
    Rule("exclamations", "exclamations_per_word", None, 0.30),
    Rule("stop_words", "stop_word_ratio", 0.04, None),
    Rule("repeated_lines", "repeated_line_ratio", None, 0.40),
    Rule("cut_lines", "ellipsis_line_ratio", None, 0.30),
    Rule("bullets", "bullet_line_ratio", None, 0.90),
)


POSITION_BITS = 24  # room for a word's place beside the hash of its window; longer texts compare all windows


def _window(w: Column, i: Column) -> Column:
    return F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))


def _covered(w: Column, starts: Column) -> Column:
    """Words in those 3-word windows, among the given starts, that are found twice or more."""
    def pairs(z: Column) -> Column:
        return F.zip_with(
            F.slice(z, 1, F.size(z) - 1), F.slice(z, 2, F.size(z) - 1),
            lambda a, b: F.when(a["s"] == b["s"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")),
        )

    windows = F.sort_array(F.transform(starts, lambda i: F.struct(_window(w, i).alias("s"), i.alias("i"))))
    found = let(windows, lambda z: F.array_distinct(F.flatten(pairs(z))))
    return F.size(F.array_distinct(F.flatten(F.transform(found, lambda p: F.array(p, p + 1, p + 2)))))


def with_repeats(df: DataFrame) -> DataFrame:
    """``df`` with ``n_repeat_words``: words of array ``w`` in a 3-word window found twice or more in it.

    Hashes of windows tell the texts and places to look at; only there windows are
    compared word by word, so a clash of hashes changes nothing.
    """
    w, h = F.col("w"), F.col("h")
    place = (1 << POSITION_BITS) - 1
    starts = F.sequence(F.lit(0), F.size(w) - 3)
    hashed = df.withColumn("h", F.when(F.size(w) >= 4, F.transform(
        starts, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
    )).otherwise(F.array().cast("array<bigint>")))
    packed = F.sort_array(F.transform(h, lambda x, i: x.bitwiseAND(F.lit(~place)).bitwiseOR(i.cast("long"))))
    suspects = hashed.withColumn("z", F.when(
        (F.size(F.array_distinct(h)) < F.size(h)) & (F.size(h) <= place), packed
    ).otherwise(F.array().cast("array<bigint>")))
    z, key = F.col("z"), lambda x: F.shiftright(x, POSITION_BITS)
    near = F.filter(z, lambda x, i: (key(x) == key(F.get(z, i + 1))) | (key(x) == key(F.get(z, i - 1))))
    candidates = F.when(F.size(h) > place, starts).otherwise(F.transform(near, lambda x: x.bitwiseAND(F.lit(place)).cast("int")))
    placed = suspects.withColumn("c", F.when((F.size(z) > 0) | (F.size(h) > place), candidates).otherwise(
        F.array().cast("array<int>")))
    return placed.withColumn(
        "n_repeat_words", F.when(F.size("c") > 1, _covered(w, F.col("c"))).otherwise(0).cast("long")).drop("h", "z", "c")


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b == 0, 0.0).otherwise(a.cast("double") / b)


def with_counts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the counts of each text, in steps that each use the arrays of the one before."""
    arrays = need(docs, "doc_id", "text").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), words_of(F.col("text")).alias("w"),
        lines_of(F.col("text")).alias("l"),
    )
    w, lines = F.col("w"), F.col("l")
    return with_repeats(arrays).select(
        "doc_id", "n_repeat_words",
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        number_of(F.col("text"), SYMBOLS).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        number_of(F.col("text"), "!").cast("long").alias("n_exclamations"),
        F.size(F.filter(w, lambda x: x.isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.size(lines).cast("long").alias("n_lines"),
        F.size(F.filter(lines, lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…"))).cast("long").alias("n_ellipsis"),
        F.size(F.filter(lines, lambda x: F.substring(F.ltrim(x), 1, 1).isin("-", "*", "•"))).cast("long").alias("n_bullets"),
    )


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: its counts, ``base_failed``, the names of the rules it breaks and ``kept``.

    A null text is an empty one: no words, not kept. Repeated rows are judged one by
    one and alike; a null doc_id is passed on. Other columns of ``docs`` are not
    read. Nothing is shuffled: every row is judged from its own text.
    """
    m = with_counts(docs)
    c = {f: F.col(f) for f in m.columns if f != "doc_id"}
    values = c | {
        "mean_word_length": _ratio(c["word_chars"], c["n_words"]),
        "symbols_per_word": _ratio(c["n_symbols"], c["n_words"]),
        "exclamations_per_word": _ratio(c["n_exclamations"], c["n_words"]),
        "stop_word_ratio": _ratio(c["n_stop_words"], c["n_words"]),
        "repeated_line_ratio": _ratio(c["n_dup_lines"], c["n_lines"]),
        "ellipsis_line_ratio": _ratio(c["n_ellipsis"], c["n_lines"]),
        "bullet_line_ratio": _ratio(c["n_bullets"], c["n_lines"]),
    }
    base_failed = (c["n_words"] < 50) | (100 * c["n_repeat_words"] > 50 * c["n_words"])
    verdict = reduce(lambda a, b: a & b, [r.holds(values) for r in rules], F.lit(True))
    broken = F.array_compact(F.array(*[F.when(~r.holds(values), F.lit(r.name)) for r in rules])) if rules else F.array()
    return m.select(
        "doc_id", *[c[f].alias(f) for f in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        base_failed.alias("base_failed"), (~base_failed & verdict).alias("kept"),
        F.concat_ws(",", broken).alias("broken_rules"), c["n_stop_words"].alias("n_stop_words"), c["n_lines"].alias("n_lines"),
    )
