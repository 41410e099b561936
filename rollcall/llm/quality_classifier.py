"""Quality classifier: a document's own evidence, host and path posteriors, hierarchical empirical Bayes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from rollcall.llm.quality_rules import SYMBOLS
from rollcall.llm.text import lines_of, number_of, words_of
from rollcall.session import written

LABELLED_ROWS = 5_000  # bound of the labelled sample the classifier is fitted on
FEATURES = ("log_words", "word_length", "symbols", "capitals", "different", "same_lines")


def with_features(docs: DataFrame) -> DataFrame:
    """``docs`` with array ``x``: six figures of ``text``, those of an empty text for null."""
    text, w, lines = F.coalesce("text", F.lit("")), F.col("_w"), F.col("_l")
    n = F.greatest(F.size(w), F.lit(1)).cast("double")
    return docs.withColumns({"_w": words_of(text), "_l": lines_of(text)}).withColumn("x", F.array(
        F.log(n),
        F.length(F.array_join(w, "")) / n,
        F.least(number_of(text, SYMBOLS + "!") / n, F.lit(1.0)),
        F.length(F.regexp_replace(text, r"[^\p{Lu}]+", "")) / F.greatest(F.length(text), F.lit(1)),
        F.size(F.array_distinct(w)) / n,
        (F.size(lines) - F.size(F.array_distinct(lines))) / F.greatest(F.size(lines), F.lit(1)).cast("double"),
    )).drop("_w", "_l")


@dataclass(frozen=True)
class Model:
    """Logistic weights over centred and scaled features, and the share of good documents they were fitted with."""

    centre: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    bias: float
    prior: float

    def log_odds(self, x: Column) -> Column:
        total = F.lit(self.bias)
        for i, (c, s, w) in enumerate(zip(self.centre, self.scale, self.weights)):
            total = total + (F.get(x, F.lit(i)) - c) * (w / s)
        return total


def fit(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS, ridge: float = 1.0) -> Model:
    """Fit on at most ``rows`` labelled documents, the first in the order of a hash of the id.

    An id with labels of both kinds counts as bad; one with several texts has the
    smallest of their figures. So every run fits the same weights.
    Without labels of both kinds the weights are zero and only the prior speaks.
    """
    marked = (
        labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id", F.lit(8)), "doc_id").limit(rows)
    )
    seen = (
        with_features(docs.select("doc_id", "text").join(F.broadcast(marked), "doc_id"))  # at most ``rows`` narrow rows
        .groupBy("doc_id").agg(F.min("quality").alias("quality"), F.min("x").alias("x")).orderBy("doc_id").limit(rows).collect()
    )
    y = np.array([r["quality"] for r in seen], dtype=float)
    n = len(FEATURES)
    prior = (y.sum() + 1) / (len(y) + 2)
    if len(y) == 0 or y.min() == y.max():
        return Model((0.0,) * n, (1.0,) * n, (0.0,) * n, float(np.log(prior / (1 - prior))), float(prior))
    x = np.array([r["x"] for r in seen])
    centre, scale = x.mean(0), np.maximum(x.std(0), 1e-9)
    z = np.hstack([(x - centre) / scale, np.ones((len(x), 1))])
    w, penalty = np.zeros(n + 1), np.diag([ridge] * n + [1e-6])
    for _ in range(50):  # Newton steps
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty, z.T @ (y - p) - penalty @ w)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return Model(tuple(map(float, centre)), tuple(map(float, scale)), tuple(map(float, w[:-1])), float(w[-1]), float(prior))


def _strength(groups: DataFrame, total: str, n: str, mean: Column) -> float:
    """Prior strength by moments: spread of group means beyond what their sizes explain."""
    share = F.col(total) / F.col(n)
    r = groups.agg(
        F.sum(F.col(n) * (share - mean) ** 2).alias("between"), F.sum(mean * (1 - mean)).alias("noise"),
        F.sum(F.col(n)).alias("n"), F.avg(mean * (1 - mean)).alias("v"),
    ).first()
    if not r["n"] or not r["v"]:
        return 100.0
    spread = max(0.0, (r["between"] - r["noise"]) / r["n"])
    return float(min(1e6, max(1.0, r["v"] / spread if spread else 1e6)))


def site_posteriors(scored: DataFrame) -> DataFrame:
    """Posterior share of good documents per (host, path), from ``host``, ``path`` and ``p`` of every document.

    One grouped aggregation to (host, path), pre-combined in every task; all
    later steps read those few rows. A path is shrunk towards its host and a
    host towards the whole corpus. Null hosts and paths are groups like others.
    """
    paths = scored.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("s"))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"))
    whole = hosts.agg(F.sum("hs").alias("s"), F.sum("hn").alias("n")).first()
    mu = min(max((whole["s"] or 0.0) / whole["n"], 1e-4), 1 - 1e-4) if whole["n"] else 0.5
    k = _strength(hosts, "hs", "hn", F.lit(mu))
    hosts = hosts.withColumn("host_posterior", (F.col("hs") + k * mu) / (F.col("hn") + k))
    both = paths.join(hosts, paths["host"].eqNullSafe(hosts["host"])).drop(hosts["host"])
    k = _strength(both, "s", "n", F.col("host_posterior"))
    return both.select(
        "host", "path", "n", "host_posterior",
        ((F.col("s") + k * F.col("host_posterior")) / (F.col("n") + k)).alias("path_posterior"),
    )


def classify(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", rows: int = LABELLED_ROWS,
             threshold: float = 0.5, keep_text: bool = True) -> DataFrame:
    """``docs`` with ``evidence``, ``host_posterior``, ``path_posterior``, ``posterior`` and ``kept``.

    ``evidence`` is the log-odds that the document's own text adds to the prior;
    the path's posterior takes the prior's place. A null text has the features of
    an empty one; a null doc_id, host or path is judged like others; repeated rows
    are judged alike; ``docs`` without rows gives none. Columns of ``docs`` with
    these names are replaced; ``keep_text=False`` drops the text. A document of an
    unlabelled corpus has evidence 0. Both the site totals and the verdicts need the
    figures of a text. Without the text the scored rows are written to the shared
    folder once; with it they are worked out a second time, since a copy of all
    texts costs more. Only one row per path is joined back.
    """
    model = fit(docs, labels, rows)
    base = float(np.log(model.prior / (1 - model.prior)))
    own = ["evidence", "host_posterior", "path_posterior", "posterior", "kept"]
    odds = F.greatest(F.least(model.log_odds(F.col("x")), F.lit(30.0)), F.lit(-30.0))
    scored = with_features(docs.drop(*own)).withColumn("evidence", odds - base).drop("x")
    if not keep_text:
        scored = written(scored.drop("text"), "quality-evidence")
    sites = site_posteriors(scored.select(
        F.col(host).alias("host"), F.col(path).alias("path"), (1 / (1 + F.exp(-(F.col("evidence") + base)))).alias("p")
    )).select(F.col("host").alias("_host"), F.col("path").alias("_path"), "host_posterior", "path_posterior")
    at = F.greatest(F.least(F.col("path_posterior"), F.lit(1 - 1e-4)), F.lit(1e-4))
    return (
        scored.join(sites, F.col(host).eqNullSafe(F.col("_host")) & F.col(path).eqNullSafe(F.col("_path")), "left")
        .withColumn("posterior", 1 / (1 + F.exp(-(F.col("evidence") + F.log(at / (1 - at))))))
        .withColumn("kept", F.col("posterior") >= threshold)
        .drop("_host", "_path")
    )
