"""One query per operator over its whole table, and the reference SQL where SQL can express it."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from rollcall.llm import (
    centroid_clusters, embedding_dedup, filter_audit, license_scan, lm_scoring, mixing, nnls_packing, packing, quality_classifier, quality_rules, simhash, substring_dedup, warc,
)
from rollcall.llm.reference_sql import CENTROID_CLUSTERS, FILTER_AUDIT, LICENSE_SCAN, QUALITY_RULES
from rollcall.session import shared_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
REFERENCE_SQL: dict[str, str] = {}


def importable(spark: SparkSession) -> None:
    """Python workers find this package where the driver has it."""
    root, known = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))


def query(name: str, sql: str | None = None):
    def register(function):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            importable(spark)
            return function(spark, folder)

        QUERIES[name] = run
        if sql:
            REFERENCE_SQL[name] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op2_quality_rules", QUALITY_RULES)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, folder, "documents"))


@query("op8_quality_classifier")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", "lang", "text")
    return quality_classifier.classify(docs, table(spark, folder, "labels"), keep_text=False)


@query("op9_license_scan", LICENSE_SCAN)
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.license_scan(table(spark, folder, "documents"))


@query("op3_simhash")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op10_packing")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op4_substring_dedup")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return substring_dedup.substring_dedup(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")


@query("op5_mixing")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


@query("op7_embedding_dedup")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, folder, "embeddings"))


@query("op6_lm_scoring")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return lm_scoring.cross_entropy_difference(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op1_warc")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_path(spark, "warc")
    warc.write_warc(table(spark, folder, "pages"), path)
    return warc.page_records(spark, path)


@query("op11_centroid_clusters", CENTROID_CLUSTERS)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return centroid_clusters.cluster(table(spark, folder, "embeddings"))


@query("op13_filter_audit", FILTER_AUDIT)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op12_nnls_packing")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return nnls_packing.pack(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
