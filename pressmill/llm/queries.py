"""Runnable queries of this subpackage, over whole tables, and SQL for those it can express."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressmill.functions.pinning import pin
from pressmill.llm import (
    bpe, debruijn, filter_audit, grid_join, licences, packing, part_enum, posting_lists, quality,
    recompression, suffix_tree, toxicity, weighted_sampling,
)
from pressmill.llm.common import crc_of_id

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def quality_model(docs: DataFrame, labels: DataFrame) -> quality.Model:
    return quality.fit(docs, labels, "quality", crc_of_id() % 3 != 1)


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    return toxicity.fit(docs, labels, "toxic", crc_of_id() % 5 != 0)


@query
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.score(docs, quality_model(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (crc_of_id() % 3 == 1).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = bpe.encode(table(spark, sf_dir, "documents"), path, pattern)
    return bpe.decode(encoded, path, pattern).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join("ids", " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op7_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


ORACLE["op7_licence_scan"] = licences.scan_sql()


@query
def op8_grid_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_join.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)


@query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pieces(table(spark, sf_dir, "documents"),
                            public_tokenizers.path("word_bpe_49k.json"), end_id=2, limit=4096)
    return packing.pack(pieces, 4096)


@query
def op3_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = suffix_tree.score(table(spark, sf_dir, "documents"), crc_of_id() % 5 != 1)
    return scored.withColumn("held_out", crc_of_id() % 5 == 1)


@query
def op4_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = debruijn.remove_repeats(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_words", "n_removed",
                          F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity_model(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (crc_of_id() % 5 == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = weighted_sampling.compare_with_next(table(spark, sf_dir, "documents"))
    return compared.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", "near_edited", "near_next")


@query
def op10_part_enum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_enum.similarity_components(table(spark, sf_dir, "documents"), size=4, percent=85)


@query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE["op12_filter_audit"] = filter_audit.audit_sql()


def planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: every tenth text by crc32 of its id goes on periodically from one of its words."""
    h = crc_of_id()
    g = F.floor(h / 10)
    words = filter_audit.words(F.coalesce(F.col("text").cast("string"), F.lit("")))
    chosen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    cut = pin(chosen, words=F.when(h % 10 == 0, words))
    n = F.nullif(F.size("words"), F.lit(0))
    first = (g % n).cast("int")
    made = pin(cut, first=first, period=(1 + F.floor((n - first) / (3 + g % 8))).cast("int"))
    again = F.flatten(F.array_repeat(F.slice("words", F.col("first") + 1, F.col("period")),
                                     F.ceil((n - F.col("first")) / F.col("period")).cast("int")))
    planted = F.array_join(F.slice(F.concat(F.slice("words", F.lit(1), F.col("first")), again), F.lit(1), n), " ")
    return made.select("doc_id", F.when(F.col("first").isNotNull(), planted).otherwise(F.col("text")).alias("text"))


@query
def op11_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = recompression.periodic_runs(planted_runs(table(spark, sf_dir, "documents")))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    best = found.withColumn("best", recompression.strongest())
    return best.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


@query
def op13_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posting_lists.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)
