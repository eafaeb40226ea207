"""The registered queries of the text operators; each reads whole tables of one data folder."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import (
    checks, embeddings, fill_middle, neardup, ngram_bloom, packing, pieces, pii, quality_rules, relative_parsing, resampling,
    revisits, toxicity, weak_labels,
)
from tidemark.llm.common import fold, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {
    "op11_target_resampling": checks.RESAMPLING,
    "op12_substring_dedup": checks.REPEATS,
    "op13_fill_in_middle": checks.FILL_IN_MIDDLE,
}


def query(job: Callable[[SparkSession, str], DataFrame]):
    QUERIES[job.__name__] = job
    return job


@query
def op5_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, folder, "documents"))


@query
def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held = fold("doc_id") == 0
    model = toxicity.train(docs.filter(~held), table(spark, folder, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", (fold("doc_id") == 0).alias("held_out"), "score", "predicted")


@query
def op7_sentencepiece_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.round_trip(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op8_minimum_slack_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op1_warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    resolved = revisits.resolve_revisits(revisits.crawl_records(table(spark, folder, "pages")))
    return resolved.select(
        F.col("record_id").cast("bigint").alias("record_id"), "url_key", F.col("response_id").cast("bigint").alias("response_id"),
        "outcome", revisits.headers_text(F.col("headers")).alias("headers"), "digest",
    )


@query
def op3_pii_spans(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digest(table(spark, folder, "documents"))


@query
def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op10_weak_label_quality(spark: SparkSession, folder: str) -> DataFrame:
    return weak_labels.classify(table(spark, folder, "documents"))


@query
def op6_ngram_bloom_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    scored = ngram_bloom.score(docs, fold("doc_id") != 1)
    return scored.select(
        "doc_id", (fold("doc_id") == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@query
def op9_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_duplicate_vectors(table(spark, folder, "embeddings"))


@query
def op11_target_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resampling.digest(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op12_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return relative_parsing.digest(table(spark, folder, "documents"))


@query
def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    return fill_middle.digest(table(spark, folder, "documents"))
