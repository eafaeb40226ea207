"""The corpus pipeline: stages over documents, each written and read again.

Each stage works on all that its predecessor kept.  The first four return the columns of the documents
they get, the last one the pieces of the packed sequences.  Stages judge rows, not ids: rows that repeat an
id, or have none, get the verdict of their own text.  Every stage gives an empty result for an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import neardup, packing, pii, quality_rules, weak_labels
from tidemark.llm.common import join_ids, table
from tidemark.operators.materialise import cut_lineage, release_stored, stored_so_far


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the learned decision list reject go."""
    # A row's verdict follows from its text, so id and hash of the text name it; a struct may hold a null id.
    key = F.struct("doc_id", F.xxhash64("text").alias("text")).alias("__key")
    judged = quality_rules.judge(docs.select("doc_id", "text", key), table(spark, sf_dir, "labels"), carry=["__key"])
    gone = cut_lineage(judged.filter("NOT kept").select("__key").distinct())
    return join_ids(docs.withColumn("__key", key), gone, "__key", "left_anti").select(*docs.columns)


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly trained classifier rejects go."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    rows = docs.select("doc_id", "text", *[F.col(c).alias(f"__own_{c}") for c in others])
    kept = weak_labels.classify(rows, carry=["text", *[f"__own_{c}" for c in others]]).filter("kept")
    return kept.select(*[F.col(f"__own_{c}" if c in others else c).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest id (null last).

    Rows are numbered, so repeated ids and rows without an id are documents of their own; of equal ids in a
    group any one stays.  Documents without words have no duplicates.
    """
    rows = cut_lineage(docs.withColumn("__row", F.monotonically_increasing_id()))
    groups = neardup.near_duplicates(rows.select(F.col("__row").alias("doc_id"), "text"))
    member = groups.select(F.col("doc_id").alias("__row"), "component_id").join(rows.select("__row", "doc_id"), "__row")
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("__row").alias("row")))
    stays = cut_lineage(member.groupBy("component_id").agg(first.alias("first")).select(F.col("first.row").alias("__row")))
    return join_ids(rows, stays, "__row", "left_semi").select(*docs.columns)


def redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by marks; ``n_chars`` follows the new text."""
    clean = pii.redact(docs)
    if "n_chars" in clean.columns:
        kind = dict(docs.dtypes)["n_chars"]
        clean = clean.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
    return clean


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", rules), ("quality_classifier", classifier), ("minhash_near_dedup", dedup),
    ("pii", redaction), ("packing", packed),
]

#: No SQL expresses the learned stages; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``; what a stage stored on the way goes once its result is written."""
    docs, mark = table(spark, sf_dir, "documents"), stored_so_far(spark)
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
        release_stored(spark, mark, keep=docs)
    return docs
