"""The pipeline's stages on the smallest data set, each against what its operator decides."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from test_text_operators import brute_base, brute_components  # noqa: E402

from tidemark.llm import packing  # noqa: E402
from tidemark.llm.common import table  # noqa: E402
from tidemark.operators.materialise import cut_lineage  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, FOLDER, "documents"), []
    out.append(docs)
    for _, stage in corpus_pipeline.STAGES:
        docs = cut_lineage(stage(spark, docs, FOLDER))
        out.append(docs)
    return out


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_stages_keep_the_columns(stages):
    assert all(s.columns == stages[0].columns for s in stages[1:5])
    for before, after in zip(stages, stages[1:4]):
        assert ids(after) <= ids(before) and after.count() > 0.5 * before.count()


def test_one_of_each_group_stays(stages):
    rows = [(r["doc_id"], r["text"]) for r in stages[2].collect()]
    assert ids(stages[3]) == {top for _, top in brute_components(rows).values()}


def test_personal_data_is_gone(stages):
    for r in stages[4].collect():
        assert brute_base(r["text"]) == "" and r["n_chars"] == len(r["text"])


def test_all_that_is_left_is_packed(stages):
    own = packing.tokens(corpus_pipeline.public_tokenizers.path("word_bpe_49k.json"))
    want = {r["doc_id"]: len(own.encode([r["text"]])[0]) // 4 + 1 for r in stages[4].collect()}
    got = {r["doc_id"]: r["n"] for r in stages[5].groupBy("doc_id").agg({"length": "sum"}).toDF("doc_id", "n").collect()}
    assert got == want


# -- rows, not ids -----------------------------------------------------------------------------

CLEAN = " ".join(f"the word{i} and some other{i % 7} text of line{i % 5}" for i in range(12))
OTHER = " ".join(f"quite another story{i} told in plain words{i % 6} here" for i in range(14))
JUNK = "buy now ### " * 3
ROWS = "doc_id int, text string, lang string, n_chars int, kept string, score double, n_words int, component_id string"


def small(spark, pairs):
    return spark.createDataFrame([(i, t, None, None, "x", None, 3, None) for i, t in pairs], ROWS).repartition(2)


def texts(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)


def test_repeated_ids_and_rows_without_an_id(spark, tmp_path):
    stage = dict(corpus_pipeline.STAGES)
    spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = small(spark, [(7, JUNK), (7, CLEAN), (None, JUNK), (None, OTHER), (8, None), (9, "")])
    kept = stage["quality_rules"](spark, docs, str(tmp_path))
    assert kept.schema == docs.schema and texts(kept) == sorted([(7, CLEAN), (None, OTHER)], key=str)
    kept = stage["quality_classifier"](spark, docs, str(tmp_path))
    assert kept.dtypes == docs.dtypes
    assert {t for _, t in texts(kept)} <= {JUNK, CLEAN, OTHER} and set(texts(kept)) <= set(texts(docs))
    copies = small(spark, [(1, CLEAN), (1, CLEAN), (None, CLEAN), (None, CLEAN), (2, OTHER), (None, OTHER), (3, ""), (3, None), (None, None)])
    kept = stage["minhash_near_dedup"](spark, copies, str(tmp_path))
    assert kept.dtypes == copies.dtypes
    assert texts(kept) == sorted([(1, CLEAN), (2, OTHER), (3, ""), (3, None), (None, None)], key=str)


def test_one_id_with_two_texts_keeps_both_links(spark, tmp_path):
    near = lambda t: t + " end"
    docs = small(spark, [(5, CLEAN), (5, OTHER), (6, near(CLEAN)), (9, near(OTHER))])
    kept = dict(corpus_pipeline.STAGES)["minhash_near_dedup"](spark, docs, str(tmp_path))
    assert texts(kept) == [(5, OTHER), (5, CLEAN)] or texts(kept) == [(5, CLEAN), (5, OTHER)]


def test_empty_table_through_all_stages(spark, tmp_path):
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.createDataFrame([], ROWS)
    for _, stage in corpus_pipeline.STAGES:
        docs = cut_lineage(stage(spark, docs, str(tmp_path)))
        assert docs.count() == 0
