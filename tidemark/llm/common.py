"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.operators.materialise import cut_lineage

#: Ids (8 bytes each) that a join may broadcast; longer lists are shuffled.
BROADCAST_IDS = 1_000_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(key: str, folds: int = 5) -> Column:
    """crc32 of the key as text, modulo ``folds``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % folds


def text_slices(texts: list[str | None], size: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``size`` characters; a longer text is a range of its own."""
    first, total = 0, 0
    for i, text in enumerate(texts):
        total += len(text or "")
        if total >= size:
            yield first, i + 1
            first, total = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def join_ids(df: DataFrame, ids: DataFrame, key: str | list[str], how: str) -> DataFrame:
    """Join with a stored list of ids (a few numbers a row); broadcast only when it is counted to be short.

    The list is stored, so counting it costs little.  The broadcast side must not hold null ids
    for an anti join to keep rows whose key is null, which it does.
    """
    short = ids.count() <= BROADCAST_IDS
    return df.join(F.broadcast(ids) if short else ids, key, how)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b): one row (node, label) per node, label the smallest node.

    Each round every node takes the smallest label around it and then the label of that label,
    until nothing changes.  Edges and labels are stored between rounds, so every join has a plain
    exchange on both sides and adaptive execution can split the edges of a hub.
    """
    both = cut_lineage(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    )
    labels = cut_lineage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select(
        "node", F.least("node", "low").alias("label")))
    while True:
        around = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("low"))
        lower = cut_lineage(
            labels.join(around, labels["node"] == around["a"])
            .select("node", F.col("label").alias("old"), F.least("label", "low").alias("label"))
        )
        target = lower.select(F.col("node").alias("label"), F.col("label").alias("next"))
        jumped = cut_lineage(
            lower.join(target, "label").select("node", "old", F.least("label", "next").alias("label"))
        )
        if jumped.filter("label <> old").isEmpty():
            return jumped.select("node", "label")
        labels = jumped.select("node", "label")


def text_parts(batches: Iterable[pa.RecordBatch], size: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """The rows of each Arrow batch in parts whose ``text`` takes about ``size`` bytes; a longer text ends its part.

    Parts share the batch's memory, so only one part at a time need become Python objects.
    """
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index("text"))), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False), dtype=np.int64)
        cuts = np.flatnonzero(np.diff(ends // size)) + 1
        for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            if low < high:
                yield batch.slice(low, high - low)


def lists(batches: Iterable, *names: str) -> Iterator[list[list]]:
    """The named columns of each Arrow batch as Python lists."""
    for batch in batches:
        yield [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names]
