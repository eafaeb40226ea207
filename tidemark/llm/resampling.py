"""Importance resampling: documents drawn so that their words look like those of a target collection.

Words are read from UTF-8 bytes: a table of 256 bytes lower-cases A-Z and blanks all separators, and
``bytes.split`` yields the words.  The hash of a run of words is the crc32 of its text, which is built up by
giving the hash of the shorter run to ``zlib.crc32`` as its seed, so no run is ever put together.  Counters
add up the buckets of the hashes, first per task and then over all tasks.

The ratio of a bucket's shares in the target and in the documents gives its gain; a document weighs the
mean gain of its features.  Random noise from the Gumbel distribution, fixed by the document's id, turns
"the highest scores" into a draw without replacement in proportion to the weights.
"""

from __future__ import annotations

import itertools
import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import LongType

from tidemark.llm.slices import column, sliced, utf8, with_arrays
from tidemark.operators.materialise import cut_lineage

BUCKETS = 10_000
WIDTH = 2
#: Bytes of a text that are split into words at a time.
PIECE = 1 << 20
#: Score levels that are ranked together; scores are whole numbers.
LEVELS = 1_000

#: A-Z to lower case, digits, a-z and all bytes above 127 unchanged, everything else to a blank.
_TABLE = bytes(b if b > 127 else ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(256))


def word_pieces(data: bytes, size: int = PIECE) -> Iterator[list[bytes]]:
    """The words of a text in order, a bounded stretch of it at a time."""
    at = 0
    while at < len(data):
        end = at + size
        while end < len(data) and _TABLE[data[end]] != 32:
            end += 1
        yield data[at:end].translate(_TABLE).split()
        at = end


def run_hashes(data: bytes, width: int = WIDTH, size: int = PIECE) -> Iterator[tuple[int, np.ndarray]]:
    """Per stretch its number of words and the crc32 of all runs of 1 to ``width`` words that end in it."""
    carried: list[bytes] = []
    for new in word_pieces(data, size):
        words = carried + new
        spaced = [b" " + word for word in words]
        runs = list(map(crc32, words))
        hashes = runs[len(carried):]
        for k in range(1, width):
            runs = list(map(crc32, spaced[k:], runs))
            hashes += runs[max(len(carried) - k, 0):]
        yield len(new), np.array(hashes, np.uint32)
        carried = words[len(words) - width + 1:] if width > 1 else []


def bucket_counts(texts: DataFrame, text: str = "text", width: int = WIDTH, buckets: int = BUCKETS) -> dict[int, int]:
    """Features per bucket over all texts; the result has at most ``buckets`` entries."""

    def work(batches):
        counts: Counter[int] = Counter()
        for batch in batches:
            for part in sliced(batch, text):
                for data in utf8(part, text):
                    for _, hashes in run_hashes(data, width):
                        counts.update((hashes % buckets).tolist())
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())], names=["bucket", "n"]
        )

    counted = texts.select(text).mapInArrow(work, "bucket bigint, n bigint")
    return {row.bucket: row.n for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}


def bucket_gains(source: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """1000 times the log ratio of each bucket's shares, rounded down; every bucket counts once more than seen."""
    all_source, all_target = float(sum(source.values()) + buckets), float(sum(target.values()) + buckets)
    return np.array(
        [
            math.floor(1000 * math.log((target.get(b, 0) + 1) * all_source / ((source.get(b, 0) + 1) * all_target)))
            for b in range(buckets)
        ],
        np.int64,
    )


def noise(doc_id: str, seed: int) -> Column:
    """1000 times Gumbel noise, rounded down; fixed by id and seed."""
    text = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(text, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def weigh(
    docs: DataFrame, target: DataFrame, width: int = WIDTH, buckets: int = BUCKETS, seed: int = 7
) -> DataFrame:
    """The documents with ``n_words``, ``n_features``, ``weight`` and ``score``.

    ``docs`` has doc_id and text, ``target`` has text.  All texts of both are counted.  Texts without
    words (null and empty ones too) have weight 0; a null id draws like the empty text; repeated rows
    count, weigh and score like any other.  If documents or target are empty, every count there is 0.
    Other columns stay, columns with the names above are replaced.
    """
    gains = bucket_gains(bucket_counts(docs, width=width, buckets=buckets), bucket_counts(target, width=width, buckets=buckets), buckets)

    def work():
        def features(data: bytes) -> tuple[int, int, int]:
            words = found = gain = 0
            for n, hashes in run_hashes(data, width):
                words, found = words + n, found + len(hashes)
                gain += int(gains[hashes % buckets].sum())
            return words, found, gain // found if found else 0

        return lambda part: list(zip(*map(features, utf8(part))))

    kinds = dict.fromkeys(("n_words", "n_features", "weight"), LongType())
    return with_arrays(docs, kinds, work).withColumn("score", F.col("weight") + noise("doc_id", seed))


def draw(scored: DataFrame, percent: int = 25, least_words: int = 20) -> DataFrame:
    """Add ``rank``: 1, 2, 3, ... for the drawn documents, by score from the highest; null for the others.

    Of the N documents with ``least_words`` words or more, floor(percent * N / 100) are drawn.  Equal
    scores are taken by doc_id, smallest first and null last; rows equal in that too in any order.
    Scores are counted per value; running totals of these counts, in groups of LEVELS values, say at
    which rank a value starts, so only the documents of one value meet in a task: even if all weights
    are the same, the noise gives one value at most 1/2700 of the documents.  ``scored`` should be stored.
    """
    scored = scored.drop("rank")
    able = F.col("n_words") >= least_words
    counts = cut_lineage(scored.filter(able).groupBy(F.col("score").alias("__level")).agg(F.count(F.lit(1)).alias("__n")))
    quota = counts.agg((F.coalesce(F.sum("__n"), F.lit(0)) * percent / 100).cast("long")).scalar()
    group = F.floor(F.col("__level") / LEVELS)
    higher = Window.orderBy(F.desc("__group")).rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("__group").orderBy(F.desc("__level")).rowsBetween(Window.unboundedPreceding, -1)
    groups = counts.groupBy(group.alias("__group")).agg(F.sum("__n").alias("__all")).select(
        "__group", F.coalesce(F.sum("__all").over(higher), F.lit(0)).alias("__above")
    )
    levels = counts.withColumn("__group", group).join(groups, "__group").select(
        "__level", (F.col("__above") + F.coalesce(F.sum("__n").over(within), F.lit(0))).alias("__before")
    )
    placed = scored.join(levels, able & (F.col("score") == F.col("__level")), "left").drop("__level")
    reached = placed.filter(F.col("__before") < quota)
    order = Window.partitionBy("score").orderBy(F.asc_nulls_last("doc_id"))
    place = F.col("__before") + F.row_number().over(order)
    drawn = reached.withColumn("rank", F.when(place <= quota, place))
    rest = placed.filter(F.coalesce(F.col("__before") >= quota, F.lit(True))).withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(rest).drop("__before")


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, seed: int = 7) -> DataFrame:
    """The documents drawn towards ``target``, with all their columns, weight, score and rank."""
    return draw(cut_lineage(weigh(docs, target, seed=seed)), percent, least_words).filter(F.col("rank").isNotNull())


def digest(docs: DataFrame, target: DataFrame) -> DataFrame:
    """Every document's doc_id, n_features, weight, score and rank."""
    scored = weigh(docs.select("doc_id", "text"), target).drop("text")
    return draw(cut_lineage(scored)).select("doc_id", "n_features", "weight", "score", "rank")
