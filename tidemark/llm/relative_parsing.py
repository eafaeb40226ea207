"""Substring deduplication by relative Lempel-Ziv parsing.

A passage repeats if a window of consecutive words also starts in a document with a smaller id.
Documents are parsed against reference blocks: a block holds the passages of earlier documents once,
indexed by their windows.  A parse is greedy: where a window of the passage is in the index, the factor
grows word by word as long as the reference goes on alike; a window the index lacks adds the passage to
the block.  Factors of a window's length or more are repeated spans.  A window that lies across the end
of a factor is in none, so after each factor the parse steps back to the first such window and
looks it up by itself.

No document has to meet every block.  Each window has an anchor, the run of ANCHOR words with
the smallest hash inside it, and equal windows have equal anchors; consecutive windows with one
anchor form a *stretch*, the unit that is sent to the block of its anchor.  Before that

* equal stretches become one, with the smallest id they occur in: in all other documents they repeat
  as a whole, so a passage that a third of all documents share costs one row;
* anchors whose stretches are all equal, or all of one document, need no block at all;
* only for the remaining stretches are words read again and sent to blocks.

An anchor with more than BLOCK_STRETCHES different stretches (a common line in many contexts) would make a
block too large for a task.  Its windows become blocks of their own, spread by their hash, where the
smallest id is known without a parse.  Both ways give the same spans, whatever the limit.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType

from tidemark.llm.slices import column, sliced, utf8, with_arrays
from tidemark.llm.words import mix
from tidemark.operators.materialise import cut_lineage

WINDOW = 50
#: Words of an anchor; at most half a window, and a power of two.
ANCHOR = 16
#: Different stretches that one reference block holds at most.
BLOCK_STRETCHES = 4096

_ODD = np.uint64(0x9E3779B97F4A7C15)
_KEY = ["anchor", "content"]
_PLACES = "doc_id bigint, text_key bigint, anchor bigint, content bigint, at bigint, n bigint"


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.array(list(map(xxhash.xxh3_64_intdigest, words)), np.uint64)


def run_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of every run of ``width`` words, from those of runs half as long, which may overlap."""
    if len(hashes) < width:
        return np.zeros(0, np.uint64)
    known, size = hashes, 1
    while size < width:
        step = min(size, width - size)
        known = mix(known[:-step] * _ODD + known[step:])
        size += step
    return known


def run_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` consecutive values."""
    size = 1
    while size < width:
        step = min(size, width - size)
        values, size = np.minimum(values[:-step], values[step:]), size + step
    return values


def stretches(hashes: np.ndarray, window: int = WINDOW, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """Anchor, content hash, first window and number of windows of each stretch of a text.

    A stretch has at most ``window`` windows, so its first and its last one name all of its words.
    """
    windows = run_hashes(hashes, window)
    if not len(windows):
        return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 2
    anchors = run_minima(run_hashes(hashes, anchor), window - anchor + 1)
    every = np.arange(len(windows))
    begins = np.flatnonzero(np.append(True, anchors[1:] != anchors[:-1]))
    run_start = np.repeat(begins, np.diff(np.append(begins, len(windows))))
    at = np.flatnonzero((every - run_start) % window == 0)
    n = np.diff(np.append(at, len(windows)))
    content = mix(mix(windows[at] * _ODD + windows[at + n - 1]) + n.astype(np.uint64))
    return anchors[at], content, at, n


class Block:
    """Reference passages of one anchor, each window held once, with the smallest id it starts in."""

    def __init__(self, window: int):
        self.window, self.passages, self.index = window, [], {}

    def parse(self, first_doc: int, passage: np.ndarray) -> list[tuple[int, int]]:
        """Ranges of windows of the passage that earlier documents hold; the rest joins the block.

        Passages come in the order of their ids.
        """
        window, words = self.window, passage.tobytes()
        windows = run_hashes(passage, window).tolist()
        spans, new, i = [], [], 0
        while i < len(windows):
            found = self.index.get(windows[i])
            if found is None:
                new.append(i)
                i += 1
                continue
            doc, where, start = found
            factor = self._length(words[8 * i:], self.passages[where][8 * start:])
            if doc == first_doc or factor < window:
                i += 1
                continue
            past = i + factor - window + 1        # the first window that the factor does not hold
            spans.append((i, past))
            i = past
        if new:
            where = len(self.passages)
            self.passages.append(words)
            for i in new:
                self.index.setdefault(windows[i], (first_doc, where, i))
        return spans

    @staticmethod
    def _length(own: bytes, reference: bytes) -> int:
        """Words that both begin with."""
        size = min(len(own), len(reference)) // 8
        if own[:8 * size] == reference[:8 * size]:
            return size
        a, b = np.frombuffer(own, np.uint64, size), np.frombuffer(reference, np.uint64, size)
        return int(np.argmax(a != b))


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64, copy=False).view(np.int64))


def _find_stretches(window: int, anchor: int):
    def work(batches):
        for batch in batches:
            for part in sliced(batch):
                texts = utf8(part)
                found = [stretches(word_hashes(text.split()), window, anchor) for text in texts]
                rows = np.repeat(np.arange(len(texts)), [len(f[0]) for f in found])
                anchors, contents, at, n = (np.concatenate(columns) for columns in zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [
                        column(part, "doc_id").take(pa.array(rows)), column(part, "text_key").take(pa.array(rows)),
                        _signed(anchors), _signed(contents), pa.array(at), pa.array(n),
                    ],
                    names=["doc_id", "text_key", "anchor", "content", "at", "n"],
                )

    return work


def _read_words(window: int):
    """The words of wanted stretches; equal rows lie side by side and are read once."""

    def work(batches):
        last = None
        for batch in batches:
            for part in sliced(batch):
                out = []
                keys = zip(column(part, "doc_id").to_pylist(), column(part, "text_key").to_pylist())
                for key, text, wanted in zip(keys, utf8(part), column(part, "wanted").to_pylist()):
                    if key == last:
                        continue
                    last, hashes = key, word_hashes(text.split())
                    out += [
                        (w["anchor"], w["content"], w["first_doc"], w["many"], hashes[w["at"]:w["at"] + w["n"] + window - 1].tobytes())
                        for w in wanted
                    ]
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row[k] for row in out], kind) for k, kind in enumerate(kinds)],
                    names=["anchor", "content", "first_doc", "many", "words"],
                )

    return work


def _parse_blocks(window: int):
    """Repeated ranges of windows of passages that arrive by anchor and id."""

    def work(batches):
        anchor, block = None, None
        for batch in batches:
            out = []
            columns = (column(batch, n).to_pylist() for n in ("anchor", "content", "first_doc", "words"))
            for own, content, first_doc, words in zip(*columns):
                if own != anchor:
                    anchor, block = own, Block(window)
                out += [(own, content, a, b) for a, b in block.parse(first_doc, np.frombuffer(words, np.uint64))]
            yield _ranges(out)

    return work


def _single_windows(window: int):
    def work(batches):
        for batch in batches:
            columns = (column(batch, n).to_pylist() for n in ("anchor", "content", "first_doc", "words"))
            out = [
                (anchor, content, first_doc, i, w)
                for anchor, content, first_doc, words in zip(*columns)
                for i, w in enumerate(run_hashes(np.frombuffer(words, np.uint64), window).view(np.int64).tolist())
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([row[k] for row in out], pa.int64()) for k in range(5)],
                names=["anchor", "content", "first_doc", "i", "words"],
            )

    return work


def _ranges(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([row[k] for row in rows], pa.int64()) for k in range(4)], names=[*_KEY, "low", "high"]
    )


def repeated_spans(
    docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, block_stretches: int = BLOCK_STRETCHES
) -> DataFrame:
    """(doc_id, text_key, spans) of the documents with repeated windows; ``docs`` has doc_id, text, text_key.

    ``spans`` holds ranges (low, high) of word numbers, unsorted and overlapping.
    """
    known = docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text_key", "text")
    places = cut_lineage(known.mapInArrow(_find_stretches(window, anchor), _PLACES))
    contents = cut_lineage(
        places.groupBy(*_KEY).agg(
            F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"),
            # any place serves to read the words; the three values stem from one row
            F.first("doc_id").alias("doc_id"), F.first("text_key").alias("text_key"), F.first("at").alias("at"),
            F.first("n").alias("n"),
        )
    )
    mixed = (
        contents.groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("different"), F.min("first_doc").alias("low"), F.max("first_doc").alias("high"))
        .filter((F.col("different") > 1) & (F.col("low") < F.col("high")))
        .select("anchor", (F.col("different") > block_stretches).alias("many"))
    )
    wanted = contents.join(mixed, "anchor").groupBy("doc_id", "text_key").agg(
        F.collect_list(F.struct(*_KEY, "first_doc", "at", "n", "many")).alias("wanted")
    )
    passages = cut_lineage(
        known.join(wanted, ["doc_id", "text_key"])
        .sortWithinPartitions("doc_id", "text_key")
        .mapInArrow(_read_words(window), "anchor bigint, content bigint, first_doc bigint, many boolean, words binary")
    )
    schema = "anchor bigint, content bigint, low bigint, high bigint"
    parsed = (
        passages.filter(~F.col("many"))
        .repartition("anchor")
        .sortWithinPartitions("anchor", "first_doc", "content")
        .mapInArrow(_parse_blocks(window), schema)
    )
    single = passages.filter("many").mapInArrow(
        _single_windows(window), "anchor bigint, content bigint, first_doc bigint, i bigint, words bigint"
    )
    earliest = single.groupBy("anchor", "words").agg(F.min("first_doc").alias("earliest"))
    looked_up = (
        single.join(earliest, ["anchor", "words"])
        .filter(F.col("earliest") < F.col("first_doc"))
        .select(*_KEY, F.col("i").alias("low"), (F.col("i") + 1).alias("high"))
    )
    inside = (
        parsed.union(looked_up).groupBy(*_KEY).agg(F.collect_set(F.struct("low", "high")).alias("ranges"))
    )
    told = cut_lineage(
        contents.select(*_KEY, "first_doc", "last_doc")
        .join(inside, _KEY, "left")
        .filter((F.col("first_doc") < F.col("last_doc")) | F.col("ranges").isNotNull())
        .drop("last_doc")
    )
    own = F.coalesce("ranges", F.array().cast("array<struct<low:bigint,high:bigint>>"))
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("low"), F.col("n").alias("high")))
    ranges = F.when(F.col("doc_id") > F.col("first_doc"), whole).otherwise(own)
    spans = places.join(told, _KEY).select("doc_id", "text_key", "at", F.explode(ranges).alias("r"))
    span = F.struct((F.col("at") + F.col("r.low")).alias("low"), (F.col("at") + F.col("r.high") + window - 1).alias("high"))
    return spans.groupBy("doc_id", "text_key").agg(F.collect_set(span).alias("spans"))


def _kept():
    def step(part):
        counts, removed, kept, ranges = [], [], [], []
        for text, spans in zip(utf8(part), column(part, "__spans").to_pylist()):
            words, merged = text.split(), []
            for low, high in sorted((s["low"], s["high"]) for s in spans or ()):
                if merged and low <= merged[-1][1]:
                    merged[-1][1] = max(high, merged[-1][1])
                else:
                    merged.append([low, high])
            edges = [0, *(edge for pair in merged for edge in pair), len(words)]
            left = [word for a, b in zip(edges[::2], edges[1::2]) for word in words[a:b]]
            counts.append(len(words))
            removed.append(len(words) - len(left))
            kept.append(b" ".join(left).decode())
            ranges.append([edge for pair in merged for edge in pair])
        return [counts, removed, kept, ranges]

    return step


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, block_stretches: int = BLOCK_STRETCHES
) -> DataFrame:
    """The documents with ``n_words``, ``n_removed``, ``kept_text`` and ``removed``.

    Words are ``[^\\x20\\x09-\\x0D]+``.  A word goes if a window of ``window`` words around it also starts in
    a document with a smaller doc_id; ``kept_text`` joins the others by one blank, ``removed`` lists first
    and end of each removed range of words.  Windows are judged on the input.  Documents with fewer words, empty
    and null texts keep all they have.  Repeated windows of one document, and of rows that share one
    doc_id, are kept; each such row is judged by itself.  A null doc_id is neither smaller nor larger than
    another: such rows keep all words and take none from others.  Empty tables give empty results.
    Other columns stay, columns with the names above are replaced.
    """
    keyed = docs.withColumn("__text_key", F.xxhash64("text"))
    spans = repeated_spans(keyed.select("doc_id", "text", F.col("__text_key").alias("text_key")), window, anchor, block_stretches)
    spans = spans.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), F.col("spans").alias("__spans"))
    joined = keyed.join(spans, (keyed["doc_id"] == spans["__id"]) & (keyed["__text_key"] == spans["__key"]), "left")
    added = {"n_words": LongType(), "n_removed": LongType(), "kept_text": StringType(), "removed": ArrayType(LongType())}
    return with_arrays(joined, added, _kept, drop=("__text_key", "__id", "__key", "__spans"))


def digest(docs: DataFrame) -> DataFrame:
    """Per document the number of words, of removed words, and a hash of the kept ones."""
    return remove_repeats(docs.select("doc_id", "text")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )
