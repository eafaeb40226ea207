"""Language-model scoring with a log-frequency Bloom filter.

Counts are exact where they are made: tokens are counted over all training texts, and word pairs over
all training texts as sorted hash blocks that meet per hash range.  The model keeps a count on a
logarithmic scale: an n-gram with level q is put into a Bloom filter q times, as (n-gram, 1) to
(n-gram, q), and its level is read back by probing 1, 2, ... until a probe fails.  Every n-gram of the
training texts is in, at every size.  The filter grows with the corpus, so no task holds more of it than
the segment of one hash range: blocks of texts send their distinct n-grams to the segments, which send
back the levels.

A token's probability is the add-half unigram probability, drawn towards the counts of its word pair
by a Dirichlet prior of ``prior`` observations.  Unigram counts are exact: frequent tokens (again a
bounded share) are broadcast, all others meet their counts in a join.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import lists, text_slices
from tidemark.llm.words import flat_words, mix
from tidemark.operators.materialise import cut_lineage

#: The end of a text, a token of its own; no word contains a blank.
END = " "
#: Tokens with exact counts in the broadcast at most.
MOST_FREQUENT = 1_000_000
#: Base of the logarithmic scale of counts, bits per filter entry, probes per entry.
SCALE = 1.5
BITS, PROBES = 9, 4
#: Weight of the unigram model, in observations of a history.
PRIOR = 300.0
#: Bytes of text per block, and per hash range of n-grams: about a million of them.
BLOCK_BYTES = 1 << 21
RANGE_BYTES = 3 << 20
#: Low bits of a hash that are not used: 48 bits tell n-grams apart far better than the filter does.
UNUSED = np.uint64(16)

_END_HASH = np.uint64(0x5851F42D4C957F2D)


def level_of(counts: np.ndarray) -> np.ndarray:
    """1 + floor(log(count)) on the scale; counts are at least 1."""
    return 1 + np.floor(np.log(np.maximum(counts, 1)) / np.log(SCALE) + 1e-9).astype(np.int64)


def count_of(levels: np.ndarray) -> np.ndarray:
    """The middle of the counts of a level; 0 for level 0."""
    each = np.arange(int(levels.max(initial=0)) + 1)
    middle = (SCALE ** (each - 1.0) + np.maximum(SCALE**each - 1, SCALE ** (each - 1.0))) / 2
    return np.where(each > 0, middle, 0.0)[levels]


class LevelFilter:
    """Segments of a Bloom filter, one per hash range, laid end to end."""

    def __init__(self, segments: list[tuple[int, bytes]], ranges: int):
        self.bits = np.frombuffer(b"".join(s for _, s in segments), np.uint8)
        self.start, self.size = np.zeros(ranges, np.uint64), np.zeros(ranges, np.uint64)
        at = 0
        for where, raw in segments:
            self.start[where], self.size[where] = at * 8, len(raw) * 8
            at += len(raw)
        self.ranges = ranges

    def levels(self, grams: np.ndarray) -> np.ndarray:
        """The level of each n-gram hash, 0 if it is not in the filter; equal hashes are probed once."""
        grams, inverse = np.unique(grams, return_inverse=True)
        out = np.zeros(len(grams), np.int64)
        where = range_of(grams, self.ranges)
        start, size = self.start[where], self.size[where]
        left = np.flatnonzero(size)
        while len(left):
            level = out[left] + 1
            for probe in range(PROBES):  # most n-grams fail the first probe and drop out
                place = start[left] + slot(grams[left], level, probe) % size[left]
                found = self.bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1 == 1
                left, level = left[found], level[found]
            out[left] += 1
        return out[inverse]


def range_of(grams: np.ndarray, ranges: int) -> np.ndarray:
    return ((grams >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def slot(grams: np.ndarray, level: np.ndarray, probe: int) -> np.ndarray:
    return mix(grams * np.uint64(2 * probe + 3) + level.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def filter_segment(grams: np.ndarray, counts: np.ndarray) -> bytes:
    """The filter of the n-grams of one hash range."""
    levels = level_of(counts)
    entries = int(levels.sum())
    size = max(8, (entries * BITS + 7) // 8 * 8)
    bits = np.zeros(size, bool)
    gram = np.repeat(grams, levels)
    level = np.arange(entries) - np.repeat(np.cumsum(levels) - levels, levels) + 1
    for probe in range(PROBES):
        bits[(slot(gram, level, probe) % np.uint64(size)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def gram_hashes(flat) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all tokens (each text's words, then its end), of the pair that each token ends (a text
    begins after an end), and the text of each token."""
    counts = flat.counts + 1
    ends = np.cumsum(counts) - 1
    total = int(counts.sum())
    token = np.empty(total, np.uint64)
    is_word = np.ones(total, bool)
    is_word[ends] = False
    token[is_word], token[ends] = flat.hashes(), _END_HASH
    before = np.empty(total, np.uint64)
    before[1:], before[:1] = token[:-1], _END_HASH
    pair = mix(before * np.uint64(0xD6E8FEB86659FD93) + token)
    return token >> UNUSED << UNUSED, pair >> UNUSED << UNUSED, np.repeat(np.arange(len(counts)), counts)


def token_counts(docs: DataFrame) -> DataFrame:
    """(token, c) over all texts; END counts the texts."""

    def work(batches):
        for (texts,) in lists(batches, "text"):
            for low, high in text_slices(texts, 1 << 22):
                seen: Counter = Counter()
                for text in texts[low:high]:
                    seen.update((text or "").encode().lower().split())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([*seen, END.encode()], pa.binary()), pa.array([*seen.values(), high - low], pa.int64())],
                    names=["token", "c"],
                )

    return docs.select("text").mapInArrow(work, "token binary, c bigint").groupBy("token").agg(F.sum("c").alias("c"))


def repeatable(df: DataFrame) -> DataFrame:
    """The frame if it is a plain scan of files, whose partitions and their order are the same in every
    pass; else a stored copy."""
    node = df._jdf.queryExecution().optimizedPlan()
    fixed = node.deterministic()
    while node.nodeName() in ("Project", "Filter"):
        node = node.children().apply(0)
    return df if fixed and node.nodeName() == "LogicalRelation" else cut_lineage(df)


def block_slices(batches):
    """(block, slice of a batch): a block is a run of about BLOCK_BYTES of text of one partition, wherever
    the batches end."""
    first, before = TaskContext.get().partitionId() << 33, 0
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index("text"))), 0)
        starts = before + np.r_[0, np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64) + 8)]
        before, number = int(starts[-1]), starts[:-1] // BLOCK_BYTES
        at = [*np.flatnonzero(np.diff(number, prepend=-1)).tolist(), len(number)]
        for low, high in zip(at[:-1], at[1:]):
            yield first + int(number[low]), batch.slice(low, high - low)


def packed(values: np.ndarray) -> bytes:
    """Unsigned numbers byte by byte of equal weight, as the upper bytes are mostly zero and compress."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint8).reshape(8, -1).T.copy().view("<u8").ravel()


def block_grams(docs: DataFrame, ranges: int) -> DataFrame:
    """(part, block, grams, times): the distinct n-grams of each block, or piece of one, by hash range, and
    how often they occur in rows to learn from.  An n-gram however frequent is one number per piece."""
    edges = np.arange(1, ranges)

    def work(batches):
        for block, piece in block_slices(batches):
            ((texts, learn),) = lists([piece], "text", "learn")
            token, pair, owner = gram_hashes(flat_words(texts))
            taught = np.array([bool(x) for x in learn])[owner]
            gram, place = np.unique(np.concatenate([token, pair]), return_inverse=True)
            times = np.bincount(place[np.r_[taught, taught]], minlength=len(gram))
            at = [0, *np.searchsorted(range_of(gram, ranges), edges).tolist(), len(gram)]
            some = [k for k in range(ranges) if at[k] < at[k + 1]]
            steps = [packed(np.diff(gram[at[k]:at[k + 1]] >> UNUSED, prepend=np.uint64(0))) for k in some]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(some, pa.int64()), pa.array([block] * len(some), pa.int64()), pa.array(steps, pa.binary()),
                    pa.array([packed(times[at[k]:at[k + 1]]) for k in some], pa.binary()),
                ],
                names=["part", "block", "grams", "times"],
            )

    return docs.mapInArrow(work, "part bigint, block bigint, grams binary, times binary")


def block_levels(sent: DataFrame) -> DataFrame:
    """(block, part, levels): for the distinct n-grams of each block in a hash range, sorted, the levels
    read from the range's segment of the filter."""

    def answer(key, table):
        grams = [np.cumsum(unpacked(g)) << UNUSED for g in table.column("grams").to_pylist()]
        weight = np.concatenate([unpacked(t) for t in table.column("times").to_pylist()])
        each, place = np.unique(np.concatenate(grams), return_inverse=True)
        total = np.bincount(place, weight, len(each)).astype(np.int64)
        seen = total > 0
        segments = [(0, filter_segment(each[seen], total[seen]))] if seen.any() else []
        level = LevelFilter(segments, 1).levels(each).astype(np.uint8)
        ends = np.cumsum([len(g) for g in grams])
        pieces: dict[int, list[np.ndarray]] = {}
        for block, g, end in zip(table.column("block").to_pylist(), grams, ends):
            pieces.setdefault(block, []).append(place[end - len(g):end])
        found = [level[own[0] if len(own) == 1 else np.unique(np.concatenate(own))].tobytes() for own in pieces.values()]
        return pa.table({
            "block": pa.array(pieces, pa.int64()), "part": pa.array([key[0].as_py()] * len(pieces), pa.int64()),
            "levels": pa.array(found, pa.binary()),
        })

    return sent.groupBy("part").applyInArrow(answer, "block bigint, part bigint, levels binary")


def block_texts(docs: DataFrame) -> DataFrame:
    """(block, doc_id, text)."""

    def work(batches):
        for block, piece in block_slices(batches):
            own = pa.array(np.full(piece.num_rows, block, np.int64))
            columns = [piece.column(piece.schema.get_field_index(n)) for n in ("doc_id", "text")]
            yield pa.RecordBatch.from_arrays([own, *columns], names=["block", "doc_id", "text"])

    return docs.mapInArrow(work, "block bigint, doc_id bigint, text string")


def score(docs: DataFrame, training: Column, prior: float = PRIOR) -> DataFrame:
    """Learn from the rows where ``training`` holds and score every whole text.

    Result: doc_id, n_tokens, n_known (tokens seen in training), train_tokens, base_score (log10 of the
    add-half unigram model), score (log10 of the model).  Null and empty texts are an end alone.
    Repeated rows are scored each, and learned from each; a null doc_id stays null; other columns are
    ignored.  Without training rows every token is unseen, and both scores are those of a uniform model.
    """
    spark = docs.sparkSession
    plain = repeatable(docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), training.alias("learn")
    ))
    taught = plain.filter("learn")
    counts = cut_lineage(token_counts(taught))
    known = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    total, kinds = known["n"], known["v"]
    # At most MOST_FREQUENT tokens can each make up 1 / MOST_FREQUENT of all tokens.
    frequent = {
        bytes(r["token"]): r["c"]
        for r in counts.filter(F.col("c") * MOST_FREQUENT >= max(total, 1)).orderBy("token").toLocalIterator()
    }
    names = list(frequent)
    shared = spark.sparkContext.broadcast({
        "place": {w: i for i, w in enumerate(names)}, "counts": np.array([*frequent.values(), 0], np.float64),
    })
    below = total + 0.5 * (kinds + 1)
    # A text of n bytes has at most n / 2 + 2 tokens, so a range is bounded whatever share is learned from.
    size = plain.agg(F.coalesce(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 8), F.lit(0)).alias("n")).first()["n"]
    answers = block_levels(block_grams(plain, 1 + size // RANGE_BYTES))

    def work(rows, answered):
        place, exact = shared.value["place"], shared.value["counts"]
        ((ids, texts),) = lists([rows], "doc_id", "text")
        flat = flat_words(texts)
        token, pair, owner = gram_hashes(flat)
        n = len(texts)
        grams, inverse = np.unique(np.concatenate([token, pair]), return_inverse=True)
        parts = zip(answered.column("part").to_pylist(), answered.column("levels").to_pylist())
        known_level = np.frombuffer(b"".join(raw for _, raw in sorted(parts)), np.uint8).astype(np.int64)
        if len(known_level) != len(grams):
            raise ValueError("the texts of a block have changed between two passes")
        level = known_level[inverse]
        ends = np.cumsum(flat.counts + 1) - 1
        index = np.full(len(token), place.get(END.encode(), -1))
        is_word = np.ones(len(token), bool)
        is_word[ends] = False
        index[is_word] = np.fromiter((place.get(w, -1) for w in flat.words), np.int64, len(flat.words))
        common = index >= 0
        own = exact[index]
        own[~common] = count_of(level[: len(token)][~common])
        history = np.empty(len(token))
        history[1:], history[ends[:-1] + 1], history[0] = own[:-1], own[ends[:-1]], own[ends[0]]
        together = np.minimum(count_of(level[len(token):]), np.minimum(history, own))
        uniform = (own + 0.5) / below
        drawn = (together + prior * uniform) / (history + prior)
        change = np.bincount(owner, np.log10(drawn / uniform), n)
        base = np.bincount(owner[common], np.log10((own[common] + 0.5) / below), n)
        seen = np.bincount(owner[common], minlength=n)
        rare_at = np.flatnonzero(~common & is_word)
        # Word number of a token: its place less the ends before it.
        words = rare_at - owner[rare_at]
        rare: list[Counter] = [Counter() for _ in range(n)]
        for k, w in zip(owner[rare_at].tolist(), words.tolist()):
            rare[k][flat.words[w]] += 1
        if END.encode() not in place:
            for own_rare in rare:
                own_rare[END.encode()] += 1
        return pa.Table.from_arrays(
            [
                pa.array(ids, pa.int64()), pa.array(flat.counts + 1), pa.array(seen.astype(np.int64)),
                pa.array(base), pa.array(change),
                pa.array([list(r) for r in rare], pa.list_(pa.binary())),
                pa.array([list(r.values()) for r in rare], pa.list_(pa.int64())),
            ],
            names=["doc_id", "n_tokens", "seen", "base", "change", "rare", "times"],
        )

    first = cut_lineage(
        block_texts(plain).groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
            work, "doc_id bigint, n_tokens bigint, seen bigint, base double, change double, rare array<binary>, times array<bigint>"
        ).withColumn("row", F.monotonically_increasing_id())
    )
    each = F.inline(F.arrays_zip(F.col("rare").alias("token"), F.col("times").alias("times")))
    rest = first.select("row", each)
    met = rest.join(counts, "token", "left").groupBy("row").agg(
        F.sum(F.col("times") * F.log10((F.coalesce("c", F.lit(0)) + 0.5) / F.lit(float(below)))).alias("rare_base"),
        F.sum(F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0)).alias("rare_seen"),
    )
    zero = lambda name: F.coalesce(name, F.lit(0))
    return first.drop("rare", "times").join(met, "row", "left").select(
        "doc_id", "n_tokens", (F.col("seen") + zero("rare_seen")).alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"), (F.col("base") + zero("rare_base")).alias("base_score"),
        (F.col("base") + zero("rare_base") + F.col("change")).alias("score"),
    )
