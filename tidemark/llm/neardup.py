"""Near-duplicate documents by one-permutation hashing, banded buckets and star-shaped candidates.

One hash per shingle serves all bins of a signature: the top bits of the hash choose the bin, the
smallest hash in a bin is its value.  Empty bins borrow the value of a bin that a fixed random
sequence points to (optimal densification), so that two sets borrow alike.  Rows of bins form bands;
documents with an equal band share a bucket.

A bucket proposes a star, never all its pairs: its first members are centres and are compared with
the rest.  First come members that meet the most documents over all their buckets, which is the text
that a group of near copies was made from.  Members that a link already joins need no comparison.  Centres
leave the bucket after their turn, later rounds take more centres, and the rounds go on until no
bucket holds two components, so every pair of a bucket is either compared or already connected.
Equal shingle sets are folded into one before all this.  Before a pair leaves its bucket, bitmaps of the
full sets bound its common part from above: a shingle whose bit the other bitmap lacks is not shared, and
a pair whose bound lies below the threshold cannot be a link.  Links are confirmed on full sets.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import components, join_ids, lists, text_parts
from tidemark.llm.words import mix, shingles
from tidemark.operators.materialise import cut_lineage

WIDTH = 5
PERCENT = 75
BANDS = 32
ROWS = 4
#: Bands of the first round, which settles large groups with few comparisons.
FIRST_BANDS = 4
#: Each round takes this many times the centres of the round before; few rounds, as each takes several exchanges.
MORE_CENTRES = 64
#: 64-bit words of a set's bitmap.  Long sets fill it, which loosens the bound but never makes it wrong.
MARK_WORDS = 16

_SIGNATURE = "doc_id bigint, text_key bigint, n_shingles bigint, print_a bigint, print_b bigint, bands array<bigint>"
_SETS = "node bigint, own array<bigint>, marks array<bigint>"


def bin_minima(sets: list[np.ndarray], bins: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest hash per bin of sorted, non-empty sets, and which bins are filled; ``bins`` is a power of two."""
    shift = np.uint64(64 - (bins.bit_length() - 1))
    edges = np.arange(bins, dtype=np.uint64) << shift
    values = np.zeros((len(sets), bins), np.uint64)
    filled = np.zeros((len(sets), bins), bool)
    for i, own in enumerate(sets):
        at = np.searchsorted(own, edges)
        near = own[np.minimum(at, len(own) - 1)]
        filled[i] = (at < len(own)) & (near >> shift == np.arange(bins, dtype=np.uint64))
        values[i] = near
    return values, filled


def densify(values: np.ndarray, filled: np.ndarray) -> np.ndarray:
    """Fill empty bins: bin j tries the bins that hash(j, attempt) names until one is filled.

    The sequence is the same for all documents and independent for each bin.
    """
    out, bins = values.copy(), np.uint64(values.shape[1])
    row, bin_ = np.nonzero(~filled)
    attempt = 0
    while len(row):
        attempt += 1
        donor = (mix(bin_.astype(np.uint64) * np.uint64(1_000_003) + np.uint64(attempt)) % bins).astype(np.int64)
        found = filled[row, donor]
        out[row[found], bin_[found]] = values[row[found], donor[found]]
        row, bin_ = row[~found], bin_[~found]
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band, different for equal values in different bands."""
    parts = signature.reshape(len(signature), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for j in range(rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, j])
    return key


def _signed(values) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def _signatures(width: int, bands: int, rows: int):
    def work(batches):
        for ids, texts, keys_of_texts in lists(text_parts(batches), "doc_id", "text", "text_key"):
            sets = shingles(texts, width)
            sizes = np.array([len(s) for s in sets], np.int64)
            some = np.flatnonzero(sizes)
            prints = np.zeros((2, len(sets)), np.uint64)
            keys = np.zeros((len(some), bands), np.uint64)
            if len(some):
                own = [sets[i] for i in some]
                flat, at = np.concatenate(own), np.cumsum([0, *sizes[some][:-1]])
                prints[0, some] = np.add.reduceat(mix(flat), at)
                prints[1, some] = np.bitwise_xor.reduceat(mix(flat + np.uint64(77)), at)
                keys = band_keys(densify(*bin_minima(own, bands * rows)), bands, rows)
            offsets = np.zeros(len(sets) + 1, np.int32)
            offsets[1:] = np.cumsum((sizes > 0) * bands)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()), pa.array(keys_of_texts, pa.int64()), pa.array(sizes),
                    _signed(prints[0]), _signed(prints[1]), pa.ListArray.from_arrays(pa.array(offsets), _signed(keys.ravel())),
                ],
                names=["doc_id", "text_key", "n_shingles", "print_a", "print_b", "bands"],
            )

    return work


def set_marks(sets: list[np.ndarray]) -> np.ndarray:
    """One bitmap of ``MARK_WORDS`` words per set; each element sets the bit its hash names."""
    bits = 64 * MARK_WORDS
    marked = np.zeros((len(sets), bits), bool)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    marked[row, (mix(np.concatenate([*sets, np.empty(0, np.uint64)])) % np.uint64(bits)).astype(np.int64)] = True
    return np.packbits(marked, axis=1).view(np.uint64)


def _sets(width: int):
    def work(batches):
        for ids, texts in lists(text_parts(batches), "node", "text"):
            sets = shingles(texts, width)
            offsets = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            every = (np.arange(len(sets) + 1) * MARK_WORDS).astype(np.int32)
            flat = np.concatenate([*sets, np.empty(0, np.uint64)])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets), _signed(flat)),
                    pa.ListArray.from_arrays(pa.array(every), _signed(set_marks(sets).ravel())),
                ],
                names=["node", "own", "marks"],
            )

    return work


def _may_link(percent: int) -> Column:
    """Whether a member (n, marks) can reach the threshold with a centre (head_n, head_marks)."""
    def lacking(own, other):
        return sum(
            F.bit_count(F.col(own)[i].bitwiseAND(F.bitwise_not(F.col(other)[i]))) for i in range(MARK_WORDS)
        )

    n, head_n = F.col("n"), F.col("head_n")
    common = F.least(n - lacking("marks", "head_marks"), head_n - lacking("head_marks", "marks"))
    return 100 * common >= percent * (n + head_n - common)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    side = lambda key, name: sets.select(F.col("node").alias(key), F.col("own").alias(name))
    both = pairs.join(side("a", "set_a"), "a").join(side("b", "set_b"), "b")
    common = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - common
    return both.filter(100 * common >= percent * union).select("a", "b")


def _rounds():
    """(all bands?, centres per bucket) for each round."""
    yield False, 1
    centres = MORE_CENTRES
    while True:
        yield True, centres
        centres *= MORE_CENTRES


def _joined(edges: DataFrame) -> DataFrame:
    """(node, label) for the nodes of ``edges``; nodes with equal labels are connected, and those of one star
    have equal labels.

    Two steps, so parts of a component may still differ: that costs comparisons, never a link.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = cut_lineage(both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low")))
    far = both.join(near.withColumnsRenamed({"a": "b"}), "b").groupBy("a").agg(F.min("low").alias("label"))
    return cut_lineage(far.select(F.col("a").alias("node"), F.least("a", "label").alias("label")))


def links(nodes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame | None:
    """Components (node, label) of nodes (node, doc_id, text_key, n, bands) that have links; None without any
    candidate.  ``docs`` has doc_id, text_key and text; a node's text is that of its doc_id and text_key."""
    spread = nodes.select("node", "n", F.posexplode("bands").alias("band", "bucket"))
    shared = cut_lineage(spread.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1"))
    met = cut_lineage(spread.join(shared, "bucket"))
    candidates = cut_lineage(met.groupBy("node").agg(F.sum("size").alias("weight")))
    if candidates.isEmpty():
        return None
    largest = shared.agg(F.max("size")).first()[0]
    wanted = cut_lineage(nodes.select("node", "doc_id", "text_key").join(candidates.select("node"), "node"))
    texts = join_ids(docs, wanted, ["doc_id", "text_key"], "inner").select("node", "text")
    sets = cut_lineage(texts.mapInArrow(_sets(width), _SETS).dropDuplicates(["node"]))

    turn = F.struct((-F.col("weight")).alias("weight"), F.xxhash64("node").alias("place"), "node")
    members = cut_lineage(met.drop("size").join(candidates, "node").withColumn("turn", turn).drop("weight"))

    labels, live, compared, every = None, members, None, []
    for all_bands, centres in _rounds():
        live = live if all_bands else live.filter(F.col("band") < FIRST_BANDS)
        if labels is None:
            known = live.withColumn("label", F.col("node"))
        else:
            known = live.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        known = cut_lineage(known)
        open_ = (
            known.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"))
            .filter("low < high").select("bucket")
        )
        live = cut_lineage(known.join(open_, "bucket").join(sets.select("node", "marks"), "node"))
        if live.isEmpty():
            if all_bands:
                break
            live = members
            continue
        first = Window.partitionBy("bucket").orderBy("turn")
        heads = (
            live.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= centres)
            .select("bucket", F.col("node").alias("head"), F.col("n").alias("head_n"),
                    F.col("label").alias("head_label"), F.col("turn").alias("head_turn"), F.col("marks").alias("head_marks"))
        )
        heads = cut_lineage(heads)
        later = F.col("head_turn") < F.col("turn")
        pairs = (
            live.join(heads, "bucket").filter(later & (F.col("label") != F.col("head_label")) & _may_link(percent))
            .select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b")).distinct()
        )
        if compared is not None:
            pairs = pairs.join(compared, ["a", "b"], "left_anti")
        pairs = cut_lineage(pairs)
        compared = pairs if compared is None else compared.union(pairs)
        found = cut_lineage(_confirmed(pairs, sets, percent))
        if not found.isEmpty():
            every.append(found)
            if labels is not None:  # what is known already, as stars
                found = found.union(labels.filter("label <> node").select("label", "node"))
            labels = _joined(found)
        if not all_bands:
            live = members
        elif centres >= largest:    # every member has been a centre
            break
        else:
            gone = heads.select("bucket", F.col("head").alias("node"))
            live = live.join(gone, ["bucket", "node"], "left_anti").drop("label", "marks")
    return cut_lineage(components(reduce(DataFrame.union, every))) if every else None


def near_duplicates(
    docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    Documents are linked when 100 * |A and B| >= percent * |A or B| for their sets of ``width``-word
    shingles; ``component_id`` is the smallest doc_id that links reach, ``kept`` marks it.  Null and
    empty texts and texts without words have an empty set and link with nothing.  A row without
    doc_id is never linked: its component is null and it is kept.  Repeated rows get equal answers.  Rows
    that share an id are one document with all their texts: links of each of them are links of the id.
    With 32 bands of 4 rows a pair at similarity 0.75 shares no bucket with probability 5e-6.
    Other columns are ignored; an empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.withColumn("text_key", F.xxhash64("text"))
    signed = cut_lineage(docs.mapInArrow(_signatures(width, bands, rows), _SIGNATURE))
    prints = ["print_a", "print_b", "n_shingles"]
    full = signed.filter("n_shingles > 0 and doc_id is not null")
    # Rows with equal sets are one node, under a number of its own: one id may have several texts.
    groups = cut_lineage(
        full.groupBy(*prints).agg(F.min("doc_id").alias("low")).withColumn("node", F.monotonically_increasing_id())
    )
    heads = full.select(F.col("doc_id").alias("low"), "text_key", *prints, "bands").join(groups, ["low", *prints])
    nodes = cut_lineage(
        heads.select("node", F.col("low").alias("doc_id"), "text_key", F.col("n_shingles").alias("n"), "bands").dropDuplicates(["node"])
    )
    labels = links(nodes, docs, width, percent)
    shared = _several_texts(full.select("doc_id", *prints), groups, prints)
    if shared is not None:
        known = [] if labels is None else [labels.select(F.col("node").alias("a"), F.col("label").alias("b")).filter("a <> b")]
        labels = cut_lineage(components(reduce(DataFrame.union, [shared, *known])))
    if labels is not None:
        placed = groups.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        lowest = placed.groupBy("label").agg(F.min("low").alias("lowest"))
        groups = cut_lineage(placed.join(lowest, "label").select(*prints, F.col("lowest").alias("low")))
    judged = signed.drop("bands").join(groups.select(*prints, "low"), prints, "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("low", "doc_id"))
    return judged.select(
        "doc_id", "n_shingles", own.alias("component_id"),
        F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"),
    )


def _several_texts(full: DataFrame, groups: DataFrame, prints: list[str]) -> DataFrame | None:
    """Stars (a, b) over the nodes of ids that have several; None if no id has."""
    own = F.xxhash64(*prints)
    ids = full.groupBy("doc_id").agg(F.min(own).alias("low"), F.max(own).alias("high")).filter("low < high")
    ids = cut_lineage(ids.select("doc_id"))
    if ids.isEmpty():
        return None
    members = cut_lineage(full.join(ids, "doc_id").join(groups, prints).select("doc_id", "node").distinct())
    centres = members.groupBy("doc_id").agg(F.min("node").alias("a"))
    return members.join(centres, "doc_id").filter("node <> a").select("a", F.col("node").alias("b"))
