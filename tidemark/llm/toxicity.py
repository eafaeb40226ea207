"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Texts are lower-cased; the features are the hashed character n-grams that occur in a text (present
or not, so one insult weighs as much in a long text as in a short one).  Each feature is scaled by
its naive Bayes log-count ratio between toxic and clean texts, and a logistic regression is fitted
on the scaled features.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import lists, text_slices
from tidemark.operators.materialise import cut_lineage

ORDERS = (4, 5, 6)
BUCKETS = 1 << 18
#: At most so many labelled texts of each class are learned from, the ones whose id has the
#: smallest hashes: a bounded sample, whatever the size of the table.
TEXTS_PER_CLASS = 1500
SMOOTHING = 1.0
PENALTY = 1e-3
STEPS = 200
#: How many standard errors apart a bucket's shares in the two classes must lie.
CLEAR = 5.0


def _codes(text: str | None) -> np.ndarray:
    """Code points of the lower-cased text between blanks; its white space becomes single blanks."""
    joined = " ".join((text or "").lower().split())
    return np.frombuffer(f" {joined} ".encode("utf-32-le", "surrogatepass"), np.uint32) if joined else np.empty(0, np.uint32)


class Features:
    """Hashed n-grams that occur in a text, each bucket once."""

    def __init__(self, orders: tuple[int, ...] = ORDERS, buckets: int = BUCKETS):
        self.orders, self.buckets = orders, buckets
        self.last = np.zeros(buckets, np.int32)

    def of(self, text: str | None) -> np.ndarray:
        codes = _codes(text)
        parts, key = [], codes.copy()
        for n in range(2, max(self.orders) + 1):
            if len(codes) < n:
                break
            key = key[: len(codes) - n + 1] * np.uint32(0x01000193) + codes[n - 1:]
            if n in self.orders:
                mixed = (key ^ (key >> np.uint32(15))) * np.uint32(0x85EBCA6B) + np.uint32(n)
                parts.append(mixed >> np.uint32(32 - (self.buckets.bit_length() - 1)))
        if not parts:
            return np.empty(0, np.uint32)
        every = np.concatenate(parts)
        # One position wins each bucket, whichever it is; those that read themselves back are distinct.
        own = np.arange(len(every), dtype=np.int32)
        self.last[every] = own
        return every[self.last[every] == own]


@dataclass
class Model:
    """``weights`` already hold ratio times coefficient."""

    weights: np.ndarray
    bias: float
    orders: tuple[int, ...] = ORDERS

    def score(self, texts: list[str | None], features: Features) -> np.ndarray:
        margin = np.array([self.weights[features.of(t)].sum(dtype=np.float64) for t in texts]) + self.bias
        return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


def fit(
    rows: Iterator[tuple[int, np.ndarray]], buckets: int = BUCKETS, orders: tuple[int, ...] = ORDERS,
    prior: float | None = None,
) -> Model:
    """Fit from (label, features) rows of the bounded sample; ``prior`` is the share of label 1 among
    all labelled texts.  Without both classes every score is the (smoothed) share of label 1."""
    labels, sets = [], []
    for label, own in rows:
        labels.append(label)
        sets.append(own)
    y = np.array(labels, np.float64)
    positives = int(y.sum())
    if not 0 < positives < len(y):
        share = (positives + 0.5) / (len(y) + 1)
        return Model(np.zeros(buckets, np.float32), float(np.log(share / (1 - share))), orders)
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets).astype(np.int64)
    row = np.repeat(np.arange(len(y)), sizes)
    toxic = SMOOTHING + np.bincount(flat[y[row] == 1], minlength=buckets)
    clean = SMOOTHING + np.bincount(flat[y[row] == 0], minlength=buckets)
    ratio = np.log((toxic / toxic.sum()) / (clean / clean.sum()))
    # Only buckets whose share differs clearly between the classes; chance alone rarely gets there.
    share = (toxic + clean - 2 * SMOOTHING) / len(y)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / positives + 1 / (len(y) - positives)))
    gap = (toxic - SMOOTHING) / positives - (clean - SMOOTHING) / (len(y) - positives)
    seen = np.flatnonzero(np.abs(gap) >= CLEAR * spread)
    if not len(seen):
        seen = np.argsort(-np.abs(gap) / spread, kind="stable")[:1]
    place = np.full(buckets, -1)
    place[seen] = np.arange(len(seen))
    use = place[flat] >= 0
    column, row = place[flat[use]], row[use]
    value = ratio[seen][column]
    # Rows are scaled to unit length on average only, so that long texts keep their evidence.
    value /= np.sqrt(np.bincount(row, value**2, len(y)).mean())
    unit = ratio[seen] / np.sqrt(np.bincount(row, ratio[seen][column] ** 2, len(y)).mean())
    prior = prior or positives / len(y)
    each = np.where(y == 1, prior / positives, (1 - prior) / (len(y) - positives))
    coef, bias = np.zeros(len(seen)), 0.0
    m, v = np.zeros(len(seen) + 1), np.zeros(len(seen) + 1)
    for step in range(1, STEPS + 1):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, value * coef[column], len(y)) + bias, -30, 30)))
        error = each * (p - y)
        slope = np.append(np.bincount(column, value * error[row], len(seen)) + PENALTY * coef, error.sum())
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        move = 0.3 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        coef, bias = coef - move[:-1], bias - move[-1]
    weights = np.zeros(buckets, np.float32)
    weights[seen] = unit * coef
    return Model(weights, float(bias), orders)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> tuple[DataFrame, float]:
    """(doc_id, label, text), and the share of label 1 among all labelled documents: at most ``per_class`` documents of each class, chosen by a hash of the
    id.  Null ids and labels are left out; a document labelled twice counts once with its larger label.
    """
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
        .groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label"))
    )
    present = cut_lineage(known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi"))
    prior = present.agg(F.avg("label").alias("prior")).first()["prior"]
    chosen = None
    for side in (0, 1):
        part = present.filter(F.col("label") == side).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.union(part)
    # At most 2 * per_class rows: small enough to broadcast at any input size.
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"]), prior


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = TEXTS_PER_CLASS) -> Model:
    """Learn from the labelled rows given; hold out rows before the call."""

    def work(batches):
        features = Features()
        for ids, texts, marks in lists(batches, "doc_id", "text", "label"):
            for low, high in text_slices(texts, 1 << 22):
                own = [features.of(t).astype(np.uint32).tobytes() for t in texts[low:high]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[low:high], pa.int64()), pa.array(marks[low:high], pa.int32()), pa.array(own, pa.binary())],
                    names=["doc_id", "label", "own"],
                )

    sample, prior = labelled_sample(docs, labels, label, per_class)
    rows = sample.mapInArrow(work, "doc_id bigint, label int, own binary").orderBy("doc_id").toLocalIterator()
    return fit(((r["label"], np.frombuffer(r["own"], np.uint32)) for r in rows), prior=prior)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (score >= 0.5) for every row, from the whole text alone.

    Null and empty texts have no features and get the score of the bias.  Repeated rows get equal
    scores; a null doc_id stays null; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one weight per bucket: 1 MB

    def work(batches):
        features = Features(shared.value.orders, len(shared.value.weights))
        for ids, texts in lists(batches, "doc_id", "text"):
            value = shared.value.score(texts, features)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(value), pa.array((value >= 0.5).astype(np.int32))],
                names=["doc_id", "score", "predicted"],
            )

    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(work, "doc_id bigint, score double, predicted int")
