"""Quality classifier from weak labels.

Heuristic labellers vote good, bad or nothing on each text; they overlap and err.  How often each
combination of votes occurs is counted over all documents; expectation-maximisation on those counts
estimates the share of good texts and how often each labeller is right, which gives every combination
a posterior.  The posteriors are the training labels of a linear scorer on hashed words and word
shapes, which then scores every whole text, also where no labeller speaks.  No given label is used.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from tidemark.llm.common import lists, text_parts
from tidemark.llm.words import FlatWords, flat_words, mix
from tidemark.operators.materialise import cut_lineage

BUCKETS = 1 << 16
#: At most so many texts per side of the posterior train the scorer: a bounded sample, weighed by how
#: many documents the side has.
TEXTS_PER_SIDE = 2000
STEPS = 200
#: Where the estimation starts, and what it is drawn to with this share of all documents as
#: pseudo-counts: each labeller knows one fault, so it seldom blames a good text, and praises most bad
#: texts for lacking its fault.
START_GOOD, START_RIGHT_ON_BAD, START_RIGHT_ON_GOOD = 0.9, 0.35, 0.98
PRIOR = 0.01

_COMMON = (
    "the of and to in a is that it for on was be as are with der die und das den von zu mit sich des "
    "la le les et de un une que en el los por con para"
).split()


def _shares(flat: FlatWords, texts: list[str | None]) -> dict[str, np.ndarray]:
    """Statistics that the labellers look at, one value per text."""
    n = np.maximum(flat.counts, 1)
    owner = np.repeat(np.arange(len(texts)), flat.counts)
    hashes = flat.hashes()
    common = np.isin(hashes, flat_words([" ".join(_COMMON)]).hashes())
    per_word = lambda mask: np.bincount(owner, mask, len(texts)) / n
    lengths = flat.ends - flat.starts
    raw = [(t or "").encode() for t in texts]
    count = lambda chars: np.array([len(t) - len(t.translate(None, chars)) for t in raw])
    upper, lower = count(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), count(b"abcdefghijklmnopqrstuvwxyz")
    own = mix(hashes ^ mix(owner.astype(np.uint64)))
    _, first = np.unique(own, return_index=True)
    distinct = np.bincount(owner[first], minlength=len(texts)) / n
    lines = [[x for x in (t or "").split("\n") if x.strip()] for t in texts]
    return {
        "words": flat.counts, "common": per_word(common), "distinct": distinct,
        "symbols": count(b"#*$%&|<>") / n, "shouts": count(b"!?") / n,
        "upper": upper / np.maximum(upper + lower, 1), "length": per_word(lengths), "long": per_word(lengths > 30),
        "stutter": np.bincount(owner[1:], (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1]), len(texts)) / n,
        "repeated_lines": np.array([1 - len(set(x)) / len(x) if x else 0 for x in lines]),
    }


#: Name, when it votes good, when it votes bad.  Elsewhere it abstains.
LABELLERS = (
    ("symbols", lambda s: s["symbols"] < 0.02, lambda s: s["symbols"] > 0.2),
    ("case", lambda s: (s["upper"] > 0.005) & (s["upper"] < 0.15), lambda s: s["upper"] > 0.5),
    ("shouting", lambda s: s["shouts"] < 0.02, lambda s: s["shouts"] > 0.3),
    ("common_words", lambda s: s["common"] > 0.15, lambda s: s["common"] < 0.04),
    ("repetition", lambda s: (s["distinct"] > 0.4) | (s["words"] > 1500), lambda s: (s["distinct"] < 0.15) & (s["words"] < 1500)),
    ("stutter", lambda s: s["stutter"] < 0.05, lambda s: s["stutter"] > 0.2),
    ("lines", lambda s: s["repeated_lines"] < 0.05, lambda s: s["repeated_lines"] > 0.4),
    ("word_length", lambda s: (s["length"] > 3) & (s["length"] < 9), lambda s: (s["length"] > 14) | (s["length"] < 2) | (s["long"] > 0.1)),
    ("size", lambda s: s["words"] >= 50, lambda s: s["words"] < 10),
)


def votes(texts: list[str | None]) -> np.ndarray:
    """One row per text, one column per labeller: 1 good, -1 bad, 0 nothing."""
    flat = flat_words(texts)
    shares = _shares(flat, texts)
    return np.stack([good(shares).astype(int) - bad(shares).astype(int) for _, good, bad in LABELLERS], 1)


def pattern_of(ballots: np.ndarray) -> np.ndarray:
    """A number below 3 ** labellers for each row of votes."""
    return (ballots + 1) @ 3 ** np.arange(ballots.shape[1])


def ballots_of(patterns: np.ndarray, labellers: int) -> np.ndarray:
    return patterns[:, None] // 3 ** np.arange(labellers) % 3 - 1


@dataclass
class LabelModel:
    """``right[j, k]``: share of right votes among the votes of labeller j on bad (0) and good (1) texts."""

    good: float
    right: np.ndarray
    speaks: np.ndarray

    def posterior(self, ballots: np.ndarray) -> np.ndarray:
        """Probability that a text with these votes is good."""
        log = np.tile(np.log([1 - self.good, self.good]), (len(ballots), 1))
        for k, side in ((0, -1), (1, 1)):
            said = np.where(ballots == side, np.log(self.right[:, k]), np.log(1 - self.right[:, k]))
            said += np.log(self.speaks[:, k])
            log[:, k] += np.where(ballots == 0, np.log(1 - self.speaks[:, k]), said).sum(1)
        return 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -500, 500)))


def expectation_maximisation(ballots: np.ndarray, counts: np.ndarray, rounds: int = 100) -> LabelModel:
    """Fit the label model to how often each combination of votes occurs."""
    n, total = ballots.shape[1], max(counts.sum(), 1)
    start = np.tile([START_RIGHT_ON_BAD, START_RIGHT_ON_GOOD], (n, 1))
    model, weight_of_start = LabelModel(START_GOOD, start, np.full((n, 2), 0.8)), PRIOR * total
    for _ in range(rounds):
        good = model.posterior(ballots)
        share = (good * counts).sum() / total
        right, speaks = np.empty((n, 2)), np.empty((n, 2))
        for k, side in ((0, -1), (1, 1)):
            weight = (good if k else 1 - good) * counts
            yes, any_ = weight @ (ballots == side), weight @ (ballots != 0)
            right[:, k] = (yes + weight_of_start * start[:, k] + 1e-9) / (any_ + weight_of_start + 2e-9)
            speaks[:, k] = (any_ + 1) / (weight.sum() + 2)
        new = LabelModel(float(np.clip(share, 0.01, 0.99)), np.clip(right, 0.01, 0.99), np.clip(speaks, 1e-4, 1 - 1e-4))
        moved = np.abs(new.right - model.right).max() + abs(new.good - model.good)
        model = new
        if moved < 1e-7:
            break
    return model


def shape_features(texts: list[str | None], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed features of each text as (owner, bucket, value): words, and shapes of words, by their share."""
    flat = flat_words(texts)
    owner = np.repeat(np.arange(len(texts)), flat.counts)
    kept_case = [w for t in texts for w in ((t or "").encode().split())]
    shape = np.fromiter(
        (
            (2 if w.isupper() else 1 if w[:1].isupper() else 0)
            + 3 * (w[-1:] in b"#*$%&|<>!?") + 6 * (not w.isalpha()) + 12 * min(len(w), 40) for w in kept_case
        ), np.int64, len(kept_case),
    ).astype(np.uint64)
    bits = np.uint64(64 - (buckets.bit_length() - 1))
    keys = np.concatenate([flat.hashes() >> bits, mix(shape + np.uint64(1 << 40)) >> bits]).astype(np.int64)
    both = np.concatenate([owner, owner]) * buckets + keys
    pair, times = np.unique(both, return_counts=True)
    who = pair // buckets
    return who, pair % buckets, times / np.maximum(flat.counts, 1)[who]


def fit_scorer(
    rows: list[tuple[float, np.ndarray, np.ndarray]], each: np.ndarray, buckets: int = BUCKETS
) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels; each row is (posterior, buckets, values), and ``each`` has how
    many documents a row stands for."""
    weights = np.zeros(buckets)
    if not rows:
        return weights, 0.0
    y, each = np.array([r[0] for r in rows]), each / each.sum()
    row = np.repeat(np.arange(len(rows)), [len(r[1]) for r in rows])
    column, value = np.concatenate([r[1] for r in rows]), np.sqrt(np.concatenate([r[2] for r in rows]))
    bias = 0.0
    m, v = np.zeros(buckets + 1), np.zeros(buckets + 1)
    for step in range(1, STEPS + 1):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, value * weights[column], len(y)) + bias, -30, 30)))
        error = each * (p - y)
        slope = np.append(np.bincount(column, value * error[row], buckets) + 1e-4 * weights, error.sum())
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    return weights.astype(np.float32), float(bias)


def vote(batches):
    """The number of the labellers' votes on each row of Arrow batches (doc_id, text)."""
    for ids, texts in lists(text_parts(batches), "doc_id", "text"):
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(pattern_of(votes(texts)))], names=["doc_id", "pattern"])


def classify(
    docs: DataFrame, threshold: float = 0.5, per_side: int = TEXTS_PER_SIDE, carry: Sequence[str] = ()
) -> DataFrame:
    """doc_id, n_votes, posterior (of the labellers), score (of the scorer) and kept, for every row.

    ``kept`` is score >= threshold.  Null and empty texts have no features; they get the score of the
    bias, but as texts without a word they are not kept.  Every row is judged by its own text; of rows that
    share an id one trains.  Of the other columns (and ``text``) those in ``carry`` stay, whose names must
    differ from the ones above.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    plain = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"),
        *[c for c in carry if c != "text"],
    )
    carried = [f for f in plain.schema.fields if f.name in carry]

    texts_only = plain.select("doc_id", "text")
    voted = cut_lineage(texts_only.mapInArrow(vote, "doc_id bigint, pattern bigint"))
    # At most 3 ** labellers rows, whatever the size of the corpus.
    counted = voted.groupBy("pattern").agg(F.count("*").alias("n")).orderBy("pattern").collect()
    patterns = np.array([r["pattern"] for r in counted], np.int64)
    ballots = ballots_of(patterns, len(LABELLERS))
    model = expectation_maximisation(ballots, np.array([r["n"] for r in counted], float))
    posterior = dict(zip(patterns.tolist(), model.posterior(ballots).tolist()))

    good = [p for p, x in posterior.items() if x >= 0.5]
    known = voted.filter("doc_id is not null")
    side = lambda keep: (
        known.filter(F.col("pattern").isin(good) == keep).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_side)
    )
    # Bounded by 2 * per_side rows.
    chosen = cut_lineage(side(True).union(side(False)).dropDuplicates(["doc_id"]))
    sample = texts_only.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])

    def features(batches):
        for ids, texts, own in lists(text_parts(batches), "doc_id", "text", "pattern"):
            who, bucket, value = shape_features(texts)
            ends = np.searchsorted(who, np.arange(len(texts) + 1))
            cut = lambda a, t: [a[i:j].astype(t).tobytes() for i, j in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(own, pa.int64()), pa.array(cut(bucket, np.int32), pa.binary()), pa.array(cut(value, np.float32), pa.binary())],
                names=["doc_id", "pattern", "bucket", "value"],
            )

    rows = [
        (posterior[r["pattern"]], np.frombuffer(r["bucket"], np.int32), np.frombuffer(r["value"], np.float32))
        for r in sample.mapInArrow(features, "doc_id bigint, pattern bigint, bucket binary, value binary").orderBy("doc_id").toLocalIterator()
    ]
    # A side's sample stands for all its documents, so the mix that is learned is that of the table at any size.
    is_good = np.array([r[0] >= 0.5 for r in rows], bool)
    of_side = [sum(r["n"] for r in counted if (r["pattern"] in good) == keep) for keep in (False, True)]
    each = np.where(is_good, of_side[1] / max(is_good.sum(), 1), of_side[0] / max((~is_good).sum(), 1))
    shared = spark.sparkContext.broadcast((*fit_scorer(rows, each), posterior))

    def score(batches):
        weights, bias, known_posterior = shared.value
        for part in text_parts(batches):
            ids, texts = next(lists([part], "doc_id", "text"))
            ballot = votes(texts)
            own = [known_posterior[p] for p in pattern_of(ballot).tolist()]
            who, bucket, value = shape_features(texts)
            margin = np.bincount(who, weights[bucket] * np.sqrt(value), len(texts)) + bias
            value = 1 / (1 + np.exp(-np.clip(margin, -500, 500)))
            some = np.bincount(who, minlength=len(texts)) > 0
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()), pa.array(np.abs(ballot).sum(1)), pa.array(own, pa.float64()), pa.array(value),
                    pa.array((value >= threshold) & some), *[part.column(part.schema.get_field_index(f.name)) for f in carried],
                ],
                names=["doc_id", "n_votes", "posterior", "score", "kept", *[f.name for f in carried]],
            )

    answers = StructType.fromDDL("doc_id bigint, n_votes bigint, posterior double, score double, kept boolean")
    return plain.mapInArrow(score, StructType([*answers.fields, *carried]))
