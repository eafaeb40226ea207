"""Quality of scores against 0/1 labels, and of regression predictions.

All measures are exact: scores are counted per distinct value, never binned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.materialise import cut_lineage
from tidemark.operators.running import range_buckets, running_totals
from tidemark.operators.topk import top_k_per_group


def _threshold_points(scored: DataFrame, label: str, score: str, buckets: int | None) -> DataFrame:
    """Positives and negatives per distinct score, with running totals from the highest down.

    Rows without a score or a label cannot be ranked and are left out before anything is counted.
    """
    scored = scored.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
    rows = scored.select((-F.col(score).cast("double")).alias("below"), F.col(label).alias("label"))
    points = rows.groupBy("below").agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") != 1).alias("neg")
    )
    cuts = range_buckets("below", points.select("below"), buckets)
    return running_totals(cuts(points), "below", ["pos", "neg"], levels=cuts.levels)


def ranking_metrics(
    scored: DataFrame, label: str = "tx_fraud", score: str = "score", buckets: int | None = None
) -> DataFrame:
    """One row with ROC AUC and average precision.

    AUC is the chance that a positive outranks a negative, ties counting half.  Average
    precision sums precision times gained recall over the distinct thresholds.  Rows with a null
    score or label are not part of either.
    """
    points = _threshold_points(scored, label, score, buckets)
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    all_pos, all_neg = F.sum(pos), F.sum(neg)
    outranked = pos * (F.col("running_neg") - neg / 2)      # negatives above, ties half
    precision = F.col("running_pos") / (F.col("running_pos") + F.col("running_neg"))
    return points.agg(
        (1 - F.sum(outranked) / F.nullif(all_pos * all_neg, F.lit(0.0))).alias("auc_roc"),
        (F.sum(pos * precision) / F.nullif(all_pos, F.lit(0.0))).alias("average_precision"),
        F.sum("pos").alias("positives"),
        F.sum("neg").alias("negatives"),
    )


def leading_cards(
    scored: DataFrame, k: int, label: str = "tx_fraud", score: str = "score",
    day: str = "tx_time_days", card: str = "customer_id",
) -> tuple[DataFrame, DataFrame]:
    """All cards per day (stored), and per day those that can be among its first k, with their ``place``.

    A card can be missing on a day only if it was a fraud on an earlier one.  The k best of the others are
    there for sure, so nothing below the k-th of them matters.  What is left is, per day, k sure
    cards and the earlier frauds that rank above the last of those.
    """
    cards = scored.groupBy(F.col(day).alias("day"), F.col(card).alias("card")).agg(
        F.max(F.col(score).cast("double")).alias("score"), F.max(label).alias("label")
    )
    first_fraud = F.min(F.when(F.col("label") == 1, F.col("day"))).over(Window.partitionBy("card"))
    cards = cut_lineage(cards.withColumn("sure", F.coalesce(first_fraud >= F.col("day"), F.lit(True))))
    order = [F.desc("score"), F.asc("card")]
    sure = top_k_per_group(cards.filter("sure"), ["day"], order, k, ["card"], rank="place")
    last = sure.filter(F.col("place") == k).select("day", F.col("score").alias("low"), F.col("card").alias("last"))
    above = F.col("low").isNull() | (F.col("score") > F.col("low")) | ((F.col("score") == F.col("low")) & (F.col("card") < F.col("last")))
    others = cards.filter(~F.col("sure")).join(last, "day", "left").filter(above)
    columns = ["day", "card", "score", "label"]
    both = sure.select(columns).union(others.select(columns))
    return cards, both.withColumn("place", F.row_number().over(Window.partitionBy("day").orderBy(*order)))


def detected_cards(leading: DataFrame, k: int) -> DataFrame:
    """(card, found): each card and the day on which it is among the first k as a fraud for the first time.

    A card that was found is left out on later days, so a day depends on all days before it.  Rounds
    settle that without a task that sees all days: every round ranks each day's list by itself, without
    the cards that the round before found earlier.  The first day is right after one round, day n
    after n at the latest, and once a round changes nothing all days are.
    """
    found = None
    while True:
        there = leading
        if found is not None:
            # At most k cards per day, each on one day, so the broadcast is bounded.
            there = leading.join(F.broadcast(found), "card", "left").filter(F.coalesce(F.col("found") >= F.col("day"), F.lit(True)))
        place = F.row_number().over(Window.partitionBy("day").orderBy("place"))
        first = there.select("day", "card", "label", place.alias("now")).filter((F.col("now") <= k) & (F.col("label") == 1))
        latest = cut_lineage(first.groupBy("card").agg(F.min("day").alias("found")))
        if found is not None and latest.count() == found.count() and latest.join(found, ["card", "found"], "left_anti").isEmpty():
            return latest
        found = latest


def card_precision(
    scored: DataFrame, k: int, label: str = "tx_fraud", score: str = "score",
    day: str = "tx_time_days", card: str = "customer_id", remove_detected: bool = True,
) -> DataFrame:
    """Per day: frauded cards, frauds among the k top-scored cards, and hits / k.

    Cards found on one day are left out on later days.  Equal scores are taken in card order; ``day`` is a
    whole number.  A card that is null is one card and is never left out.
    """
    if remove_detected:
        cards, leading = leading_cards(scored, k, label, score, day, card)
        found = detected_cards(cut_lineage(leading), k)
        hits_per_day = found.groupBy(F.col("found").alias("day")).agg(F.count(F.lit(1)).alias("hits"))
        frauds = cards.filter(F.col("label") == 1).join(F.broadcast(found), "card", "left")
        open_frauds = frauds.filter(F.coalesce(F.col("found") >= F.col("day"), F.lit(True)))
    else:
        cards = scored.groupBy(F.col(day).alias("day"), F.col(card).alias("card")).agg(
            F.max(F.col(score).cast("double")).alias("score"), F.max(label).alias("label")
        )
        best = top_k_per_group(cards, ["day"], [F.desc("score"), F.asc("card")], k, ["card"])
        hits_per_day = best.groupBy("day").agg(F.count_if(F.col("label") == 1).alias("hits"))
        open_frauds = cards.filter(F.col("label") == 1)
    per_day = (
        cards.select("day").distinct()
        .join(open_frauds.groupBy("day").agg(F.count(F.lit(1)).alias("frauded_cards")), "day", "left")
        .join(hits_per_day, "day", "left")
    )
    hits = F.coalesce("hits", F.lit(0))
    return per_day.select(
        F.col("day").alias(day), F.coalesce("frauded_cards", F.lit(0)).alias("frauded_cards"), hits.alias("hits"),
        (hits / F.lit(k)).alias("card_precision"),
    )


def performance_table(
    scored: DataFrame, label: str = "tx_fraud", score: str = "score", top_k: Sequence[int] = (100,), digits: int = 3
) -> DataFrame:
    """One row: AUC, average precision and mean card precision for each k, rounded."""
    row = ranking_metrics(scored, label, score).select(
        F.round("auc_roc", digits).alias("auc_roc"),
        F.round("average_precision", digits).alias("average_precision"),
    )
    for k in top_k:
        mean = card_precision(scored, k, label, score).agg(F.avg("card_precision")).scalar()
        row = row.withColumn(f"card_precision_{k}", F.round(mean, digits))
    return row


def regression_metrics(df: DataFrame, actual: str, predicted: str | Column) -> DataFrame:
    """Mean absolute and squared error, its root, and R², in one pass."""
    y = F.col(actual).cast("double")
    error = y - (F.col(predicted) if isinstance(predicted, str) else predicted)
    return df.select(y.alias("y"), error.alias("e")).agg(
        F.avg(F.abs("e")).alias("mae"),
        F.avg(F.col("e") * F.col("e")).alias("mse"),
        F.sqrt(F.avg(F.col("e") * F.col("e"))).alias("rmse"),
        (1 - F.avg(F.col("e") * F.col("e")) / F.nullif(F.var_pop("y"), F.lit(0.0))).alias("r2"),
    )
