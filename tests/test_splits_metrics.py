"""Delayed split and score metrics against day-by-day and pairwise loops."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from test_features import make

from tidemark.plans.metrics import (
    card_precision, detected_cards, leading_cards, performance_table, ranking_metrics, regression_metrics,
)
from tidemark.plans.splits import delayed_split, known_customers, study_window

START = dt.date(2024, 3, 2)


def split_loop(tx: pd.DataFrame, train=7, delay=7, test=7):
    start = pd.Timestamp(START)
    study = tx[(tx.tx_datetime >= start) & (tx.tx_datetime <= start + pd.Timedelta(days=train + delay + test + 1))]
    train_rows = study[(study.tx_datetime >= start) & (study.tx_datetime <= start + pd.Timedelta(days=train))]
    known = set(train_rows[train_rows.tx_fraud == 1].customer_id)
    first, ids = train_rows.tx_time_days.min(), []
    for day in range(test):
        late = study[(study.tx_time_days == first + train + day - 1) & (study.tx_fraud == 1)]
        known |= set(late.customer_id)
        today = study[study.tx_time_days == first + train + delay + day]
        ids += list(today[~today.customer_id.isin(known)].transaction_id)
    return sorted(train_rows.transaction_id), sorted(ids)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_split_equals_the_day_loop(spark, seed):
    rng = random.Random(seed)
    items = [
        (i, rng.randrange(28), rng.choice([0, 6, 12, 23]), 1 if rng.random() < 0.33 else rng.randrange(2, 60), 1, 5, int(rng.random() < 0.04))
        for i in range(900)
    ]
    tx = make(spark, items)
    train, test = delayed_split(study_window(tx, START), START)
    want_train, want_test = split_loop(tx.toPandas())
    assert sorted(r[0] for r in train.select("transaction_id").collect()) == want_train
    assert sorted(r[0] for r in test.select("transaction_id").collect()) == want_test
    assert want_test and not set(want_train) & set(want_test)


def test_training_takes_in_both_midnights_and_the_last_training_day_is_known(spark):
    tx = make(
        spark,
        [
            (1, 1, 0, 1, 1, 5, 0),       # midnight of the start
            (2, 8, 0, 2, 1, 5, 1),       # midnight after seven days: still training
            (3, 8, 1, 3, 1, 5, 1),       # first delay day: known from the second test day on
            (4, 15, 5, 1, 1, 5, 0), (5, 15, 5, 2, 1, 5, 0), (6, 15, 5, 3, 1, 5, 0), (7, 16, 5, 3, 1, 5, 0),
        ],
    )
    train, test = delayed_split(study_window(tx, START), START)
    assert [r[0] for r in rows(train.select("transaction_id"))] == [1, 2]
    assert [r[0] for r in rows(test.select("transaction_id"))] == [4, 6]


def scored_frame(spark, n=400, seed=5, levels=7, days=6, cards=40):
    rng = random.Random(seed)
    data = [
        (rng.randrange(days), 1 if rng.random() < 0.33 else rng.randrange(cards), rng.randrange(levels) / 10, int(rng.random() < 0.25))
        for _ in range(n)
    ]
    return spark.createDataFrame(data, "tx_time_days bigint, customer_id bigint, score double, tx_fraud bigint")


@pytest.mark.parametrize("levels, buckets", [(1, 4), (7, 3), (7, 50), (10**6, 8)])
def test_ranking_metrics_against_pairs(spark, levels, buckets):
    df = scored_frame(spark, levels=levels)
    data = df.toPandas()
    pos, neg = data[data.tx_fraud == 1].score.to_numpy(), data[data.tx_fraud == 0].score.to_numpy()
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    ap, recall = 0.0, 0.0
    for cut in sorted(data.score.unique(), reverse=True):
        picked = data[data.score >= cut]
        now = (picked.tx_fraud == 1).sum() / len(pos)
        ap, recall = ap + (now - recall) * picked.tx_fraud.mean(), now
    got = ranking_metrics(df, buckets=buckets).first()
    assert got["auc_roc"] == pytest.approx(wins / (len(pos) * len(neg)))
    assert got["average_precision"] == pytest.approx(ap)
    assert (got["positives"], got["negatives"]) == (len(pos), len(neg))


def test_constant_score_is_the_baseline(spark):
    df = scored_frame(spark, levels=1)
    got = ranking_metrics(df).first()
    assert got["auc_roc"] == pytest.approx(0.5)
    assert got["average_precision"] == pytest.approx(got["positives"] / (got["positives"] + got["negatives"]))


def test_one_class_only_has_no_auc(spark):
    df = spark.createDataFrame([(1.0, 1), (0.5, 1)], "score double, tx_fraud bigint")
    assert ranking_metrics(df).first()["auc_roc"] is None


def card_loop(data: pd.DataFrame, k: int, remove: bool):
    found, out = set(), []
    for day in sorted(data.tx_time_days.unique()):
        today = data[(data.tx_time_days == day) & ~data.customer_id.isin(found)]
        cards = today.groupby("customer_id").max().reset_index().sort_values(["score", "customer_id"], ascending=[False, True])
        hits = list(cards.head(k).query("tx_fraud == 1").customer_id)
        out.append((day, today[today.tx_fraud == 1].customer_id.nunique(), len(hits), len(hits) / k))
        if remove:
            found |= set(hits)
    return out


@pytest.mark.parametrize("k, remove", [(3, True), (3, False), (10, True), (100, True)])
def test_card_precision_equals_the_day_loop(spark, k, remove):
    df = scored_frame(spark)
    got = card_precision(df, k, remove_detected=remove)
    assert [tuple(r) for r in got.orderBy("tx_time_days").collect()] == card_loop(df.toPandas(), k, remove)


def test_a_year_of_days_with_few_rows_to_decide(spark):
    """The list that decides is k sure cards a day and the earlier frauds above them; no task sees all days."""
    rng, k, days = random.Random(21), 5, 365
    data = [
        (d, c, rng.random() + (c % 9 == 0), int(c % 9 == 0 and rng.random() < 0.5))
        for d in range(days) for c in rng.sample(range(400), 60)
    ]
    df = spark.createDataFrame(data, "tx_time_days bigint, customer_id bigint, score double, tx_fraud bigint").cache()
    cards, leading = leading_cards(df, k)
    ever = {c for _, c, _, label in data if label}
    per_day = {d: sum(c in ever for day, c, *_ in data if day == d) for d in range(days)}
    sizes = {r["day"]: r["count"] for r in leading.groupBy("day").count().collect()}
    assert all(sizes[d] <= k + per_day[d] for d in range(days))
    assert leading.count() < 0.35 * cards.count()
    got = card_precision(df, k)
    assert [tuple(r) for r in got.orderBy("tx_time_days").collect()] == card_loop(df.toPandas(), k, True)


def test_detections_that_depend_on_each_other(spark):
    """Every day's hit moves the next day's list; one card is found a day, the last one after many rounds."""
    n = 8
    data = [(d, c, 1.0 - c / 100, 1) for d in range(n) for c in range(n)]
    df = spark.createDataFrame(data, "tx_time_days bigint, customer_id bigint, score double, tx_fraud bigint")
    found = detected_cards(leading_cards(df, 1)[1], 1)
    assert rows(found) == [(c, c) for c in range(n)]
    assert [tuple(r) for r in card_precision(df, 1).orderBy("tx_time_days").collect()] == card_loop(df.toPandas(), 1, True)


def test_known_customers_are_those_the_split_leaves_out(spark):
    rng = random.Random(5)
    items = [(i, rng.randrange(28), 6, rng.randrange(1, 40), 1, 5, int(rng.random() < 0.1)) for i in range(900)]
    tx = study_window(make(spark, items), START)
    known = {r["customer_id"]: r["known_from"] for r in known_customers(tx, START).collect()}
    train, test = delayed_split(tx, START)
    first = train.agg({"tx_time_days": "min"}).first()[0]
    rows_ = tx.collect()
    kept = {r["transaction_id"] for r in test.collect()}
    for r in rows_:
        day = r["tx_time_days"] - first - 14
        if 0 <= day < 7:
            assert (r["transaction_id"] in kept) == (known.get(r["customer_id"], 99) > day)


def test_performance_table(spark):
    df = scored_frame(spark)
    row = performance_table(df, top_k=(3, 10)).first()
    for k in (3, 10):
        mean = np.mean([r[3] for r in card_loop(df.toPandas(), k, True)])
        assert row[f"card_precision_{k}"] == pytest.approx(round(mean, 3))


def test_regression_metrics(spark):
    y, p = np.array([1.0, 2.0, 4.0, 8.0]), np.array([1.5, 2.0, 3.0, 9.0])
    row = regression_metrics(spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, p double"), "y", "p").first()
    assert row["mae"] == pytest.approx(np.abs(y - p).mean())
    assert row["rmse"] == pytest.approx(np.sqrt(((y - p) ** 2).mean()))
    assert row["r2"] == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
