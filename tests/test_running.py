"""Ordered computations cut into buckets, against numpy and plain sorts."""

import collections
import datetime as dt
import math
import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import Window, functions as F

from tidemark.operators.running import (
    group_quantiles, moving_average, order_key, range_buckets, running_totals, with_position,
)
from tidemark.plans.metrics import ranking_metrics
from tidemark.operators.topk import sample_rows, top_k, top_k_per_group


@pytest.fixture(scope="module")
def bookings(spark):
    rng = random.Random(11)
    data = []
    for ref in rng.sample(range(10**6), 500):
        day = dt.date(2021, 3, 19) if rng.random() < 0.4 else dt.date(2021, 1, 1) + dt.timedelta(days=rng.randrange(300))
        data.append((ref, day, rng.choice(["a", "b", "c"]), rng.choice([None, 100, 200, 350])))
    return spark.createDataFrame(data, "ref bigint, day date, hotel string, cost int").repartition(5)


def ordered(bookings):
    return sorted(((r["day"], r["ref"], r["hotel"], r["cost"]) for r in bookings.collect()), key=lambda r: r[:2])


@pytest.mark.parametrize("buckets", [1, 3, 40])
def test_global_position(spark, bookings, buckets):
    got = with_position(bookings, ["day", "ref"], order_key(bookings, "day", "ref"), buckets=buckets)
    want = {r[1]: i for i, r in enumerate(ordered(bookings))}
    assert {r["ref"]: r["position"] for r in got.collect()} == want


@pytest.mark.parametrize("chunk_rows", [30, 31, 47, 10**6])
def test_global_moving_average(spark, bookings, chunk_rows):
    got = moving_average(
        bookings, "cost", 30, ["day", "ref"], key=order_key(bookings, "day", "ref"), chunk_rows=chunk_rows
    )
    data = ordered(bookings)
    result = {r["ref"]: r["moving_avg"] for r in got.collect()}
    assert len(result) == got.count() == len(data)
    for i, row in enumerate(data):
        costs = [r[3] for r in data[max(0, i - 29): i + 1] if r[3] is not None]
        assert result[row[1]] == (pytest.approx(np.mean(costs)) if costs else None)


def test_moving_average_needs_a_long_enough_chunk(spark, bookings):
    with pytest.raises(ValueError):
        moving_average(bookings, "cost", 30, ["day"], key=F.lit(1.0), chunk_rows=10)


@pytest.mark.parametrize("chunk_rows", [5, 37, 10**6])
def test_moving_average_by_group(spark, bookings, chunk_rows):
    key = order_key(bookings, "day", "ref")
    got = moving_average(bookings, "cost", 5, ["day", "ref"], key, by=["hotel"], chunk_rows=chunk_rows)
    result = {r["ref"]: r["moving_avg"] for r in got.collect()}
    for hotel in "abc":
        data = [r for r in ordered(bookings) if r[2] == hotel]
        for i, row in enumerate(data):
            costs = [r[3] for r in data[max(0, i - 4): i + 1] if r[3] is not None]
            assert result[row[1]] == (pytest.approx(np.mean(costs)) if costs else None)


def test_running_totals_keep_null_groups(spark):
    points = spark.createDataFrame(
        [(None, 1.0, 2), (None, 2.0, 3), ("x", 1.0, 5), ("x", 3.0, 7)], "g string, o double, n bigint"
    )
    cut = range_buckets("o", points, 3)(points)
    got = running_totals(cut, "o", ["n"], ["g"]).select("g", "o", "running_n")
    assert rows(got) == rows(spark.createDataFrame([(None, 1.0, 2), (None, 2.0, 5), ("x", 1.0, 5), ("x", 3.0, 12)], "g string, o double, n bigint"))


def test_position_within_groups_with_null_keys(spark):
    df = spark.createDataFrame([("a", 3.0), (None, 2.0), ("a", 1.0), (None, 5.0), (None, 4.0)], "g string, o double")
    got = with_position(df, ["o"], F.col("o"), ["g"], buckets=3)
    assert rows(got) == rows(spark.createDataFrame([("a", 1.0, 0), ("a", 3.0, 1), (None, 2.0, 0), (None, 4.0, 1), (None, 5.0, 2)], "g string, o double, p bigint"))


@pytest.mark.parametrize("buckets", [1, 4, 64])
def test_group_quantiles_with_one_large_group(spark, buckets):
    rng = random.Random(2)
    data = [("big" if rng.random() < 0.7 else rng.choice("ab"), rng.choice([5.0, 5.0, rng.random() * 100])) for _ in range(800)]
    data += [("one", 3.0), ("big", None), ("empty", None)]
    df = spark.createDataFrame(data, "g string, v double")
    wanted = {"low": 0.0, "q1": 0.25, "median": 0.5, "p90": 0.9, "high": 1.0}
    got = {r["g"]: r for r in group_quantiles(df, "v", ["g"], wanted, buckets).collect()}
    assert set(got) == {"big", "a", "b", "one"}
    for g, row in got.items():
        values = [v for k, v in data if k == g and v is not None]
        assert row["n"] == len(values)
        for name, q in wanted.items():
            assert row[name] == pytest.approx(np.quantile(values, q))


@pytest.mark.parametrize("k, salts", [(1, 1), (5, 4), (50, 64), (10**4, 8)])
def test_top_k_per_group(spark, k, salts):
    rng = random.Random(4)
    data = [("hot" if rng.random() < 0.5 else rng.choice("ab"), i, rng.randrange(9)) for i in range(700)]
    df = spark.createDataFrame(data, "g string, id bigint, s int")
    got = top_k_per_group(df, ["g"], [F.desc("s"), F.asc("id")], k, ["id"], salts=salts)
    want = []
    for g in {r[0] for r in data}:
        best = sorted((r for r in data if r[0] == g), key=lambda r: (-r[2], r[1]))[:k]
        want += [(*r, i + 1) for i, r in enumerate(best)]
    assert rows(got) == sorted(want, key=lambda r: tuple((False, str(v)) for v in r))


def test_top_k_and_sample(spark):
    df = spark.range(1000)
    assert [r[0] for r in top_k(df, [F.desc("id")], 3).collect()] == [999, 998, 997]
    assert sample_rows(df.limit(2), 5, ["id"]).count() == 2
    drawn = [{r[0] for r in sample_rows(df.repartition(n), 5, ["id"], seed=7).collect()} for n in (2, 7)]
    assert len(drawn[0]) == 5 and drawn[0] == drawn[1]
    assert drawn[0] != {r[0] for r in sample_rows(df, 5, ["id"], seed=8).collect()}


def test_nulls_keep_their_rows(spark):
    """Null dates, references, groups and values against plain windows."""
    data = [(dt.date(2024, 1, 1 + i % 5) if i % 4 else None, i if i % 3 else None, i % 2 or None, i, float(i)) for i in range(40)]
    df = spark.createDataFrame(data, "day date, ref bigint, g int, id bigint, v double")
    order = ["day", "ref", "id"]
    plain = Window.partitionBy("g").orderBy(*order)
    got = with_position(df, order, order_key(df, "day", "ref"), ["g"], buckets=3)
    assert rows(got) == rows(df.withColumn("position", F.row_number().over(plain) - 1))
    mean = F.avg("v").over(plain.rowsBetween(-2, 0))
    got = moving_average(df, "v", 3, order, order_key(df, "day", "ref"), ["g"], chunk_rows=4)
    assert rows(got) == rows(df.withColumn("moving_avg", mean))


@pytest.mark.parametrize("rows_", [300, 3000])
def test_buckets_stay_small_when_rows_grow(spark, rows_):
    """Two levels of cuts; buckets of about 20 rows at 300 rows and at ten times as many."""
    rng = random.Random(rows_)
    data = [(rng.gauss(0, 1) if i % 10 else 0.0,) for i in range(rows_)] + [(None,), (float("nan"),), (float("-inf"),)]
    df = spark.createDataFrame(data, "o double").withColumn("id", F.monotonically_increasing_id()).cache()
    cuts = range_buckets("o", df.filter("o <> 0"), rows_per_bucket=20, fan_out=16)
    assert cuts.levels == (1 if rows_ == 300 else 2)
    placed = cuts(df).collect()
    in_order = sorted(placed, key=lambda r: (r["o"] is not None, 0 if r["o"] is None else (np.inf if np.isnan(r["o"]) else r["o"])))
    numbers = [r["bucket"] for r in in_order]
    assert len(placed) == rows_ + 3 and numbers == sorted(numbers)
    sizes = collections.Counter(r["bucket"] for r in placed if r["o"] != 0)
    assert max(sizes.values()) <= 45
    got = with_position(df, ["o", "id"], F.col("o"), fan_out=4, buckets=30)
    assert rows(got.select("id", "position")) == rows(df.select("id", (F.row_number().over(Window.orderBy("o", "id")) - 1).alias("position")))


@pytest.mark.parametrize("fan_out, buckets", [(3, 25), (4, 60), (1000, 4)])
def test_totals_along_a_tree_of_buckets(spark, fan_out, buckets):
    rng = random.Random(9)
    data = list({(rng.choice(["x", None, "y"]), rng.random()): 0 for _ in range(500)})
    points = spark.createDataFrame([(g, o, rng.randrange(9)) for g, o in data], "g string, o double, n bigint").cache()
    cuts = range_buckets("o", points, buckets, fan_out=fan_out)
    assert cuts.levels == (1 if fan_out == 1000 else math.ceil(math.log(buckets, fan_out)))
    for by in ([], ["g"]):
        window = Window.partitionBy(*by)
        want = points.select(
            "g", "o", F.sum("n").over(window.orderBy("o").rowsBetween(Window.unboundedPreceding, 0)).alias("r"), F.sum("n").over(window).alias("t")
        )
        got = running_totals(cuts(points), "o", ["n"], by, levels=cuts.levels, fan_out=fan_out)
        assert rows(got.select("g", "o", "running_n", "total_n")) == rows(want)


def test_quantiles_with_deep_cuts(spark):
    rng = random.Random(12)
    data = [(rng.choice("ab"), rng.random()) for _ in range(700)]
    got = group_quantiles(spark.createDataFrame(data, "g string, v double"), "v", ["g"], {"q": 0.37}, buckets=40, fan_out=6)
    for row in got.collect():
        assert row["q"] == pytest.approx(np.quantile([v for g, v in data if g == row["g"]], 0.37))


def test_ranking_leaves_missing_scores_out(spark):
    scored = spark.createDataFrame([(1, 0.9), (0, 0.5), (1, None), (0, None), (None, 0.7)], "tx_fraud int, score double")
    row = ranking_metrics(scored).first()
    assert (row["auc_roc"], row["average_precision"], row["positives"], row["negatives"]) == (1.0, 1.0, 1, 1)
