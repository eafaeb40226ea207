"""Feature windows: edge cases by hand, hot customers, and dense against sparse."""

import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import Window, functions as F

from tidemark.plans import features as feat
from tidemark.sources.schemas import TRANSACTIONS

DAY0 = dt.datetime(2024, 3, 1)


def make(spark, items):
    """(id, day, hour, customer, terminal, amount, fraud) to transactions."""
    data = []
    for i, day, hour, customer, terminal, amount, fraud in items:
        at = DAY0 + dt.timedelta(days=day, hours=hour)
        data.append((i, at, customer, terminal, float(amount), 0, day, fraud, fraud))
    return spark.createDataFrame(data, TRANSACTIONS)


def by_id(df):
    return {r["transaction_id"]: r for r in df.collect()}


def test_last_day_is_kept_unless_left_out(spark):
    tx = make(spark, [(1, 0, 10, 1, 1, 5, 0), (2, 1, 10, 1, 1, 5, 0), (3, 2, 0, 1, 1, 5, 0)])
    assert set(by_id(feat.feature_table(tx, include_last_day=False))) == {1, 2}
    assert set(by_id(feat.feature_table(tx))) == {1, 2, 3}


def test_zero_amounts_count_today_but_not_before(spark):
    tx = make(spark, [(1, 0, 1, 7, 1, 0, 0), (2, 0, 2, 7, 1, 4, 0), (3, 1, 3, 7, 1, 6, 0), (4, 3, 0, 7, 1, 1, 0)])
    got = by_id(feat.feature_table(tx))
    assert [got[i]["cust_cnt_tx_1"] for i in (1, 2, 3)] == [1, 2, 2]
    assert got[3]["cust_avg_amount_1"] == pytest.approx((4 + 6) / 2)


def test_same_moment_counts_each_other(spark):
    tx = make(spark, [(1, 0, 5, 1, 1, 2, 0), (2, 0, 5, 1, 1, 4, 0), (3, 0, 6, 1, 1, 6, 0), (9, 2, 0, 2, 1, 1, 0)])
    got = by_id(feat.feature_table(tx))
    assert [got[i]["cust_cnt_tx_1"] for i in (1, 2, 3)] == [2, 2, 3]
    assert got[1]["cust_avg_amount_1"] == pytest.approx(3.0)


def test_first_day_has_no_terminal_counts_and_no_risk(spark):
    tx = make(spark, [(1, 0, 5, 1, 1, 2, 1), (2, 1, 5, 1, 1, 2, 0), (3, 2, 5, 1, 1, 2, 0)])
    got = by_id(feat.feature_table(tx))
    assert got[1]["nb_tx_window_1"] is None and got[1]["term_risk_1"] == 0.0
    assert got[2]["nb_tx_window_1"] == 0 and got[2]["term_risk_30"] == 0.0


def test_risk_windows_are_shifted_by_the_delay(spark):
    # A fraud on day 3 is seen by the 1-day window on day 11 only, by the 7-day one on days 11-17.
    items = [(100, 3, 1, 1, 5, 1, 1)] + [(d, d, 2, 2, 5, 1, 0) for d in range(0, 25)] + [(200, 25, 0, 3, 6, 1, 0)]
    got = by_id(feat.feature_table(make(spark, items)))
    assert [d for d in range(25) if got[d]["term_risk_1"] > 0] == [11]
    assert [d for d in range(25) if got[d]["term_risk_7"] > 0] == list(range(11, 18))
    assert got[11]["term_risk_1"] == pytest.approx(1 / 2)
    literal = by_id(feat.feature_table(make(spark, items), literal_reference=True))
    assert all(literal[d]["term_risk_7"] == literal[d]["term_risk_1"] for d in range(25))
    assert all(literal[d]["nb_tx_window_7"] == literal[d]["nb_tx_window_1"] for d in range(25))


@pytest.mark.parametrize("hour, night", [(5, 1), (6, 0), (20, 0), (21, 1)])
def test_night_hours(spark, hour, night):
    flags = feat.with_time_flags(make(spark, [(1, 0, hour, 1, 1, 1, 0)])).first()
    assert flags["tx_during_night"] == night


def test_weekend_days(spark):
    # 2024-03-01 is a Friday.
    flags = feat.with_time_flags(make(spark, [(d, d, 12, 1, 1, 1, 0) for d in range(4)]))
    assert [r["tx_during_weekend"] for r in flags.orderBy("transaction_id").collect()] == [0, 1, 1, 0]


def random_transactions(spark, n=600, seed=3):
    """A third of all rows belong to one customer and one terminal."""
    rng = random.Random(seed)
    items = []
    for i in range(n):
        hot = rng.random() < 0.34
        items.append(
            (
                i, rng.randrange(50), rng.choice([0, 9, 9, 9.0003, 13, 22]), 1 if hot else rng.randrange(2, 20),
                1 if hot else rng.randrange(2, 9), rng.choice([0, 1.25, 10, 99.5]), int(rng.random() < 0.2),
            )
        )
    return make(spark, items)


@pytest.fixture(scope="module")
def skewed(spark):
    return random_transactions(spark).cache()


def plain_day_so_far(tx):
    until_now = Window.partitionBy("customer_id", F.to_date("tx_datetime")).orderBy("tx_datetime").rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return tx.select(
        "transaction_id", F.count("customer_id").over(until_now).alias("cur_day_trx"),
        F.sum(F.rint(F.col("tx_amount") * 100).cast("long")).over(until_now).alias("cur_day_amt"),
    )


@pytest.mark.parametrize("nulls", [0, 3, 1])
def test_day_so_far_equals_one_window(spark, skewed, nulls):
    """No customer, every third and every row without a customer."""
    tx = skewed if nulls == 0 else skewed.withColumn("customer_id", F.when(F.col("transaction_id") % nulls != 0, F.col("customer_id")))
    got = feat.with_day_so_far(tx, per_one=100).select("transaction_id", "cur_day_trx", "cur_day_amt")
    assert rows(got) == rows(plain_day_so_far(tx))
    assert got.count() == tx.count()


def test_a_third_of_all_rows_at_one_moment(spark):
    copies = [(i, 1, 9, 1, 1, 2.5, 0) for i in range(300)]
    others = [(300 + i, i % 4, i % 24, 2 + i % 5, 1, 1, 0) for i in range(600)]
    tx = make(spark, copies + others)
    assert feat.day_moments(tx.withColumn("tx_date", F.to_date("tx_datetime"))).filter("customer_id = 1").count() == 1
    assert by_id(feat.feature_table(tx, per_one=100))[7]["cust_cnt_tx_1"] == 300


def test_unknown_amounts_leave_the_average_open(spark):
    tx = make(spark, [(1, 0, 5, 1, 1, 2, 0), (2, 0, 6, 1, 1, 4, 0), (3, 0, 7, 1, 1, 6, 0), (9, 2, 0, 2, 1, 1, 0)])
    tx = tx.withColumn("tx_amount", F.when(F.col("transaction_id") != 2, F.col("tx_amount")))
    tx = tx.withColumn("tx_amount", F.when(F.col("transaction_id") != 1, F.col("tx_amount")))
    got = by_id(feat.feature_table(tx, per_one=100))
    assert got[1]["cust_avg_amount_1"] is None and got[2]["cust_avg_amount_1"] is None
    assert got[3]["cust_avg_amount_1"] == pytest.approx(2.0) and got[3]["cust_cnt_tx_1"] == 3


def test_sparse_windows_equal_dense_ones(spark, skewed):
    dense = feat.customer_day_windows(feat.dense_customer_daily(skewed, include_last_day=True, per_one=100))
    sparse = feat.customer_days(skewed, per_one=100)
    joined = sparse.join(dense, ["customer_id", "tx_date"])
    for w in feat.WINDOWS:
        for a, b in ((f"prev_n_{w}", f"cust_tx_prev_{w}"), (f"prev_amount_{w}", f"cust_tot_amt_prev_{w}")):
            assert joined.filter(F.col(a) != F.coalesce(b, F.lit(0))).count() == 0


def test_money_in_cents_equals_plain_sums(spark, skewed):
    cents = by_id(feat.feature_table(skewed, per_one=100))
    plain = by_id(feat.feature_table(skewed))
    for i, row in cents.items():
        for w in feat.WINDOWS:
            assert row[f"cust_avg_amount_{w}"] == pytest.approx(plain[i][f"cust_avg_amount_{w}"])


def test_features_against_plain_loops(spark, skewed):
    tx = [r.asDict() for r in skewed.collect()]
    first = min(r["tx_datetime"] for r in tx).date()
    got = by_id(feat.feature_table(skewed, per_one=100))
    assert set(got) == {r["transaction_id"] for r in tx}
    for r in tx:
        today, mine = r["tx_datetime"].date(), got[r["transaction_id"]]
        back = lambda o: (today - o["tx_datetime"].date()).days
        same = [o for o in tx if o["customer_id"] == r["customer_id"]]
        now = [o for o in same if back(o) == 0 and o["tx_datetime"] <= r["tx_datetime"]]
        terminal = [o for o in tx if o["terminal_id"] == r["terminal_id"]]
        for w in feat.WINDOWS:
            before = [o for o in same if 1 <= back(o) <= w]
            count = sum(o["tx_amount"] > 0 for o in before) + len(now)
            amount = sum(o["tx_amount"] for o in before + now)
            assert mine[f"cust_cnt_tx_{w}"] == count
            assert mine[f"cust_avg_amount_{w}"] == pytest.approx(amount / count)
            seen = [o for o in terminal if 8 <= back(o) <= 7 + w]
            frauds = sum(o["tx_fraud"] for o in seen)
            assert mine[f"nb_tx_window_{w}"] == (None if today == first else len(seen))
            assert mine[f"term_risk_{w}"] == pytest.approx(frauds / len(seen) if frauds else 0.0)
