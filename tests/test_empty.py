"""Jobs on frames without rows, without positives, and with one row."""

import datetime as dt

from conftest import rows
from pyspark.sql import functions as F
from test_features import make

from tidemark.operators.filters import filter_funnel
from tidemark.operators.profile import correlation_matrix, density, describe, histogram
from tidemark.operators.quality import MetricCheck, run_checks
from tidemark.operators.running import group_quantiles, moving_average, order_key
from tidemark.plans.features import feature_table
from tidemark.plans.metrics import card_precision, performance_table, ranking_metrics
from tidemark.plans.splits import delayed_split, study_window
from tidemark.plans.trips import trips_by_month, trips_by_temperature
from tidemark.sources import schemas

START = dt.date(2024, 3, 1)


def test_no_transactions(spark):
    tx = spark.createDataFrame([], schemas.TRANSACTIONS)
    assert feature_table(tx, per_one=100).count() == 0
    train, test = delayed_split(study_window(tx, START), START)
    assert train.count() == test.count() == 0


def test_one_transaction(spark):
    tx = make(spark, [(1, 0, 5, 1, 1, 2, 0)])
    assert feature_table(tx, include_last_day=False).count() == 0
    row = feature_table(tx).first()
    assert row["cust_cnt_tx_30"] == 1 and row["nb_tx_window_30"] is None and row["term_risk_30"] == 0


SCORED = "tx_time_days bigint, customer_id bigint, score double, tx_fraud bigint"


def test_metrics_without_rows_or_positives(spark):
    none = spark.createDataFrame([], SCORED)
    assert ranking_metrics(none).first()["auc_roc"] is None
    assert card_precision(none, 5).count() == 0
    honest = spark.createDataFrame([(3, 1, 0.5, 0), (3, 2, 0.6, 0), (9, 1, 0.1, 0)], SCORED)
    assert rows(card_precision(honest, 5)) == [(3, 0, 0, 0.0), (9, 0, 0, 0.0)]
    row = performance_table(honest, top_k=(5,)).first()
    assert row["auc_roc"] is None and row["card_precision_5"] == 0


def test_ordered_work_without_rows(spark):
    df = spark.createDataFrame([], "day date, ref bigint, g string, v double")
    assert moving_average(df, "v", 3, ["day", "ref"], order_key(df, "day", "ref")).count() == 0
    assert group_quantiles(df, "v", ["g"], {"median": 0.5}).count() == 0


def test_profiles_without_rows(spark):
    df = spark.createDataFrame([], "v double, w double")
    assert histogram(df, ["v"]).count() == 0 and density(df, "v", 5).count() == 0
    assert rows(describe(df).select("column_name", "count", "mean")) == [("v", 0, None), ("w", 0, None)]
    assert correlation_matrix(df).filter(F.col("w").isNotNull()).count() == 0
    assert rows(run_checks(df, [MetricCheck("rows", ">", 0)])) == [("rows", "fail", 0)]
    assert filter_funnel(df, []).first()["row_count"] == 0


def test_trips_without_rows(spark):
    trips = spark.createDataFrame([], schemas.TRIPS)
    assert trips_by_month(trips).count() == 0
    assert trips_by_temperature(trips, spark.createDataFrame([], schemas.WEATHER)).count() == 0
