"""Models against their definition, and the incremental rollup against a batch count."""

import datetime as dt
import random

import duckdb
import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import materialise as mat
from tidemark.plans import learning, regression as reg, trees
from tidemark.plans.features import INPUT_FEATURES, feature_table
from tidemark.plans.metrics import ranking_metrics
from tidemark.plans.splits import delayed_split, study_window
from tidemark.plans.trips import daily_rollup
from tidemark.sources.samples import SampleTables
from tidemark.streaming import refresh


@pytest.fixture(scope="module")
def fitted(spark):
    table = feature_table(SampleTables(spark, "/root/testdata/sf0.01").transactions(), per_one=100).cache()
    train, test = delayed_split(study_window(table, dt.date(2024, 1, 8)), dt.date(2024, 1, 8))
    return learning.fit_forest(train, trees=30, depth=6), table, test


def test_forest_beats_the_baseline(fitted):
    model, _, test = fitted
    got = ranking_metrics(learning.score_frame(model, test)).first()
    assert got["auc_roc"] > 0.6
    assert got["average_precision"] > got["positives"] / (got["positives"] + got["negatives"])


def test_loaded_forest_equals_the_model(fitted, tmp_path):
    model, table, _ = fitted
    loaded = learning.load_forest(learning.save_forest(model, str(tmp_path / "forest")))
    columns = ["transaction_id", "score"]
    assert rows(learning.score_frame(loaded, table).select(columns)) == rows(learning.score_frame(model, table).select(columns))


def test_compiled_forest_equals_the_model(spark, fitted, tmp_path):
    """The trained forest as column expressions, against the library that trained it."""
    model, table, _ = fitted
    ensemble = trees.forest_ensemble(spark, learning.save_forest(model, str(tmp_path / "forest")), INPUT_FEATURES)
    assert len(ensemble["trees"]) == 30 and set(trees.inputs_of(ensemble)) <= set(INPUT_FEATURES)
    part = table.filter("transaction_id % 7 = 0")
    both = trees.score_by_trees(learning.score_frame(model, part), ensemble, "compiled")
    assert both.count() > 1000 and both.filter(~(F.abs(F.col("score") - F.col("compiled")) < 1e-12)).count() == 0


def test_compiled_trees_by_hand(spark):
    ensemble = {"trees": [
        {"input": "a", "most": 1.5, "low": {"score": 0.25}, "high": {"input": "b", "most": 0, "low": {"score": 1}, "high": {"score": 0}}},
        {"score": 0.5},
    ]}
    df = spark.createDataFrame([(1, 1.5, 7), (2, 1.6, 0), (3, 2.0, 1), (4, None, None), (5, 9.0, None)], "i int, a double, b int")
    want = [(1, 0.375), (2, 0.75), (3, 0.25), (4, 0.375), (5, 0.75)]
    assert rows(trees.score_by_trees(df, ensemble).select("i", "score")) == want
    assert rows(df.select("i", trees.ensemble_score(ensemble))) == want
    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT * FROM (VALUES (1, 1.5, 7), (2, 1.6, 0), (3, 2.0, 1), (4, NULL, NULL), (5, 9.0, NULL)) v(i, a, b)")
    assert con.execute(f"SELECT i, {trees.ensemble_sql(ensemble)} FROM t ORDER BY i").fetchall() == want


def test_shipped_thresholds_by_frame_and_by_sql(spark, tmp_path):
    path = tmp_path / "steps-test.json"
    path.write_text('{"base": 0.25, "steps": [{"input": "a", "above": 1, "weight": 0.5}, {"input": "b", "above": 0, "weight": 0.125}]}')
    udf = learning.thresholds_udf(learning.ship_model(spark, str(path)))
    df = spark.createDataFrame([(1, 1.0, 0), (2, 2.0, 1), (3, None, None)], "i int, a double, b int")
    inputs = df.withColumn("inputs", learning.feature_struct(["a", "b"]))
    want = [(1, 0.25), (2, 0.875), (3, 0.25)]
    assert rows(inputs.select("i", udf("inputs"))) == want
    learning.register_scorer(spark, "steps_test", udf)
    assert rows(spark.sql("SELECT i, steps_test(inputs) FROM {df}", df=inputs)) == want
    assert inputs.limit(0).select(udf("inputs")).collect() == []


def test_saved_features_snapshot_split_and_score(spark):
    """The whole way: store features by time, freeze the study window, split, train, score."""
    features = feature_table(SampleTables(spark, "/root/testdata/sf0.01").transactions(), per_one=100)
    mat.write_sorted(features, "trx_features", "tx_datetime", files=4)
    start = dt.date(2024, 1, 8)
    name, frozen = mat.snapshot(spark, "trx_features", dt.datetime(2024, 2, 1), where=F.col("tx_datetime") >= "2024-01-08")
    mat.drop_table(spark, "trx_features")
    train, test = delayed_split(study_window(frozen, start), start)
    model = learning.fit_forest(train, trees=5, depth=4)
    scored = learning.score_frame(model, test)
    assert scored.count() == test.count() > 0
    assert scored.filter(~F.col("score").between(0, 1)).count() == 0
    mat.drop_table(spark, name)


def test_least_squares_equals_numpy(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 4)) * [1, 5, 0.1, 100]
    y = x @ [2.0, -1.0, 30.0, 0.25] + 7 + rng.normal(size=300)
    names = ["a", "b", "c", "d"]
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], ", ".join(f"{n} double" for n in [*names, "y"]))
    model = reg.fit_least_squares(df, "y", names)
    want = np.linalg.lstsq(np.column_stack([x, np.ones(300)]), y, rcond=None)[0]
    assert [*model.coefficients, model.intercept] == pytest.approx(want)
    got = {r["term"]: r["coefficient"] for r in reg.coefficients(df, model, names).collect()}
    assert got["c"] == pytest.approx(round(want[2], 2)) and got["intercept"] == pytest.approx(round(want[4], 2))
    residual = reg.residuals(df, "y", reg.predicted(model, names)).agg(F.avg("residual")).first()[0]
    assert residual == pytest.approx(0, abs=1e-9)


def test_split_parts_are_disjoint_and_whole(spark):
    df = spark.range(500)
    train, test = reg.split_by_key(df, ["id"])
    assert train.union(test).distinct().count() == 500 and train.intersect(test).count() == 0


def test_incremental_rollup_equals_the_batch_rollup(spark, tmp_path):
    rng = random.Random(8)
    arrivals, schema = str(tmp_path / "arrivals"), "starttime timestamp_ntz, bikeid bigint"
    rollup, progress = str(tmp_path / "rollup"), str(tmp_path / "progress")

    def arrive(n):
        data = [(dt.datetime(2024, 1, 1) + dt.timedelta(hours=rng.randrange(24 * 20)), i) for i in range(n)]
        spark.createDataFrame(data, schema).repartition(3).write.mode("append").parquet(arrivals)

    for n in (50, 80, 1):
        arrive(n)
        refresh.refresh_daily_rollup(spark, arrivals, schema, rollup, progress, max_files=2)
        batch = daily_rollup(spark.read.parquet(arrivals))
        assert rows(refresh.read_rollup(spark, rollup)) == rows(batch.select("starttime", "trip_count"))
    before = rows(refresh.read_rollup(spark, rollup))
    refresh.refresh_daily_rollup(spark, arrivals, schema, rollup, progress)
    assert rows(refresh.read_rollup(spark, rollup)) == before
    assert rows(refresh.compact_rollup(spark, rollup, str(tmp_path / "compact"))) == before
