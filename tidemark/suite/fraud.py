"""Fraud jobs: shares, daily windows, the feature table, splits, scores and their quality."""

from __future__ import annotations

import datetime as dt
import posixpath
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import calendar_days, from_units, ratio_to_report
from tidemark.operators.distinct import count_ids, id_parts
from tidemark.operators.joins import calendar_spine
from tidemark.operators.materialise import cut_lineage, shared_folder
from tidemark.operators.profile import correlation_matrix, describe
from tidemark.operators.topk import top_k, top_k_per_group
from tidemark.plans import features as feat
from tidemark.plans.learning import (
    feature_struct, fit_forest, load_forest, logistic_udf, register_scorer, save_forest, score_frame, score_with, ship_model,
    thresholds_udf,
)
from tidemark.plans.metrics import card_precision, performance_table, ranking_metrics
from tidemark.plans.splits import delayed_split, known_customers, study_window
from tidemark.plans.trees import ensemble_sql, load_ensemble, score_by_trees
from tidemark.sources.samples import SampleTables
from tidemark.suite.base import query
from tidemark.suite.sqltext import CUST_DAY, DAYS, TX, days, features, split_by_loop, term_day

CENTS = 100
START = dt.date(2024, 1, 8)
START_SQL = "2024-01-08 00:00:00"
K = 20
SCORE_SQL = "floor(CAST(tx_amount AS DOUBLE) / 5) / 100.0"


def _score() -> Column:
    """A fixed score with many ties, so that its quality can be checked exactly."""
    return F.floor(F.col("tx_amount") / 5) / 100.0


def _features(t: SampleTables, **options) -> DataFrame:
    return feat.feature_table(t.transactions(), per_one=CENTS, **options)


@query("transactions", f"WITH {TX} SELECT * EXCLUDE (tx_amount), CAST(tx_amount AS DOUBLE) AS tx_amount FROM tx")
def transactions(t: SampleTables) -> DataFrame:
    return feat.with_time_flags(t.transactions())


@query(
    "fraud_share",
    f"""WITH {TX}, g AS (SELECT tx_fraud, COUNT(transaction_id) AS nb_tx_day FROM tx GROUP BY tx_fraud)
    SELECT tx_fraud, nb_tx_day, CAST(nb_tx_day AS DOUBLE) / SUM(nb_tx_day) OVER () * 100 AS percentage FROM g""",
)
def fraud_share(t: SampleTables) -> DataFrame:
    counts = t.transactions().groupBy("tx_fraud").agg(F.count("transaction_id").alias("nb_tx_day"))
    return ratio_to_report(counts, "nb_tx_day", alias="percentage", scale=100)


@query(
    "fraud_share_by_period",
    f"""WITH {TX}, g AS (SELECT tx_during_weekend, tx_during_night, tx_fraud, COUNT(*) AS n FROM tx GROUP BY ALL)
    SELECT tx_during_weekend, tx_during_night, tx_fraud, n AS nb_tx,
           CAST(n AS DOUBLE) / SUM(n) OVER (PARTITION BY tx_during_weekend, tx_during_night) * 100 AS percentage
    FROM g ORDER BY ALL""",
)
def fraud_share_by_period(t: SampleTables) -> DataFrame:
    period = ["tx_during_weekend", "tx_during_night"]
    counts = feat.with_time_flags(t.transactions()).groupBy(*period, "tx_fraud").agg(
        F.count(F.lit(1)).alias("nb_tx")
    )
    return ratio_to_report(counts, "nb_tx", period, "percentage", 100).orderBy(*period, "tx_fraud")


@query(
    "frauds_by_day",
    f"""WITH {TX} SELECT CAST(tx_datetime AS DATE) AS tx_date, CAST(SUM(tx_fraud) AS BIGINT) AS nbr_fraud_trx,
           COUNT(DISTINCT customer_id) AS nbr_fraud_card
    FROM tx WHERE tx_fraud = 1 GROUP BY 1 ORDER BY 1""",
)
def frauds_by_day(t: SampleTables) -> DataFrame:
    return (
        t.transactions().filter(F.col("tx_fraud") == 1)
        .groupBy(F.to_date("tx_datetime").alias("tx_date"))
        .agg(F.sum("tx_fraud").alias("nbr_fraud_trx"), F.countDistinct("customer_id").alias("nbr_fraud_card"))
        .orderBy("tx_date")
    )


_FRAUD_PARTS_SQL = f"""WITH {TX} SELECT CAST(date_trunc('{{unit}}', tx_datetime) AS DATE) AS {{unit}}, CAST(SUM(tx_fraud) AS BIGINT) AS nbr_fraud_trx,
    COUNT(DISTINCT customer_id) AS nbr_fraud_card FROM tx WHERE tx_fraud = 1 GROUP BY 1"""


def _frauds_from_days(t: SampleTables, unit: str) -> DataFrame:
    """Frauds and fraud cards of longer periods, from stored days: counts and bitmaps of cards."""
    frauds = t.transactions().filter(F.col("tx_fraud") == 1).withColumn("tx_date", F.to_date("tx_datetime"))
    counts = cut_lineage(frauds.groupBy("tx_date").agg(F.sum("tx_fraud").alias("n")))
    cards = cut_lineage(id_parts(frauds, ["tx_date"], "customer_id"))
    period = F.to_date(F.date_trunc(unit, "tx_date")).alias(unit)
    return counts.groupBy(period).agg(F.sum("n").alias("nbr_fraud_trx")).join(count_ids(cards, [period], "nbr_fraud_card"), unit)


@query("frauds_by_week_from_days", _FRAUD_PARTS_SQL.format(unit="week"))
def frauds_by_week_from_days(t: SampleTables) -> DataFrame:
    return _frauds_from_days(t, "week")


@query("frauds_by_month_from_days", _FRAUD_PARTS_SQL.format(unit="month"))
def frauds_by_month_from_days(t: SampleTables) -> DataFrame:
    return _frauds_from_days(t, "month")


@query(
    "transaction_period",
    f"""WITH {TX} SELECT min(tx_datetime) AS end_date,
           CAST(date_diff('day', CAST(min(tx_datetime) AS DATE), CAST(max(tx_datetime) AS DATE)) AS INTEGER) AS no_days FROM tx""",
)
def transaction_period(t: SampleTables) -> DataFrame:
    # The second expression refers to the first by its alias.
    return t.transactions().agg(
        F.min("tx_datetime").alias("end_date"), F.max("tx_datetime").alias("last_date")
    ).select("end_date", calendar_days("end_date", "last_date").alias("no_days"))


@query("calendar_days", f"WITH {TX}, {DAYS} SELECT tx_date FROM days")
def calendar(t: SampleTables) -> DataFrame:
    tx = t.transactions()
    return calendar_spine(t.spark.range(1), tx, "tx_datetime").select("tx_date")


@query(
    "customer_calendar",
    f"WITH {TX}, {DAYS} SELECT customer_id, tx_date FROM days CROSS JOIN (SELECT DISTINCT customer_id FROM tx)",
)
def customer_calendar(t: SampleTables) -> DataFrame:
    tx = t.transactions()
    return calendar_spine(tx.select("customer_id").distinct(), tx, "tx_datetime")


@query("calendar_days_without_last", f"WITH {TX}, {days(last_day=False)} SELECT tx_date FROM days")
def calendar_without_last(t: SampleTables) -> DataFrame:
    return calendar_spine(t.spark.range(1), t.transactions(), "tx_datetime", include_last_day=False).select("tx_date")


@query(
    "customer_daily_totals",
    f"""WITH {TX}, {DAYS}, {CUST_DAY}
    SELECT customer_id, tx_date, CAST(tot_amount AS DOUBLE) AS tot_amount, no_trx FROM cust_daily""",
)
def customer_daily_totals(t: SampleTables) -> DataFrame:
    daily = feat.dense_customer_daily(t.transactions(), per_one=CENTS)
    return daily.withColumn("tot_amount", from_units(F.col("tot_amount"), CENTS))


@query(
    "customer_daily_windows",
    f"""WITH {TX}, {DAYS}, {CUST_DAY}
    SELECT customer_id, tx_date, no_trx, CAST(tot_amount AS DOUBLE) AS tot_amount,
           cust_tx_prev_1, cust_tx_prev_7, cust_tx_prev_30,
           CAST(cust_tot_amt_prev_1 AS DOUBLE) AS cust_tot_amt_prev_1,
           CAST(cust_tot_amt_prev_7 AS DOUBLE) AS cust_tot_amt_prev_7,
           CAST(cust_tot_amt_prev_30 AS DOUBLE) AS cust_tot_amt_prev_30
    FROM cust_feat""",
)
def customer_daily_windows(t: SampleTables) -> DataFrame:
    windows = feat.customer_day_windows(feat.dense_customer_daily(t.transactions(), per_one=CENTS))
    amounts = ["tot_amount", *[f"cust_tot_amt_prev_{w}" for w in feat.WINDOWS]]
    return windows.withColumns({c: from_units(F.col(c), CENTS) for c in amounts})


@query("terminal_daily_windows", f"WITH {TX}, {DAYS}, {term_day(False)} SELECT * FROM term_feat")
def terminal_daily_windows(t: SampleTables) -> DataFrame:
    return feat.terminal_day_windows(feat.dense_terminal_daily(t.transactions()))


@query("terminal_daily_windows_literal", f"WITH {TX}, {DAYS}, {term_day(True)} SELECT * FROM term_feat")
def terminal_daily_windows_literal(t: SampleTables) -> DataFrame:
    return feat.terminal_day_windows(feat.dense_terminal_daily(t.transactions()), literal_reference=True)


@query(
    "running_day_totals",
    f"""WITH {TX} SELECT transaction_id,
           COUNT(customer_id) OVER w AS cur_day_trx, CAST(SUM(tx_amount) OVER w AS DOUBLE) AS cur_day_amt
    FROM tx WINDOW w AS (PARTITION BY customer_id, CAST(tx_datetime AS DATE) ORDER BY tx_datetime
                         RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def running_day_totals(t: SampleTables) -> DataFrame:
    return feat.with_day_so_far(t.transactions(), per_one=CENTS).select(
        "transaction_id", "cur_day_trx", from_units(F.col("cur_day_amt"), CENTS).alias("cur_day_amt")
    )


@query("feature_table", f"WITH {features(False)} SELECT * FROM features")
def feature_table(t: SampleTables) -> DataFrame:
    return _features(t)


@query("feature_table_without_last_day", f"WITH {features(False, last_day=False)} SELECT * FROM features")
def feature_table_without_last_day(t: SampleTables) -> DataFrame:
    return _features(t, include_last_day=False)


@query("feature_table_literal", f"WITH {features(True)} SELECT * FROM features")
def feature_table_literal(t: SampleTables) -> DataFrame:
    return _features(t, literal_reference=True)


@query(
    "study_window",
    f"""WITH {TX} SELECT transaction_id, tx_datetime FROM tx
    WHERE tx_datetime <= TIMESTAMP '{START_SQL}' + INTERVAL 22 DAY AND tx_datetime >= TIMESTAMP '{START_SQL}'""",
)
def study(t: SampleTables) -> DataFrame:
    return study_window(t.transactions(), START).select("transaction_id", "tx_datetime")


def _split(t: SampleTables, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    return delayed_split(study_window(rows, START), START)


@query("split_train", f"WITH {features(False)}, {split_by_loop('features', START_SQL)} SELECT * FROM train")
def split_train(t: SampleTables) -> DataFrame:
    return _split(t, _features(t))[0]


@query("split_test", f"WITH {features(False)}, {split_by_loop('features', START_SQL)} SELECT * FROM test")
def split_test(t: SampleTables) -> DataFrame:
    return _split(t, cut_lineage(study_window(_features(t), START)))[1]


@query(
    "split_summary",
    f"""WITH {TX}, {split_by_loop('tx', START_SQL)},
    u AS (SELECT 'train' AS part, tx_fraud FROM train UNION ALL SELECT 'test', tx_fraud FROM test)
    SELECT part, COUNT(*) AS row_count, CAST(SUM(tx_fraud) AS BIGINT) AS frauds, avg(tx_fraud) AS fraud_share
    FROM u GROUP BY part""",
)
def split_summary(t: SampleTables) -> DataFrame:
    train, test = _split(t, t.transactions())
    both = train.select(F.lit("train").alias("part"), "tx_fraud").union(
        test.select(F.lit("test").alias("part"), "tx_fraud")
    )
    return both.groupBy("part").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("tx_fraud").alias("frauds"), F.avg("tx_fraud").alias("fraud_share")
    )


@query(
    "known_defrauded_customers",
    f"""WITH {TX}, {split_by_loop('tx', START_SQL)} SELECT DISTINCT customer_id FROM known_6""",
)
def known_defrauded_customers(t: SampleTables) -> DataFrame:
    return known_customers(study_window(t.transactions(), START), START).select("customer_id")


_CORR = [*feat.INPUT_FEATURES, "tx_fraud"]
_CORR_SQL = " UNION ALL ".join(
    "SELECT '{}' AS column_name, {} FROM study".format(
        a, ", ".join(f"round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS {b}" for b in _CORR)
    )
    for a in _CORR
)


@query(
    "feature_correlations",
    f"WITH {features(False)}, {split_by_loop('features', START_SQL)} {_CORR_SQL}",
)
def feature_correlations(t: SampleTables) -> DataFrame:
    rows = study_window(_features(t), START)
    square = correlation_matrix(rows, _CORR)
    return square.select("column_name", *[F.round(c, 6).alias(c) for c in _CORR])


@query(
    "feature_statistics",
    f"WITH {features(False)}, {split_by_loop('features', START_SQL)} " + " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, COUNT({c}) AS count, round(avg(CAST({c} AS DOUBLE)), 6) AS mean,
        round(stddev_samp(CAST({c} AS DOUBLE)), 6) AS stddev, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM study"""
        for c in _CORR
    ),
)
def feature_statistics(t: SampleTables) -> DataFrame:
    rows = study_window(_features(t), START)
    return describe(rows, _CORR).withColumns({c: F.round(c, 6) for c in ("mean", "stddev")})


@query(
    "top_cards_by_day",
    f"""WITH {TX}, c AS (SELECT tx_time_days, customer_id, max({SCORE_SQL}) AS score, max(tx_fraud) AS tx_fraud
                        FROM tx GROUP BY tx_time_days, customer_id)
    SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY tx_time_days ORDER BY score DESC, customer_id) AS INTEGER) AS rank FROM c)
    WHERE rank <= {K}""",
)
def top_cards_by_day(t: SampleTables) -> DataFrame:
    cards = t.transactions().groupBy("tx_time_days", "customer_id").agg(
        F.max(_score()).alias("score"), F.max("tx_fraud").alias("tx_fraud")
    )
    return top_k_per_group(cards, ["tx_time_days"], [F.desc("score"), F.asc("customer_id")], K, ["customer_id"])


@query(
    "top_transactions",
    f"""WITH {TX} SELECT transaction_id, customer_id, {SCORE_SQL} AS score FROM tx
    ORDER BY score DESC, transaction_id LIMIT 100""",
)
def top_transactions(t: SampleTables) -> DataFrame:
    scored = t.transactions().select("transaction_id", "customer_id", _score().alias("score"))
    return top_k(scored, [F.desc("score"), F.asc("transaction_id")], 100)


@query(
    "ranking_metrics",
    f"""WITH {TX}, s AS (SELECT {SCORE_SQL} AS score, tx_fraud FROM tx),
    g AS (SELECT score, SUM(tx_fraud) AS pos, COUNT(*) - SUM(tx_fraud) AS neg FROM s GROUP BY score),
    c AS (SELECT *, SUM(pos) OVER (ORDER BY score DESC) AS tp, SUM(neg) OVER (ORDER BY score DESC) AS fp,
                 COALESCE(SUM(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
                 SUM(pos) OVER () AS p, SUM(neg) OVER () AS n FROM g)
    SELECT round(SUM(CAST(pos AS DOUBLE) * (below + neg / 2.0)) / (max(CAST(p AS DOUBLE)) * max(n)), 9) AS auc_roc,
           round(SUM(CAST(pos AS DOUBLE) / p * tp / (tp + fp)), 9) AS average_precision,
           CAST(max(p) AS BIGINT) AS positives, CAST(max(n) AS BIGINT) AS negatives
    FROM c""",
)
def ranking(t: SampleTables) -> DataFrame:
    out = ranking_metrics(t.transactions().select("tx_fraud", _score().alias("score")))
    return out.withColumns({c: F.round(c, 9) for c in ("auc_roc", "average_precision")})


@query(
    "constant_score_metrics",
    f"""WITH {TX}, {split_by_loop('tx', START_SQL)}
    SELECT 0.5::DOUBLE AS auc_roc, round(avg(tx_fraud), 9) AS average_precision,
           CAST(SUM(tx_fraud) AS BIGINT) AS positives, CAST(COUNT(*) - SUM(tx_fraud) AS BIGINT) AS negatives FROM test""",
)
def constant_score_metrics(t: SampleTables) -> DataFrame:
    _, test = _split(t, t.transactions())
    out = ranking_metrics(test.select("tx_fraud", F.lit(0.5).alias("score")))
    return out.withColumns({c: F.round(c, 9) for c in ("auc_roc", "average_precision")})


def _card_loop(days: int, k: int, score: str = SCORE_SQL, source: str = "test") -> str:
    """Day after day: leave out cards found before, take the k best, note the frauds among them."""
    parts = [
        f"""cards AS (SELECT tx_time_days, customer_id, max({score}) AS score, max(tx_fraud) AS label
          FROM {source} GROUP BY tx_time_days, customer_id)"""
    ]
    found = "SELECT CAST(NULL AS BIGINT) AS customer_id WHERE false"
    for day in range(days):
        parts.append(f"left_{day} AS (SELECT * FROM cards, first_day WHERE tx_time_days = d + {14 + day} AND customer_id NOT IN ({found}))")
        parts.append(f"hit_{day} AS (SELECT customer_id FROM (SELECT * FROM left_{day} ORDER BY score DESC, customer_id LIMIT {k}) WHERE label = 1)")
        parts.append(f"found_{day} AS ({found} UNION ALL SELECT customer_id FROM hit_{day})")
        found = f"SELECT customer_id FROM found_{day}"
    return ",\n".join(parts)


_CARD_DAYS = " UNION ALL ".join(
    f"""SELECT d + {14 + day} AS tx_time_days, (SELECT COUNT(*) FROM left_{day} WHERE label = 1) AS frauded_cards,
       (SELECT COUNT(*) FROM hit_{day}) AS hits, (SELECT COUNT(*) FROM hit_{day}) / {K}.0::DOUBLE AS card_precision FROM first_day"""
    for day in range(7)
)


@query(
    "card_precision_by_day",
    f"WITH {TX}, {split_by_loop('tx', START_SQL)}, {_card_loop(7, K)} {_CARD_DAYS}",
)
def card_precision_by_day(t: SampleTables) -> DataFrame:
    _, test = _split(t, t.transactions())
    return card_precision(test.withColumn("score", _score()), K)


@query(
    "detected_card_maxima",
    f"""WITH {TX} SELECT customer_id, CAST(max(tx_amount) AS DOUBLE) AS tx_amount, max(tx_fraud) AS tx_fraud,
           max(tx_datetime) AS tx_datetime FROM tx GROUP BY customer_id""",
)
def detected_card_maxima(t: SampleTables) -> DataFrame:
    return t.transactions().groupBy("customer_id").agg(
        F.max("tx_amount").alias("tx_amount"), F.max("tx_fraud").alias("tx_fraud"),
        F.max("tx_datetime").alias("tx_datetime"),
    )


_WEIGHTS = {"tx_amount": 0.01, "tx_during_weekend": -0.3, "tx_during_night": 0.7}


@query(
    "logistic_scores",
    f"""WITH {TX} SELECT transaction_id, tx_datetime, customer_id, terminal_id,
           round(1 / (1 + exp(-(-3.0 + 0.01 * CAST(tx_amount AS DOUBLE) - 0.3 * tx_during_weekend + 0.7 * tx_during_night))), 9) AS fraud_prob
    FROM tx WHERE tx_datetime > TIMESTAMP '2024-01-20 00:00:00'""",
)
def logistic_scores(t: SampleTables) -> DataFrame:
    recent = feat.with_time_flags(t.transactions()).filter(
        F.col("tx_datetime") > F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    )
    scored = score_with(logistic_udf(_WEIGHTS, -3.0), recent, list(_WEIGHTS))
    return scored.withColumn("fraud_prob", F.round("fraud_prob", 9))


def _fitted(t: SampleTables, trees: int, depth: int):
    table = cut_lineage(_features(t))      # read many times by the training
    train, test = _split(t, table)
    return fit_forest(train, trees=trees, depth=depth), table, test


@query("forest_scores")
def forest_scores(t: SampleTables) -> DataFrame:
    model, _, test = _fitted(t, 100, 8)
    return score_frame(model, test).select(*feat.KEYS, "tx_fraud", "score")


@query("forest_performance")
def forest_performance(t: SampleTables) -> DataFrame:
    model, _, test = _fitted(t, 100, 8)
    scored = score_frame(model, test).select("customer_id", "tx_time_days", "tx_fraud", "score")
    return performance_table(cut_lineage(scored), top_k=(K, 100))


ENSEMBLE = load_ensemble(str(Path(__file__).with_name("tree_ensemble.json")))
_SCORED_SQL = f"""{features(False)}, {split_by_loop('features', START_SQL)},
    scored AS (SELECT transaction_id, tx_datetime, customer_id, terminal_id, tx_time_days, tx_fraud, {ensemble_sql(ENSEMBLE)} AS score FROM test)"""


def _ensemble_test(t: SampleTables) -> DataFrame:
    """Test rows of the delayed split with the score of the fixed ensemble."""
    _, test = _split(t, cut_lineage(study_window(_features(t), START)))
    return score_by_trees(test, ENSEMBLE)


@query(
    "ensemble_scores",
    f"WITH {_SCORED_SQL} SELECT transaction_id, tx_datetime, customer_id, terminal_id, tx_fraud, round(score, 9) AS score FROM scored",
)
def ensemble_scores(t: SampleTables) -> DataFrame:
    return _ensemble_test(t).select(*feat.KEYS, "tx_fraud", F.round("score", 9).alias("score"))


@query(
    "ensemble_performance",
    f"""WITH {_SCORED_SQL}, {_card_loop(7, K, "score", "scored")},
    g AS (SELECT score, SUM(tx_fraud) AS pos, COUNT(*) - SUM(tx_fraud) AS neg FROM scored GROUP BY score),
    c AS (SELECT *, SUM(pos) OVER (ORDER BY score DESC) AS tp, SUM(neg) OVER (ORDER BY score DESC) AS fp,
                 COALESCE(SUM(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
                 SUM(pos) OVER () AS p, SUM(neg) OVER () AS n FROM g)
    SELECT round(SUM(CAST(pos AS DOUBLE) * (below + neg / 2.0)) / (max(CAST(p AS DOUBLE)) * max(n)), 3) AS auc_roc,
           round(SUM(CAST(pos AS DOUBLE) / p * tp / (tp + fp)), 3) AS average_precision,
           (SELECT round(avg(card_precision), 3) FROM ({_CARD_DAYS})) AS card_precision_{K}
    FROM c""",
)
def ensemble_performance(t: SampleTables) -> DataFrame:
    scored = _ensemble_test(t).select("customer_id", "tx_time_days", "tx_fraud", "score")
    return performance_table(cut_lineage(scored), top_k=(K,))


_RECENT_SQL = "tx_datetime > TIMESTAMP '2024-01-20 00:00:00'"


def _recent(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("tx_datetime") > F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"))


def _reloaded(t: SampleTables) -> DataFrame:
    """Recent transactions scored by a forest that was saved and loaded again."""
    model, table, _ = _fitted(t, 20, 6)
    folder = save_forest(model, posixpath.join(shared_folder(t.spark), f"forest-{uuid.uuid4().hex}"))
    return score_frame(load_forest(folder), _recent(table), alias="fraud_prob")


@query("forest_batch_scores")
def forest_batch_scores(t: SampleTables) -> DataFrame:
    return _reloaded(t).select(*feat.KEYS, "fraud_prob")


@query("forest_sql_scores")
def forest_sql_scores(t: SampleTables) -> DataFrame:
    _reloaded(t).createOrReplaceTempView("tidemark_recent")
    return t.spark.sql(
        "SELECT transaction_id, tx_datetime, customer_id, terminal_id, tx_amount, fraud_prob FROM tidemark_recent"
    )


@query(
    "forest_facts",
    f"""WITH {features(False)}, {split_by_loop('features', START_SQL)}
    SELECT COUNT(*) AS scored_rows, 0::BIGINT AS outside, true AS beats_constant FROM test""",
)
def forest_facts(t: SampleTables) -> DataFrame:
    """What any forest must show: every test row scored, scores in [0, 1], better than a constant score."""
    model, _, test = _fitted(t, 100, 8)
    scored = cut_lineage(score_frame(model, test).select("tx_fraud", "score"))
    counts = scored.agg(
        F.count(F.lit(1)).alias("scored_rows"),
        F.count_if(F.col("score").isNull() | ~F.col("score").between(0, 1)).alias("outside"),
    )
    share = F.col("positives") / (F.col("positives") + F.col("negatives"))
    better = (F.col("auc_roc") > 0.5) & (F.col("average_precision") > share)
    return counts.withColumn("beats_constant", ranking_metrics(scored).select(better).scalar())


MODEL_FILE = str(Path(__file__).with_name("threshold_model.json"))
_STEPS_SQL = """round(CAST(0.05 + CASE WHEN tx_amount > 100 THEN 0.4 ELSE 0 END + CASE WHEN tx_amount > 400 THEN 0.25 ELSE 0 END
    + CASE WHEN tx_during_night > 0 THEN 0.2 ELSE 0 END + CASE WHEN tx_during_weekend > 0 THEN 0.1 ELSE 0 END AS DOUBLE), 9)"""


@query(
    "shipped_model_scores",
    f"""WITH {TX} SELECT transaction_id, tx_datetime, customer_id, terminal_id, {_STEPS_SQL} AS fraud_prob
    FROM tx WHERE {_RECENT_SQL}""",
)
def shipped_model_scores(t: SampleTables) -> DataFrame:
    udf = thresholds_udf(ship_model(t.spark, MODEL_FILE))
    scored = score_with(udf, _recent(feat.with_time_flags(t.transactions())), list(_WEIGHTS))
    return scored.withColumn("fraud_prob", F.round("fraud_prob", 9))


@query(
    "shipped_model_sql_scores",
    f"""WITH {TX} SELECT CAST(tx_datetime AS DATE) AS tx_date, COUNT(*) AS alerts FROM tx
    WHERE {_STEPS_SQL} > 0.5 GROUP BY 1""",
)
def shipped_model_sql_scores(t: SampleTables) -> DataFrame:
    name = f"threshold_score_{uuid.uuid4().hex}"
    register_scorer(t.spark, name, thresholds_udf(ship_model(t.spark, MODEL_FILE)))
    rows = feat.with_time_flags(t.transactions()).withColumn("inputs", feature_struct(list(_WEIGHTS)))
    return t.spark.sql(
        f"SELECT CAST(tx_datetime AS DATE) AS tx_date, COUNT(*) AS alerts FROM {{rows}} "
        f"WHERE round({name}(inputs), 9) > 0.5 GROUP BY 1",
        rows=rows,
    )
