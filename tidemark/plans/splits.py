"""Time-based training and test sets."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import as_bound
from tidemark.operators.skew import skew_join


def study_window(features: DataFrame, start: dt.date, days: int = 22) -> DataFrame:
    """Transactions from midnight of ``start`` to midnight ``days`` later, both included."""
    return features.filter(
        F.col("tx_datetime").between(as_bound(start), as_bound(start + dt.timedelta(days=days)))
    )


def delayed_split(
    tx: DataFrame, start: dt.date, train_days: int = 7, delay_days: int = 7, test_days: int = 7
) -> tuple[DataFrame, DataFrame]:
    """Training rows, and later test rows of customers not yet known as defrauded.

    Training covers ``start`` to ``start + train_days``, both midnights included.  A fraud
    becomes known ``delay_days`` after it happened; from then on the customer is left out of
    the test days.  Each customer's first such test day is found with one aggregate, so the
    test set is one anti join instead of one plan per day.  Customers with very many test rows are
    salted in it (``operators/skew.py``), so no task gets all rows of one customer.
    """
    train, candidates, known = _split_parts(tx, start, train_days, delay_days, test_days)
    test = skew_join(candidates, known, ["customer_id"], "left_anti", F.col("known_from") <= F.col("test_day"))
    return train, test.drop("test_day")


def known_customers(
    tx: DataFrame, start: dt.date, train_days: int = 7, delay_days: int = 7, test_days: int = 7
) -> DataFrame:
    """The pool that ``delayed_split`` leaves out: each customer and the first test day without it, from 0."""
    return _split_parts(tx, start, train_days, delay_days, test_days)[2]


def _split_parts(
    tx: DataFrame, start: dt.date, train_days: int, delay_days: int, test_days: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Training rows, rows of the test days with their number, and the known customers."""
    in_training = F.col("tx_datetime").between(
        as_bound(start), as_bound(start + dt.timedelta(days=train_days))
    )
    train = tx.filter(in_training)
    first_day = train.agg(F.min("tx_time_days")).scalar()
    day_in_study = F.col("tx_time_days") - first_day
    # Frauds of study day train_days + j - 1 are known on test day j; those of training at once.
    test_day_known = F.when(in_training, F.lit(0)).otherwise(day_in_study - (train_days - 1))
    known = (
        tx.filter(F.col("tx_fraud") == 1)
        .withColumn("known_from", test_day_known)
        .filter(F.col("known_from").between(0, test_days - 1))
        .groupBy("customer_id")
        .agg(F.min("known_from").alias("known_from"))
    )
    test_day = day_in_study - (train_days + delay_days)
    candidates = tx.withColumn("test_day", test_day).filter(F.col("test_day").between(0, test_days - 1))
    return train, candidates, known
