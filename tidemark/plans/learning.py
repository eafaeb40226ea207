"""Fraud classifier: training, scoring on the JVM, and vectorised scoring functions on a shipped model file."""

from __future__ import annotations

import json
import posixpath
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import SparkFiles
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.plans.features import INPUT_FEATURES, KEYS


def feature_struct(features: Sequence[str] = INPUT_FEATURES) -> Column:
    """The model inputs of a row; a missing count (no history on the first day) is 0."""
    return F.struct(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features])


def _assembled(df: DataFrame, features: Sequence[str]) -> DataFrame:
    inputs = df.withColumn("__x", feature_struct(features))
    named = inputs.select("*", *[F.col(f"__x.{c}").alias(f"__x_{c}") for c in features])
    vector = VectorAssembler(inputCols=[f"__x_{c}" for c in features], outputCol="__vector")
    return vector.transform(named).drop("__x", *[f"__x_{c}" for c in features])


def fit_forest(
    train: DataFrame, features: Sequence[str] = INPUT_FEATURES, label: str = "tx_fraud",
    trees: int = 100, depth: int = 10, seed: int = 0,
) -> RandomForestClassificationModel:
    forest = RandomForestClassifier(
        featuresCol="__vector", labelCol="__label", numTrees=trees, maxDepth=depth, seed=seed
    )
    rows = _assembled(train, features).select("__vector", F.col(label).cast("double").alias("__label"))
    return forest.fit(rows)


def score_frame(
    model: RandomForestClassificationModel, df: DataFrame, features: Sequence[str] = INPUT_FEATURES,
    alias: str = "score",
) -> DataFrame:
    """The frame with the fraud probability added; runs in the JVM."""
    scored = model.transform(_assembled(df, features))
    return scored.withColumn(alias, vector_to_array("probability")[1]).drop(
        "__vector", "rawPrediction", "probability", "prediction"
    )


def save_forest(model: RandomForestClassificationModel, folder: str) -> str:
    """Save a forest below a shared folder that all later jobs can read; ``folder`` must be new."""
    model.write().save(folder)
    return folder


def load_forest(folder: str) -> RandomForestClassificationModel:
    return RandomForestClassificationModel.load(folder)


def ship_model(spark: SparkSession, path: str) -> str:
    """Hand a model file to every executor; returns the name under which tasks find it."""
    spark.sparkContext.addFile(path)
    return posixpath.basename(path)


@lru_cache(maxsize=8)
def shipped_model(shipped: str) -> dict:
    """A shipped model file, read once in each worker process; only the last few are kept."""
    with open(SparkFiles.get(shipped), encoding="utf-8") as file:
        return json.load(file)


def thresholds_udf(shipped: str):
    """A vectorised function (struct of inputs -> score) on a shipped file of weighted thresholds.

    The file is JSON: ``base`` and a list of ``steps`` (``input``, ``above``, ``weight``); a score is the base
    plus the weights of all steps whose input lies above its threshold.  A worker process reads it once
    and serves all batches of all its tasks from it.
    """

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        model = shipped_model(shipped)
        for batch in batches:
            total = pd.Series(model["base"], index=batch.index, dtype=float)
            for step in model["steps"]:
                total += step["weight"] * (batch[step["input"]] > step["above"])
            yield total

    return score


def logistic_udf(weights: dict[str, float], intercept: float):
    """A vectorised function (struct of inputs -> probability) for fixed logistic weights."""

    @F.pandas_udf("double")
    def probability(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for batch in batches:
            z = intercept + sum(batch[c] * w for c, w in weights.items())
            yield 1.0 / (1.0 + np.exp(-z))

    return probability


def score_with(udf, df: DataFrame, features: Sequence[str] = INPUT_FEATURES, alias: str = "fraud_prob") -> DataFrame:
    """Keys and probability of each row, by a vectorised function."""
    return df.select(*KEYS, udf(feature_struct(features)).alias(alias))


def register_scorer(spark: SparkSession, name: str, udf) -> None:
    """Make a scoring function callable from SQL text in this session."""
    spark.udf.register(name, udf)
