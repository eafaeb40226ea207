"""Least squares on several predictors, its errors and residuals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import hash_below


def split_by_key(
    df: DataFrame, keys: Sequence[str], train_fraction: float = 0.7, seed: int = 101
) -> tuple[DataFrame, DataFrame]:
    """Training and test rows; a row's side depends only on its key and the seed."""
    in_train = hash_below(keys, seed, train_fraction)
    return df.filter(in_train), df.filter(~in_train)


def fit_least_squares(train: DataFrame, target: str, predictors: Sequence[str]) -> LinearRegressionModel:
    """Ordinary least squares with intercept.

    The normal equations are summed up in one pass; their size is that of the predictors.
    """
    rows = VectorAssembler(inputCols=list(predictors), outputCol="__x").transform(
        train.select(*[F.col(c).cast("double").alias(c) for c in [*predictors, target]])
    )
    return LinearRegression(
        featuresCol="__x", labelCol=target, solver="normal", regParam=0.0
    ).fit(rows)


def coefficients(df: DataFrame, model: LinearRegressionModel, predictors: Sequence[str], digits: int = 2) -> DataFrame:
    """The fitted weight of each predictor and the intercept, rounded."""
    rows = [*zip(predictors, [float(c) for c in model.coefficients]), ("intercept", float(model.intercept))]
    return df.sparkSession.createDataFrame(rows, "term string, coefficient double").select(
        "term", F.round("coefficient", digits).alias("coefficient")
    )


def predicted(model: LinearRegressionModel, predictors: Sequence[str]) -> Column:
    """The fitted line as a plain column expression."""
    value = F.lit(float(model.intercept))
    for c, w in zip(predictors, model.coefficients):
        value = value + F.col(c) * F.lit(float(w))
    return value


def residuals(df: DataFrame, actual: str, prediction: Column, alias: str = "residual") -> DataFrame:
    """Prediction minus actual value."""
    return df.withColumn(alias, prediction - F.col(actual))
