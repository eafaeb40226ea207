"""Declarative data-quality checks."""

from __future__ import annotations

import json
import operator
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

COMPARISONS = {
    "<": operator.lt, "<=": operator.le, "=": operator.eq,
    "!=": operator.ne, ">": operator.gt, ">=": operator.ge,
}


@dataclass(frozen=True)
class MetricCheck:
    """``metric comparison threshold``; the metric is a row count or the nulls of a column."""

    name: str
    comparison: str
    threshold: int
    column: str | None = None      # None: row_count, else missing_count(column)

    def __post_init__(self):
        if self.comparison not in COMPARISONS:
            raise ValueError(f"unknown comparison: {self.comparison}")

    def metric(self) -> Column:
        return F.count(F.lit(1)) if self.column is None else F.count_if(F.col(self.column).isNull())


@dataclass(frozen=True)
class SchemaCheck:
    """No change against a stored schema; any change is a warning, not a failure."""

    name: str
    baseline: StructType


def run_checks(df: DataFrame, checks: Sequence[MetricCheck | SchemaCheck]) -> DataFrame:
    """One row per check: name, outcome (pass, fail or warn) and the measured value.

    All metrics of the table are measured in one pass; the value of a schema check is its number
    of changes, which needs no rows.
    """
    def row(name: str, outcome: Column, value: Column) -> Column:
        return F.struct(F.lit(name).alias("check_name"), outcome.alias("outcome"), value.alias("value"))

    metrics, rows = [], []
    for check in checks:
        if isinstance(check, SchemaCheck):
            changes = len(schema_changes(check.baseline, df.schema))
            rows.append(row(check.name, F.lit("warn" if changes else "pass"), F.lit(changes).cast("bigint")))
            continue
        value = F.col(f"m{len(metrics)}")
        metrics.append(check.metric().alias(f"m{len(metrics)}"))
        passed = COMPARISONS[check.comparison](value, F.lit(check.threshold))
        rows.append(row(check.name, F.when(passed, "pass").otherwise("fail"), value))
    measured = df.agg(*metrics) if metrics else df.sparkSession.range(1)
    return measured.select(F.inline(F.array(*rows)))


def save_schema(df: DataFrame, path: str) -> None:
    """Store the schema of a frame as the baseline of later schema checks."""
    df.sparkSession.createDataFrame([(df.schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_schema(spark: SparkSession, path: str) -> StructType:
    return StructType.fromJson(json.loads(spark.read.text(path, wholetext=True).first()[0]))


def schema_changes(before: StructType, now: StructType) -> list[tuple[str, str]]:
    """(column, change) for columns added, removed, of another type or at another position."""
    old = {f.name: (i, f.dataType) for i, f in enumerate(before.fields)}
    new = {f.name: (i, f.dataType) for i, f in enumerate(now.fields)}
    changes = [(c, "removed") for c in old if c not in new]
    changes += [(c, "added") for c in new if c not in old]
    for c in old:
        if c in new:
            if old[c][1] != new[c][1]:
                changes.append((c, "type"))
            if old[c][0] != new[c][0]:
                changes.append((c, "position"))
    return changes


def check_schema(df: DataFrame, baseline: StructType, name: str = "schema") -> DataFrame:
    """The result row of one schema check."""
    return run_checks(df, [SchemaCheck(name, baseline)])
