"""Unions."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def union_distinct(*frames: DataFrame) -> DataFrame:
    """Union by position without duplicate rows.

    Each input is made distinct within its own tasks by the partial aggregate before anything
    is shuffled.
    """
    return reduce(DataFrame.union, frames).distinct()


def union_relations(relations: Mapping[str, DataFrame], source: str | None = "source_relation") -> DataFrame:
    """Union by column name, duplicates kept, missing columns null, with the relation's name."""
    named = [
        df.withColumn(source, F.lit(name)) if source else df for name, df in relations.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)
