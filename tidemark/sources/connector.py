"""Reads from an external store that runs the query itself."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def connector_options(
    options: Mapping[str, str],
    query: str,
    *,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int | None = None,
) -> dict[str, str]:
    """Reader options that hand ``query`` to the source.

    Without a partition column the source answers over one connection.  With one, the query
    becomes a sub-select that is read in ``partitions`` ranges of that column at once; bounds
    only shape the ranges, rows outside them are still read.
    """
    out = dict(options)
    if partition_column is None:
        out["query"] = query
        return out
    if bounds is None or partitions is None:
        raise ValueError("a partitioned read needs bounds and a number of partitions")
    out.update(
        dbtable=f"({query}) pushed",
        partitionColumn=partition_column,
        lowerBound=str(bounds[0]),
        upperBound=str(bounds[1]),
        numPartitions=str(partitions),
    )
    return out


def read_query(
    spark: SparkSession, source: str, options: Mapping[str, str], query: str, **ranges
) -> DataFrame:
    """Rows of a query that the source evaluates (``source`` is any registered format)."""
    return spark.read.format(source).options(**connector_options(options, query, **ranges)).load()


def copy_query(
    spark: SparkSession, source: str, options: Mapping[str, str], query: str, target: str, **ranges
) -> DataFrame:
    """Copy the result of a pushed query into a table and return that table."""
    read_query(spark, source, options, query, **ranges).write.mode("overwrite").saveAsTable(target)
    return spark.table(target)
