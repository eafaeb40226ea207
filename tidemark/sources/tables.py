"""Catalog tables, literal rows and SQL text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def table(spark: SparkSession, name: str) -> DataFrame:
    """A lazy scan of a named table or view."""
    return spark.table(name)


def run_sql(spark: SparkSession, text: str, args: Sequence | dict | None = None) -> DataFrame:
    """SQL text to a frame; ``?`` and ``:name`` markers are bound, never pasted in."""
    return spark.sql(text, args=args)


def rows_frame(spark: SparkSession, rows: Sequence, schema: StructType | Sequence[str] | str) -> DataFrame:
    """In-memory rows to a frame, with a full schema or with column names only."""
    return spark.createDataFrame(rows, schema)


def create_table(
    spark: SparkSession, name: str, schema: StructType | str, *, replace: bool = False,
    temporary: bool = False, path: str | None = None,
) -> None:
    """Define an empty typed table; ``replace`` drops what is there, ``temporary`` makes a view."""
    if temporary:
        spark.createDataFrame([], schema).createOrReplaceTempView(name)
        return
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    spark.catalog.createTable(name, path=path, schema=fields, source="parquet")


def insert_rows(spark: SparkSession, name: str, rows: Sequence[tuple] | DataFrame) -> None:
    """Append literal rows, or the rows of a frame, to a table, matched by position."""
    if not isinstance(rows, DataFrame):
        rows = spark.createDataFrame(rows, spark.table(name).schema)
    rows.write.insertInto(name)
