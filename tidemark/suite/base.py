"""Registration of queries and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.samples import SampleTables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a job under ``name``; it gets the relations of one data folder."""

    def register(job: Callable[[SampleTables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = lambda spark, folder: job(SampleTables(spark, folder))
        if sql is not None:
            ORACLE[name] = sql
        return job

    return register
