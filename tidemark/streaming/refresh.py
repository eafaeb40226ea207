"""Incremental refresh of the trip rollups from newly arrived files.

A rollup is kept as *parts* that add up: every micro-batch writes its own groups to ``batches/batch_id=<n>``.
No state is kept between runs, trips may arrive in any order and however late, and a batch that is repeated
after a failure replaces its own part.  Compaction adds up all parts so far into ``base/base_id=<n>``, where
n is the last batch it holds; from then on readers take the newest base and the batches after it, and the
others can be deleted.  A batch that is repeated after it went into a base is not read again, so it cannot
count twice; a compaction that is repeated, or was cut short, changes nothing.
"""

from __future__ import annotations

import posixpath
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidemark.operators.materialise import delete_folder
from tidemark.plans.trips import daily_rollup, month_rollup


@dataclass(frozen=True)
class Mergeable:
    """A rollup whose parts can be added up in any order: how a part is made, and how parts merge."""

    part: Callable[[DataFrame], DataFrame]
    keys: tuple[str, ...]
    merged: tuple[Column, ...]
    schema: str


def _daily() -> Mergeable:
    return Mergeable(daily_rollup, ("starttime",), (F.sum("trip_count").alias("trip_count"),), "starttime timestamp_ntz, trip_count bigint")


def _months() -> Mergeable:
    """Trips per month name and the first start seen; counts add up, of the starts the smallest stays."""
    return Mergeable(
        month_rollup, ("month",), (F.sum("trip_count").alias("trip_count"), F.min("starttime").alias("starttime")),
        "month string, trip_count bigint, starttime timestamp_ntz",
    )


KINDS = {"day": _daily, "month": _months}


def refresh_rollup(
    spark: SparkSession, arrivals: str, schema: StructType | str, rollup: str, progress: str,
    kind: str = "day", max_files: int | None = None,
) -> None:
    """Count the trips of files not yet seen and add them to the rollup, then stop."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    spec = KINDS[kind]()

    def add(batch: DataFrame, batch_id: int) -> None:
        spec.part(batch).write.mode("overwrite").parquet(f"{rollup}/batches/batch_id={batch_id}")

    query = (
        reader.parquet(arrivals)
        .writeStream.foreachBatch(add)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _stored(spark: SparkSession, folder: str, schema: str, number: str) -> DataFrame | None:
    """The parts below a folder with their numbers; None if nothing has been stored there yet."""
    try:
        return spark.read.schema(f"{schema}, {number} bigint").parquet(folder)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _newest_base(bases: DataFrame | None) -> int | None:
    return None if bases is None else bases.agg(F.max("base_id")).first()[0]


def _merged(spec: Mergeable, parts: DataFrame) -> DataFrame:
    return parts.groupBy(*spec.keys).agg(*spec.merged)


def read_rollup(spark: SparkSession, rollup: str, kind: str = "day", until: int | None = None) -> DataFrame:
    """The rollup over the newest base and all batches after it (up to batch ``until``)."""
    spec = KINDS[kind]()
    bases = _stored(spark, f"{rollup}/base", spec.schema, "base_id")
    batches = _stored(spark, f"{rollup}/batches", spec.schema, "batch_id")
    newest, parts = _newest_base(bases), []
    if newest is not None:
        parts.append(bases.filter(F.col("base_id") == newest).drop("base_id"))
    if batches is not None:
        later = batches.filter(F.col("batch_id") > (-1 if newest is None else newest))
        parts.append((later if until is None else later.filter(F.col("batch_id") <= until)).drop("batch_id"))
    if not parts:
        parts.append(spark.createDataFrame([], spec.schema))
    return _merged(spec, parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]))


def compact(spark: SparkSession, rollup: str, kind: str = "day", keep: bool = False) -> int | None:
    """Add up all stored batches into a new base and delete what it replaces; the last batch in it.

    A base is complete or not seen: its files appear when its job commits, and only then are older parts
    deleted.  ``keep`` leaves them, for readers that began before.  Streams and compaction of one rollup
    must not run at the same time.
    """
    spec = KINDS[kind]()
    newest = _newest_base(_stored(spark, f"{rollup}/base", spec.schema, "base_id"))
    batches = _stored(spark, f"{rollup}/batches", spec.schema, "batch_id")
    held = -1 if newest is None else newest
    numbers = [] if batches is None else sorted(r[0] for r in batches.select("batch_id").distinct().collect())
    last = max([held, *numbers])
    if last > held:
        read_rollup(spark, rollup, kind, until=last).write.mode("overwrite").parquet(f"{rollup}/base/base_id={last}")
    if not keep:
        for number in numbers:
            if number <= last:
                delete_folder(spark, posixpath.join(rollup, "batches", f"batch_id={number}"))
        if newest is not None and newest < last:
            delete_folder(spark, posixpath.join(rollup, "base", f"base_id={newest}"))
    return None if last < 0 else last


def refresh_daily_rollup(
    spark: SparkSession, arrivals: str, schema: StructType | str, rollup: str, progress: str,
    max_files: int | None = None,
) -> None:
    """``refresh_rollup`` of the trips per day."""
    refresh_rollup(spark, arrivals, schema, rollup, progress, "day", max_files)


def compact_rollup(spark: SparkSession, rollup: str, target: str) -> DataFrame:
    """Store the summed daily rollup as its own folder, for readers that want one row per day."""
    read_rollup(spark, rollup).write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)
