"""Named models built from each other and published as views."""

from __future__ import annotations

import hashlib
import posixpath
import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from graphlib import TopologicalSorter

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.filters import plan_text
from tidemark.operators.materialise import schema_name


@dataclass(frozen=True)
class Model:
    name: str
    refs: tuple[str, ...]
    build: Callable[..., DataFrame]     # called with one frame per ref, by name


@dataclass(frozen=True)
class SqlModel:
    """A model given as SQL text, with ``{name}`` where it reads another model or a seed."""

    name: str
    refs: tuple[str, ...]
    sql: str
    schema: str | None = None


def run_order(models: Sequence[Model | SqlModel]) -> list[str]:
    """Model names, each after everything it refers to; a cycle is an error."""
    graph = {m.name: set(m.refs) for m in models}
    return [n for n in TopologicalSorter(graph).static_order() if n in graph]


def run_models(
    spark: SparkSession, models: Sequence[Model], seeds: Mapping[str, DataFrame], prefix: str = ""
) -> dict[str, DataFrame]:
    """Publish every model as a temporary view (``prefix`` + name) in dependency order.

    Nothing is computed here: views nest into one plan per query.
    """
    frames = dict(seeds)
    by_name = {m.name: m for m in models}
    for name in run_order(models):
        model = by_name[name]
        frames[name] = model.build(**{r: frames[r] for r in model.refs})
        frames[name].createOrReplaceTempView(prefix + name)
    return {m.name: spark.table(prefix + m.name) for m in models}


def publish_views(
    spark: SparkSession, models: Sequence[SqlModel], seeds: Mapping[str, str], default_schema: str
) -> dict[str, str]:
    """Publish SQL models as catalog views in dependency order; returns their full names.

    A model goes to its own schema if it names one, else to the default.  ``seeds`` maps names
    to catalog tables.
    """
    names = dict(seeds)
    by_name = {m.name: m for m in models}
    for name in run_order(models):
        model = by_name[name]
        schema = schema_name(model.schema, default_schema)
        text = model.sql.format(**{r: names[r] for r in model.refs})
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
        spark.sql(f"CREATE OR REPLACE VIEW {schema}.{name} AS {text}")
        names[name] = f"{schema}.{name}"
    return {m.name: names[m.name] for m in models}


def _digest(*parts: str) -> str:
    return hashlib.sha256("\0".join(parts).encode()).hexdigest()


def input_fingerprint(df: DataFrame) -> str:
    """Stands for the content of a seed: names, sizes and times of its files.

    Only the files' entries are read.  A seed without files (rows given in the program) is stood for by a
    sum of its rows' hashes, which does not depend on their order.
    """
    files = df.inputFiles()
    if files:
        entries = df.sparkSession.read.format("binaryFile").load(files).select("path", "length", "modificationTime")
        return _digest(*sorted("|".join(map(str, row)) for row in entries.collect()))
    hashed = df.select(F.xxhash64(*df.columns).cast("decimal(38,0)").alias("h"))
    return _digest(str(df.dtypes), str(hashed.agg(F.count("h"), F.sum("h"), F.bit_xor(F.col("h").cast("bigint"))).first()))


def plan_fingerprint(df: DataFrame) -> str:
    """Stands for what a frame computes: its plan, without the numbers that change from run to run."""
    spark, limit = df.sparkSession, "spark.sql.debug.maxToStringFields"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "100000")
    try:
        text = plan_text(df, "extended")
    finally:
        spark.conf.set(limit, before)
    analyzed = text.split("== Analyzed Logical Plan ==")[1].split("== Optimized Logical Plan ==")[0]
    return _digest(re.sub(r"#\d+L?|(?<=\b[xyz]_)\d+|(?<=subquery#)\d+|plan_id=\d+", "", analyzed))


def run_changed(
    spark: SparkSession, models: Sequence[Model], seeds: Mapping[str, DataFrame], folder: str
) -> tuple[dict[str, DataFrame], list[str]]:
    """Every model as a stored frame, and the names of those that had to be built now.

    A model's fingerprint covers its own plan and the fingerprints of all it refers to, so a changed seed
    or definition reaches exactly the models that depend on it.  A result is stored under its
    fingerprint below ``folder`` and marked when it is complete; a marked one is read, not built.  A run that
    was cut short goes on where it stopped.  What a Python function does is not part of a plan:
    change its name when its meaning changes.
    """
    prints = {name: input_fingerprint(df) for name, df in seeds.items()}
    frames, built, by_name = dict(seeds), [], {m.name: m for m in models}
    for name in run_order(models):
        model = by_name[name]
        # Built on stored results, whose place says what they are, and on seeds.
        frame = model.build(**{r: frames[r] for r in model.refs})
        prints[name] = _digest(name, plan_fingerprint(frame), *(prints[r] for r in model.refs))
        place = posixpath.join(folder, name, prints[name])
        if not _marked(spark, place):
            frame.write.mode("overwrite").parquet(f"{place}/data")
            spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{place}/done")
            built.append(name)
        frames[name] = spark.read.schema(frame.schema).parquet(f"{place}/data")
    return {m.name: frames[m.name] for m in models}, built


def _marked(spark: SparkSession, place: str) -> bool:
    try:
        return spark.read.schema("id bigint").parquet(f"{place}/done").count() == 1
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
