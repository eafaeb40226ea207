"""Table profiles: statistics, correlation, frequencies, histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.filters import numeric_columns, text_columns

CORRELATION_BLOCK = 8


def _rows(df: DataFrame, structs: Sequence[Column]) -> DataFrame:
    """One wide row to one row per struct."""
    return df.select(F.inline(F.array(*structs)))


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample standard deviation, minimum and maximum per numeric column.

    Typed rows instead of text, all columns in one pass.
    """
    columns = list(columns or numeric_columns(df))
    aggs = []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        aggs += [
            F.count(c).alias(f"n{i}"), F.avg(x).alias(f"a{i}"),
            F.stddev_samp(x).alias(f"s{i}"), F.min(x).alias(f"l{i}"), F.max(x).alias(f"h{i}"),
        ]
    return _rows(
        df.agg(*aggs),
        [
            F.struct(
                F.lit(c).alias("column_name"), F.col(f"n{i}").alias("count"),
                F.col(f"a{i}").alias("mean"), F.col(f"s{i}").alias("stddev"),
                F.col(f"l{i}").alias("min"), F.col(f"h{i}").alias("max"),
            )
            for i, c in enumerate(columns)
        ],
    )


def table_profile(df: DataFrame) -> DataFrame:
    """Per column: position, type, row count and non-null count, in one pass."""
    aggs = [F.count(F.lit(1)).alias("n"), *[F.count(c).alias(f"c{i}") for i, c in enumerate(df.columns)]]
    return _rows(
        df.agg(*aggs),
        [
            F.struct(
                F.lit(i).alias("position"), F.lit(name).alias("column_name"), F.lit(kind).alias("data_type"),
                F.col("n").alias("row_count"), F.col(f"c{i}").alias("non_null_count"),
            )
            for i, (name, kind) in enumerate(df.dtypes)
        ],
    )


def correlation(x: str | Column, y: str | Column) -> Column:
    """Correlation of two columns over the rows that have both; null if either does not vary.

    Spark's own ``corr`` raises an error on a constant column in ANSI mode.
    """
    spread = F.sqrt(F.regr_sxx(y, x)) * F.sqrt(F.regr_syy(y, x))
    return F.regr_sxy(y, x) / F.nullif(spread, F.lit(0.0))


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pairwise correlation of numeric columns: a row per column, a column per column.

    One pass: each row is repeated for every column and block of partner columns, and a task
    folds it into one group per column and block right away, so only the square itself is
    shuffled.  Blocks keep the aggregate narrow enough for generated code.
    """
    columns = list(columns or numeric_columns(df))
    starts = range(0, len(columns), CORRELATION_BLOCK)
    values = df.select(F.array(*[F.col(c).cast("double") for c in columns]).alias("v"))
    partners = [
        F.struct(
            F.lit(start).alias("start"),
            *[F.get("v", F.lit(start + k)).alias(f"y{k}") for k in range(CORRELATION_BLOCK)],
        )
        for start in starts
    ]
    pairs = values.select("v", F.posexplode("v").alias("i", "x")).select("i", "x", F.inline(F.array(*partners)))
    parts = pairs.groupBy("i", "start").agg(
        *[correlation("x", f"y{k}").alias(f"r{k}") for k in range(CORRELATION_BLOCK)]
    )
    square = parts.groupBy("i").agg(
        *[
            F.max(F.when(F.col("start") == j - j % CORRELATION_BLOCK, F.col(f"r{j % CORRELATION_BLOCK}"))).alias(c)
            for j, c in enumerate(columns)
        ]
    )
    names = F.array(*[F.lit(c) for c in columns])
    return square.select(names[F.col("i")].alias("column_name"), *columns)


def category_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Frequency of every value of several columns (by default all text columns), in one pass."""
    columns = list(columns or text_columns(df))
    long = df.select(
        F.inline(
            F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("category")) for c in columns])
        )
    )
    return long.groupBy("column_name", "category").agg(F.count(F.lit(1)).alias("row_count"))


def histogram(df: DataFrame, columns: Sequence[str] | None = None, bins: int = 10) -> DataFrame:
    """Equal-width histogram per column (by default all numeric ones); empty bins are listed, the last is closed.

    One pass finds the ranges, a second counts; both aggregate before they shuffle.  Nulls and NaN
    lie in no bin and do not widen the range.
    """
    columns = list(columns or numeric_columns(df))
    number = lambda c: F.col(c).cast("double")
    wide = df.select(*[F.when(~F.isnan(number(c)), number(c)).alias(c) for c in columns])
    ranges = wide.agg(
        *[f(c).alias(f"{p}{i}") for i, c in enumerate(columns) for p, f in (("l", F.min), ("h", F.max))]
    )
    bounds = _rows(
        ranges,
        [
            F.struct(F.lit(c).alias("column_name"), F.col(f"l{i}").alias("low"), F.col(f"h{i}").alias("high"))
            for i, c in enumerate(columns)
        ],
    ).filter(F.col("low").isNotNull())
    values = wide.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in columns]))
    ).filter(F.col("value").isNotNull())
    span = F.col("high") - F.col("low")
    position = F.floor((F.col("value") - F.col("low")) / F.nullif(span, F.lit(0.0)) * bins)
    bin_number = F.least(F.coalesce(position, F.lit(0)), F.lit(bins - 1)).cast("int")
    # ``bounds`` has one row per histogram column.
    counted = (
        values.join(F.broadcast(bounds), "column_name")
        .groupBy("column_name", bin_number.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    slots = bounds.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return slots.join(counted, ["column_name", "bin"], "left").select(
        "column_name",
        "bin",
        (F.col("low") + span * F.col("bin") / bins).alias("bin_start"),
        (F.col("low") + span * (F.col("bin") + 1) / bins).alias("bin_end"),
        F.coalesce("n", F.lit(0)).cast("long").alias("row_count"),
    )


def density(df: DataFrame, value: str, points: int = 200) -> DataFrame:
    """Gaussian kernel density on an even grid over the value range, bandwidth by Scott's rule.

    Equal values are counted first, so each distinct value adds to the ``points`` grid values once; a task
    folds its values into ``points`` partial sums before anything is shuffled again.
    """
    x = df.select(F.col(value).cast("double").alias("x")).filter(F.col("x").isNotNull())
    stats = x.agg(
        F.struct(
            F.min("x").alias("low"), F.max("x").alias("high"), F.count("x").alias("n"),
            (F.stddev_samp("x") * F.pow(F.count("x").cast("double"), F.lit(-0.2))).alias("h"),
        ).alias("s")
    ).scalar()
    grid = F.explode(F.sequence(F.lit(0), F.lit(points - 1)))
    at = F.col("s.low") + (F.col("s.high") - F.col("s.low")) * F.col("grid_point") / (points - 1)
    z = (F.col("position") - F.col("x")) / F.col("s.h")
    return (
        x.groupBy("x").agg(F.count(F.lit(1)).alias("times"))
        .select("x", "times", stats.alias("s"))
        .select("x", "times", "s", grid.alias("grid_point"))
        .withColumn("position", at)
        .groupBy("grid_point")
        .agg(
            F.max("position").alias("position"),
            (F.sum(F.col("times") * F.exp(-z * z / 2)) / F.max(F.col("s.n") * F.col("s.h") * F.sqrt(2 * F.pi()))).alias("density"),
        )
    )
