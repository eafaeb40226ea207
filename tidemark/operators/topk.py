"""Top-k and sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

SALTS = 64


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The first k rows; each task keeps k, so only k rows per task are merged."""
    return df.orderBy(*order).limit(k)


def top_k_per_group(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column],
    k: int | Column,
    spread: Sequence[str],
    rank: str = "rank",
    salts: int = SALTS,
) -> DataFrame:
    """The first k rows of each group, with their rank.

    Each group is first cut into ``salts`` parts by a hash of the ``spread`` columns and the
    first k of every part are kept; the second pass ranks at most ``salts * k`` rows per group.
    The result equals ranking the whole group at once, whatever its size.
    """
    limit = k if isinstance(k, Column) else F.lit(k)
    part = F.pmod(F.xxhash64(*spread), F.lit(salts))
    local = Window.partitionBy(*by, "__part").orderBy(*order)
    whole = Window.partitionBy(*by).orderBy(*order)
    return (
        df.withColumn("__part", part)
        .withColumn("__local", F.row_number().over(local))
        .filter(F.col("__local") <= limit)
        .drop("__part", "__local")
        .withColumn(rank, F.row_number().over(whole))
        .filter(F.col(rank) <= limit)
    )


def sample_rows(df: DataFrame, n: int, key: Sequence[str], seed: int = 0) -> DataFrame:
    """``n`` rows (all of them if there are fewer), for a preview: those whose ``key`` columns have the
    smallest hashes with ``seed``, so the same rows come whatever the partitioning."""
    drawn = F.md5(F.concat_ws("|", *key, F.lit(seed)))
    return df.withColumn("__r", drawn).orderBy("__r", *key).limit(n).drop("__r")
