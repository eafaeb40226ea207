"""Joins whose larger side may hold a few very frequent keys.

Adaptive execution splits a hot key only where both sides of a join arrive by a plain exchange.  Where
one side is an aggregate that already lies by the join's key, one task gets all of a hot key.  Here
the frequent keys are found by a mergeable sketch, and only those are salted: their rows of the larger
side are spread over pieces, their rows of the other side are copied to every piece.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: Keys below this share of the rows are never salted, so there are fewer than 20,000 salted keys.
LEAST_SHARE = 1 / 20_000


def key_hash(keys: Sequence[Column | str]) -> Column:
    return F.xxhash64(*keys)


def heavy_keys(df: DataFrame, keys: Sequence[Column | str], share: float | None = None) -> dict[int, int]:
    """Hash of each key that may hold more than ``share`` of the rows, and into how many pieces it goes.

    ``share`` defaults to half of what an even task of the shuffle width gets.  A frequent-items sketch
    of fixed size is filled in every task and merged, in one pass that reads only the key columns.  It never
    misses a key above the share; keys it counts too high are salted needlessly, which changes no result.
    At most ``2 / share`` entries reach the driver.
    """
    if share is None:
        share = 1 / (2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    share = max(share, LEAST_SHARE)
    most = math.ceil(2 / share)
    row = (
        df.select(key_hash(keys).alias("key"))
        .agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(key, {most}, {16 * most})").alias("top"))
        .first()
    )
    if not row["n"]:
        return {}
    limit = row["n"] * share
    return {item["item"]: math.ceil(item["count"] / limit) for item in row["top"] or () if item["count"] > limit}


def pieces(keys: Sequence[Column | str], heavy: dict[int, int]) -> Column:
    """Into how many pieces the key of a row goes: 1, or a power of two for a heavy key."""
    tiers: dict[int, list[int]] = {}
    for key, n in heavy.items():
        tiers.setdefault(1 << (n - 1).bit_length(), []).append(key)
    chosen = None
    for n, members in sorted(tiers.items()):
        here = key_hash(keys).isin(members)
        chosen = F.when(here, n) if chosen is None else chosen.when(here, n)
    return F.lit(1) if chosen is None else chosen.otherwise(1)


def salted(df: DataFrame, keys: Sequence[Column | str], heavy: dict[int, int], alias: str = "__salt") -> DataFrame:
    """The larger side with a salt; a hash of the row picks it, so a repeated task picks it again."""
    return df.withColumn(alias, F.pmod(F.xxhash64(*df.columns), pieces(keys, heavy)).cast("int"))


def copied(df: DataFrame, keys: Sequence[Column | str], heavy: dict[int, int], alias: str = "__salt") -> DataFrame:
    """The other side, each row once for every salt its key can have."""
    return df.withColumn(alias, F.explode(F.sequence(F.lit(0), pieces(keys, heavy) - 1)))


def skew_join(
    large: DataFrame, other: DataFrame, keys: Sequence[str], how: str = "inner", condition: Column | None = None,
    heavy: dict[int, int] | None = None, share: float | None = None,
) -> DataFrame:
    """``large`` joined to ``other`` on equal ``keys``, which both have, and ``condition``.

    Inner, left, left_semi and left_anti only: every row of ``large`` meets all of its partners in one
    place, so it is judged as a whole.  ``heavy`` (see ``heavy_keys``) may come from an earlier pass over the
    same keys.  Without heavy keys this is the plain join.  ``condition`` must name columns that only one side
    has.  Key columns appear once, as those of ``large``; null keys have no partner.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"rows of the copied side would appear repeatedly in a {how} join")
    if heavy is None:
        heavy = heavy_keys(large, keys, share)
    renamed = other.withColumnsRenamed({k: f"__other_{k}" for k in keys})
    on = [F.col(k) == F.col(f"__other_{k}") for k in keys] + ([] if condition is None else [condition])
    if heavy:
        large = salted(large, keys, heavy)
        renamed = copied(renamed, [f"__other_{k}" for k in keys], heavy, "__other_salt")
        on.append(F.col("__salt") == F.col("__other_salt"))
    return large.join(renamed, on, how).drop("__salt", "__other_salt", *[f"__other_{k}" for k in keys])
