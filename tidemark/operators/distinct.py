"""Exact numbers of distinct ids per period, added up from stored daily parts.

A number of distinct ids cannot be added up, but sets of ids can be united.  A day keeps its ids as
bitmaps: ids are cut into ranges of 32,768 (a *part*), and each part that occurs is one row with a bitmap of
4 KB at most.  Any longer period is the union of its days' bitmaps, part by part, without the raw rows.

Bitmaps are small for dense ids.  Wide ones (texts, hashes) get dense numbers first, see ``numbered``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.running import with_position


def id_parts(df: DataFrame, by: Sequence[Column | str], ids: str) -> DataFrame:
    """One row per group and part with the bitmap of the whole numbers ``ids``; null ids are no members.

    Bits are set in every task before the parts are exchanged, so a hot group costs no more than others.
    """
    known = df.filter(F.col(ids).isNotNull())
    return known.groupBy(*by, F.bitmap_bucket_number(ids).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(ids)).alias("bits")
    )


def merge_parts(parts: DataFrame, by: Sequence[Column | str]) -> DataFrame:
    """Parts of coarser groups: unions of the bitmaps below them."""
    return parts.groupBy(*by, "part").agg(F.bitmap_or_agg("bits").alias("bits"))


def count_ids(parts: DataFrame, by: Sequence[Column | str], alias: str) -> DataFrame:
    """Distinct ids per group, from parts of the same or finer groups."""
    merged = merge_parts(parts, by)
    names = [c for c in merged.columns if c not in ("part", "bits")]
    return merged.groupBy(*names).agg(F.sum(F.bitmap_count("bits")).alias(alias))


def numbered(values: DataFrame, column: str, known: DataFrame | None = None) -> DataFrame:
    """Dense numbers from 0 for the distinct values of ``column``: (column, number).

    ``known`` is an earlier result, whose numbers stay as they are; values it lacks get the next ones.
    Null has no number.
    """
    new = values.select(column).filter(F.col(column).isNotNull()).distinct()
    first = F.lit(0).cast("bigint")
    if known is not None:
        new = new.join(known, column, "left_anti")
        first = F.coalesce(known.agg(F.max("number") + 1).scalar(), first)
    hashed = new.withColumn("__hash", F.xxhash64(column))
    placed = with_position(hashed, ["__hash", column], F.col("__hash").cast("double"), alias="number")
    out = placed.select(column, (F.col("number") + first).alias("number"))
    return out if known is None else known.select(column, "number").unionAll(out)
