"""Ordered computations over groups that may be too large for one task.

A plain window puts a whole group (or, without a group, the whole table) into one task.  Here
an ordered group is cut into contiguous *buckets*; each bucket is worked on by its own task, and
a small table of bucket totals carries the result across the cuts.  The answers are exact.

The number of buckets follows the number of rows, so a bucket stays as small when the table grows.
Cuts come in levels: up to FAN_OUT cuts of the whole, and where those are not enough, cuts of each
part between two of them.  Bucket totals are added up along the same tree, so no task sees more
than FAN_OUT of them for a group.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.materialise import cut_lineage

CHUNK_ROWS = 1 << 20
#: Parts that one level of cuts makes of a range, and how many times finer the sketch is that places them.
FAN_OUT = 1_000
SKETCH_FINER = 8


@dataclass(frozen=True)
class Cuts:
    """A step that adds a bucket number; ``levels`` above 1 mean that numbers are paths in a tree.

    ``deeper`` has one row per parent bucket with the sorted cuts below it, for each level after the first.
    """

    key: str
    alias: str
    first: list[float]
    deeper: tuple[DataFrame, ...] = ()
    fan_out: int = FAN_OUT

    @property
    def levels(self) -> int:
        return 1 + len(self.deeper)

    def __call__(self, df: DataFrame) -> DataFrame:
        splits = [float("-inf"), *(self.first or [0.0]), float("inf")]
        top = Bucketizer(splits=splits, inputCol=self.key, outputCol=self.alias, handleInvalid="keep")
        df = top.transform(df).withColumn(self.alias, F.coalesce(F.col(self.alias).cast("long"), F.lit(-1)))
        for table in self.deeper:
            # A stored table; at the second level it has at most FAN_OUT rows.
            inside = table.select(F.col("parent").alias("__parent"), F.col("cuts").alias("__cuts"))
            df = df.join(inside, F.col(self.alias) == F.col("__parent"), "left").withColumn(
                self.alias, F.col(self.alias) * self.fan_out + _place(F.col("__cuts"), F.col(self.key), self.fan_out)
            ).drop("__parent", "__cuts")
        return df


def _place(cuts: Column, key: Column, most: int) -> Column:
    """How many of the sorted cuts are at most ``key``, by halving; 0 for a null key or null cuts."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(most.bit_length()))])
    return F.aggregate(
        steps, F.lit(0),
        lambda at, step: F.when((at + step <= F.size(cuts)) & (F.get(cuts, at + step - 1) <= key), at + step).otherwise(at),
    )


def _quantiles(key: str, parts: int) -> Column:
    known = F.when(~F.isnan(key), F.col(key))
    return F.percentile_approx(known, [i / parts for i in range(1, parts)], SKETCH_FINER * parts)


def range_buckets(
    key: str, sample: DataFrame, buckets: int | None = None, alias: str = "bucket",
    rows_per_bucket: int = CHUNK_ROWS, fan_out: int = FAN_OUT,
) -> Cuts:
    """A step that adds a bucket number which never falls as ``key`` (a double) rises.

    There are ``buckets`` of them; by default the shuffle width, or more where a bucket would
    otherwise hold more than about ``rows_per_bucket`` rows of ``sample``.  Cut points are approximate
    quantiles of ``key``.  One pass finds the first ``fan_out`` and counts the rows; each further level
    takes a pass that finds cuts within every part, and stores them.  Only the first level's cuts reach
    the driver.  Uneven cuts would change balance, never results, and equal keys stay together.  A
    null key belongs to a bucket before all others, and NaN to the last, as Spark sorts them.
    """
    row = sample.agg(F.count(F.lit(1)).alias("n"), _quantiles(key, fan_out).alias("cuts")).first()
    wanted = buckets or max(
        int(sample.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(row["n"] / rows_per_bucket)
    )
    first = min(wanted, fan_out)
    found = row["cuts"] or []
    chosen = sorted({found[i * fan_out // first - 1] for i in range(1, first)}) if found else []
    cuts = Cuts(key, alias, chosen, (), fan_out)
    below = math.ceil(wanted / fan_out)
    while below > 1:
        parts = min(below, fan_out)
        inside = cuts(sample.select(key)).groupBy(F.col(alias).alias("parent")).agg(_quantiles(key, parts).alias("cuts"))
        table = cut_lineage(inside.select("parent", F.array_sort(F.array_distinct("cuts")).alias("cuts")))
        cuts = Cuts(key, alias, chosen, (*cuts.deeper, table), fan_out)
        below = math.ceil(below / fan_out)
    return cuts


def _with_earlier(
    totals: DataFrame, groups: Sequence[str], bucket: str, columns: dict[str, str], levels: int, fan_out: int
) -> DataFrame:
    """Add to bucket totals, under the given names, the sums over all earlier buckets of the group.

    With more than one level, totals of whole parents are carried first and buckets are only added up
    below one parent.
    """
    earlier = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    if levels == 1:
        inside = Window.partitionBy(*groups).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1) if groups else earlier
        return totals.withColumns({name: F.coalesce(F.sum(c).over(inside), F.lit(0)) for c, name in columns.items()})
    parent = f"__up{levels}_{bucket}"
    placed = totals.withColumn(parent, F.floor(F.col(bucket) / fan_out))
    above = {c: f"__up{levels}_{name}" for c, name in columns.items()}
    parents = _with_earlier(
        placed.groupBy(*groups, parent).agg(*[F.sum(c).alias(c) for c in columns]), groups, parent, above, levels - 1, fan_out
    ).drop(*columns)
    inside = Window.partitionBy(*groups, parent).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.join(parents, [*groups, parent])
        .withColumns({name: F.col(above[c]) + F.coalesce(F.sum(c).over(inside), F.lit(0)) for c, name in columns.items()})
        .drop(parent, *above.values())
    )


def order_key(df: DataFrame, day: str, tiebreak: str) -> Column:
    """A double that orders rows like (day, tiebreak), up to ties; ``tiebreak`` is numeric.

    Nulls sort first, as in a window: a null day counts as a day before the first, where the
    tiebreak still spreads the rows; a null tiebreak counts as the smallest.
    """
    low, high = F.min(tiebreak).cast("double"), F.max(tiebreak).cast("double")
    span = df.agg(
        F.struct(low.alias("low"), (high - low + 1).alias("width"), F.min(F.unix_date(day)).alias("first")).alias("s")
    ).scalar()
    date = F.coalesce(F.unix_date(day), span["first"] - 1, F.lit(0))
    return date + F.coalesce((F.col(tiebreak).cast("double") - span["low"]) / span["width"], F.lit(0.0))


def _keyed(df: DataFrame, by: Sequence[str], bucket: str) -> tuple[DataFrame, list[str]]:
    """The frame with its group as one struct column, and the join keys of group and bucket.

    A struct compares equal to another with the same nulls, so groups with a null key meet in a
    plain equi-join and share the exchange of the window before it.
    """
    if not by:
        return df, [bucket]
    return df.withColumn("__group", F.struct(*by)), ["__group", bucket]


def running_totals(
    points: DataFrame, order: str, totals: Sequence[str], by: Sequence[str] = (), bucket: str = "bucket",
    levels: int = 1, fan_out: int = FAN_OUT,
) -> DataFrame:
    """Add ``running_<c>``, the total of ``c`` over all points of the group up to this one, and
    ``total_<c>``, that of the whole group.

    ``points`` holds one row per (group, order value): aggregate first, so that equal order
    values are one row.  ``bucket`` cuts each group along ``order``; ``levels`` is that of its cuts.
    The table of bucket totals has one row per group and bucket, however many points there are.
    """
    keyed, keys = _keyed(points, by, bucket)
    groups = keys[:-1]
    in_bucket = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    sums = keyed.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in totals])
    carried = _with_earlier(sums, groups, bucket, {c: f"__before_{c}" for c in totals}, levels, fan_out)
    if not groups:
        whole = carried.withColumns({f"total_{c}": sums.agg(F.sum(c)).scalar() for c in totals})
    elif levels == 1:
        whole = carried.withColumns({f"total_{c}": F.sum(c).over(Window.partitionBy(*groups)) for c in totals})
    else:
        whole = carried.join(sums.groupBy(*groups).agg(*[F.sum(c).alias(f"total_{c}") for c in totals]), groups)
    inside = keyed.withColumns(
        {f"running_{c}": F.coalesce(F.sum(c).over(in_bucket), F.lit(0)) for c in totals}
    )
    return (
        inside.join(whole.drop(*totals), keys)
        .withColumns({f"running_{c}": F.col(f"running_{c}") + F.col(f"__before_{c}") for c in totals})
        .drop("__group", *[f"__before_{c}" for c in totals])
    )


def with_position(
    df: DataFrame, order: Sequence[str], key: Column, by: Sequence[str] = (), alias: str = "position",
    buckets: int | None = None, fan_out: int = FAN_OUT,
) -> DataFrame:
    """Add the 0-based rank of each row in the order ``order``, over the whole frame or within ``by``.

    ``key`` is a double that rises with that order (see ``order_key``) and only serves to cut
    the frame; ``order`` must be a total order, or equal rows get an arbitrary rank.
    """
    ranged = df.withColumn("__key", key)
    cuts = range_buckets("__key", ranged.select("__key"), buckets, "__bucket", fan_out=fan_out)
    keyed, keys = _keyed(cuts(ranged), by, "__bucket")
    counts = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    offsets = _with_earlier(counts, keys[:-1], "__bucket", {"__n": "__offset"}, cuts.levels, fan_out).drop("__n")
    in_bucket = Window.partitionBy(*keys).orderBy(*order)
    return (
        keyed.withColumn("__rank", F.row_number().over(in_bucket))
        .join(offsets, keys)
        .withColumn(alias, F.col("__offset") + F.col("__rank") - 1)
        .drop("__group", "__key", "__bucket", "__offset", "__rank")
    )


def moving_average(
    df: DataFrame,
    value: str,
    rows: int,
    order: Sequence[str],
    key: Column,
    by: Sequence[str] = (),
    alias: str = "moving_avg",
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Average of ``value`` over the current and the ``rows - 1`` preceding rows.

    Rows are ranked, over the whole frame or within ``by``, and cut into chunks of
    ``chunk_rows``.  Each chunk also receives the last ``rows - 1`` rows of the one before, so
    that its first averages are complete.
    """
    if chunk_rows < rows:
        raise ValueError("a chunk must be at least as long as the frame")
    ranked = with_position(df, order, key, by, "__position")
    chunk = F.floor(F.col("__position") / chunk_rows)
    near_end = F.col("__position") % chunk_rows >= chunk_rows - (rows - 1)
    homes = F.when(near_end, F.array(chunk, chunk + 1)).otherwise(F.array(chunk))
    frame = Window.partitionBy(*by, "__chunk").orderBy("__position").rowsBetween(-(rows - 1), 0)
    mean = F.sum(value).over(frame).cast("double") / F.nullif(F.count(value).over(frame), F.lit(0))
    return (
        ranked.withColumn("__chunk", F.explode(homes))
        .withColumn(alias, mean)
        .filter(F.col("__chunk") == chunk)
        .drop("__position", "__chunk")
    )


def group_quantiles(
    df: DataFrame, value: str, by: Sequence[str], quantiles: dict[str, float], buckets: int | None = None,
    fan_out: int = FAN_OUT,
) -> DataFrame:
    """Exact quantiles per group, interpolated linearly between neighbours.

    Equal values are counted first, then ranked with ``running_totals``: a group of any size is
    spread over all buckets, and no task holds the distinct values of a group.
    """
    known = df.filter(F.col(value).isNotNull()).withColumn("__value", F.col(value).cast("double"))
    cuts = range_buckets("__value", known.select("__value"), buckets, "__bucket", fan_out=fan_out)
    counted = known.groupBy(*by, "__value").agg(F.count(F.lit(1)).alias("__n"))
    points = running_totals(cuts(counted), "__value", ["__n"], by, "__bucket", cuts.levels, fan_out).withColumn(
        "__first", F.col("running___n") - F.col("__n")
    )

    def at(rank: Column) -> Column:
        here = (F.col("__first") <= rank) & (rank < F.col("running___n"))
        return F.max(F.when(here, F.col("__value")))

    picks, results = [], []
    for name, q in quantiles.items():
        rank = (F.col("total___n") - 1) * F.lit(q)
        picks += [
            at(F.floor(rank)).alias(f"__{name}_low"),
            at(F.ceil(rank)).alias(f"__{name}_high"),
            F.max(rank - F.floor(rank)).alias(f"__{name}_part"),
        ]
        low, high = F.col(f"__{name}_low"), F.col(f"__{name}_high")
        results.append((low + (high - low) * F.col(f"__{name}_part")).alias(name))
    picked = points.groupBy(*by).agg(F.max("total___n").alias("n"), *picks)
    return picked.select(*by, "n", *results)
