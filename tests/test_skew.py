"""Joins with heavy keys: results as the plain join, and even tasks."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators.skew import copied, heavy_keys, key_hash, pieces, salted, skew_join


@pytest.fixture(scope="module")
def sides(spark):
    """Half of the rows belong to customer 1, some to none; the other side has several rows for some keys."""
    rng = random.Random(2)
    large = [(i, 1 if rng.random() < 0.5 else rng.choice([None, *range(2, 60)]), rng.randrange(3)) for i in range(4000)]
    other = [(c, d, n) for c in [None, 1, *range(2, 90, 2)] for d in range(3) for n in range(1 + (c or 0) % 3)]
    return (
        spark.createDataFrame(large, "id bigint, customer bigint, day int").cache(),
        spark.createDataFrame(other, "customer bigint, day int, limit int").cache(),
    )


def test_heavy_keys_are_those_above_the_share(spark, sides):
    large, _ = sides
    heavy = heavy_keys(large, ["customer"], 0.1)
    one = large.filter("customer = 1").select(key_hash(["customer"])).first()[0]
    assert set(heavy) == {one} and heavy[one] in (5, 6)
    assert heavy_keys(large.limit(0), ["customer"]) == {}
    assert len(heavy_keys(large, ["customer"], 0.001)) > 40
    assert [r[0] for r in large.select(pieces(["customer"], heavy)).distinct().collect()] in ([8, 1], [1, 8])


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("share", [0.9, 0.2, 0.001])
def test_equals_the_plain_join(sides, how, share):
    large, other = sides
    plain = large.join(other, ["customer", "day"], how)
    got = skew_join(large, other, ["customer", "day"], how, share=share)
    assert rows(got.select(plain.columns)) == rows(plain)
    renamed = other.withColumnsRenamed({"customer": "c", "day": "d"})
    condition = (F.col("limit") >= 1) & (F.col("id") % 2 == F.col("limit") % 2)
    plain = large.join(renamed, (large["customer"] == renamed["c"]) & condition, how)
    got = skew_join(large, renamed.withColumnRenamed("c", "customer"), ["customer"], how, condition, share=share)
    assert rows(got.select([c for c in plain.columns if c != "c"])) == rows(plain.drop("c"))


def test_right_and_full_joins_are_rejected(sides):
    with pytest.raises(ValueError):
        skew_join(*sides, ["customer"], "full")


def test_half_of_all_rows_on_one_customer_leave_even_tasks(spark):
    """Rows per task of the join's exchange: the largest is a small multiple of the mean."""
    tasks, n = 32, 40_000
    large = spark.range(n).select("id", F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id")).alias("customer"))
    heavy = heavy_keys(large, ["customer"], 1 / (4 * tasks))

    def largest(df, *by):
        sizes = df.repartition(tasks, *by).groupBy(F.spark_partition_id()).count().collect()
        return max(r["count"] for r in sizes) / (n / tasks)

    assert largest(large, "customer") > 15
    assert largest(salted(large, ["customer"], heavy), "customer", "__salt") < 3
    other = spark.createDataFrame([(7,), (8,)], "customer bigint")
    assert copied(other, ["customer"], heavy).count() == 128 + 1
