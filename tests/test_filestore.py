"""The file store connector: pushed filters mean the same as Spark's, and fewer rows are read."""

import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNotNull, Not

from tidemark.operators.filters import plan_text
from tidemark.sources.filestore import StoreReader, copy_store, query_store, read_store

SCHEMA = "id bigint, kind string, at timestamp_ntz, day date, price double, flag boolean"


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    rng, start = random.Random(1), dt.datetime(2024, 1, 1)
    data = [
        (i, rng.choice(["a", "ab", "b", None]), start + dt.timedelta(hours=i), (start + dt.timedelta(days=i % 30)).date(),
         rng.choice([1.5, float("nan"), None, -2.0, 0.0]), rng.choice([True, False, None]))
        for i in range(400)
    ]
    plain = spark.createDataFrame(data + [(None,) * 6], SCHEMA).cache()
    path = str(tmp_path_factory.mktemp("store") / "rows")
    plain.repartitionByRange(8, "id").sortWithinPartitions("id").write.parquet(path)
    return path, plain


CONDITIONS = [
    "id = 7", "id > 390", "id >= 390 AND id < 395", "kind = 'a'", "kind IN ('a', 'b')", "NOT kind IN ('a', 'b')", "kind <> 'a'",
    "kind LIKE 'a%'", "kind IS NULL", "kind IS NOT NULL AND flag", "NOT flag", "at >= timestamp_ntz'2024-01-10 00:00:00'",
    "day = date'2024-01-05'", "day <= date'2024-01-02' AND id > 100", "price > 1", "isnan(price)", "price IS NULL",
    "id + 1 = 5", "id = 3 OR id = 9", "id <=> NULL", "length(kind) = 2 AND id < 50", "NOT (id < 395)",
]


@pytest.mark.parametrize("condition", CONDITIONS)
def test_filters_mean_the_same(spark, store, condition):
    path, plain = store
    got = read_store(spark, path, plain.schema).filter(condition)
    assert list(map(str, rows(got))) == list(map(str, rows(plain.filter(condition))))


def test_plan_shows_pushed_filters_and_fewer_rows_are_read(spark, store):
    path, plain = store
    frame = query_store(spark, path, plain.schema, "SELECT id FROM {source} WHERE id > 380 AND kind = 'a' AND price > 1")
    scan = next(line for line in plan_text(frame).splitlines() if "PushedFilters" in line or "pushed" in line.lower())
    assert "id" in scan and "kind" in scan

    def read(*filters):
        reader = StoreReader(path, plain.schema)
        left = list(reader.pushFilters(list(filters)))
        parts = reader.partitions()
        return left, len(parts), sum(batch.num_rows for part in parts for batch in reader.read(part))

    everything = read()
    assert everything[1] >= 8 and everything[2] == plain.count()
    late, price = GreaterThan(("id",), 380), GreaterThan(("price",), 1.0)
    left, parts, n = read(late, EqualTo(("kind",), "a"), price)
    assert left == [price] and parts <= 2 and n < 19
    assert read(Not(In(("kind",), ("a", None))))[0] and not read(IsNotNull(("price",)))[0]


def test_copy_and_empty_store(spark, store, tmp_path):
    path, plain = store
    copied = copy_store(spark, path, plain.schema, "SELECT kind, count(*) AS n FROM {source} GROUP BY kind", "copied_store", str(tmp_path / "t"))
    assert rows(copied) == rows(plain.groupBy("kind").agg(F.count(F.lit(1)).alias("n")))
    spark.sql("DROP TABLE copied_store")
    plain.limit(0).write.parquet(str(tmp_path / "empty"))
    assert read_store(spark, str(tmp_path / "empty"), plain.schema).filter("id > 1").collect() == []
