"""Stored parts that add up: distinct ids, month rollups, models that are built once, reproducible draws."""

import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.functions import random_day_range, random_days, uniform, uniform_value
from tidemark.operators.distinct import count_ids, id_parts, merge_parts, numbered
from tidemark.operators.materialise import cut_lineage, delete_folder, release_stored, shared_folder, stored_so_far
from tidemark.plans.models import Model, input_fingerprint, plan_fingerprint, run_changed
from tidemark.plans.trips import daily_rollup, month_rollup
from tidemark.streaming import refresh

TRIPS = "starttime timestamp_ntz, bikeid bigint"


# -- distinct ids ------------------------------------------------------------------------------


def test_distinct_ids_from_daily_bitmaps(spark):
    rng = random.Random(3)
    ids = [None, 0, -1, -40_000, 1, 32_767, 32_768, 32_769, 10**12, -(10**12), *range(500, 560)]
    data = [(dt.date(2024, 1, 29) + dt.timedelta(days=rng.randrange(20)), rng.choice(ids), rng.choice(["a", None])) for _ in range(900)]
    df = spark.createDataFrame(data, "day date, id bigint, kind string").repartition(5)
    days = id_parts(df, ["day", "kind"], "id")
    month = F.trunc("day", "month").alias("month")
    for by, period in ((["day"], [F.col("day")]), (["kind"], [F.col("kind")]), (["month", "kind"], [month, F.col("kind")])):
        want = df.groupBy(*period).agg(F.countDistinct("id").alias("ids"))
        assert rows(count_ids(days, period, "ids").select(*by, "ids")) == rows(want.select(*by, "ids"))
    merged = merge_parts(days, [month])
    assert merged.count() < days.count()
    assert rows(count_ids(merged, ["month"], "ids")) == rows(count_ids(days, [month], "ids"))
    assert count_ids(id_parts(df.limit(0), ["day"], "id"), ["day"], "ids").collect() == []


def test_numbers_are_dense_and_stay(spark):
    first = spark.createDataFrame([(v,) for v in ["b", "a", "b", None, "é", ""]], "v string")
    known = numbered(first, "v").cache()
    assert sorted(r["number"] for r in known.collect()) == [0, 1, 2, 3]
    more = numbered(first.union(spark.createDataFrame([("new",), ("newer",)], "v string")), "v", known)
    got = {r["v"]: r["number"] for r in more.collect()}
    assert {v: got[v] for v in ("b", "a", "é", "")} == {r["v"]: r["number"] for r in known.collect()}
    assert {got["new"], got["newer"]} == {4, 5} and len(got) == 6


# -- month rollup ------------------------------------------------------------------------------


class Arrivals:
    def __init__(self, spark, folder):
        self.spark, self.folder, self.rng = spark, str(folder), random.Random(5)
        self.rollup = f"{folder}/rollup"

    def load(self, year, n=60):
        data = [(dt.datetime(year, 1 + self.rng.randrange(12), 1 + self.rng.randrange(28), 3), i) for i in range(n)] + [(None, 1)]
        self.spark.createDataFrame(data, TRIPS).repartition(2).write.mode("append").parquet(f"{self.folder}/in")
        refresh.refresh_rollup(self.spark, f"{self.folder}/in", TRIPS, self.rollup, f"{self.folder}/progress", "month", max_files=1)

    def check(self):
        columns = ["month", "trip_count", "starttime"]
        want = month_rollup(self.spark.read.schema(TRIPS).parquet(f"{self.folder}/in"))
        assert rows(refresh.read_rollup(self.spark, self.rollup, "month").select(columns)) == rows(want.select(columns))


def test_month_rollup_with_late_files_replay_and_compaction(spark, tmp_path):
    a = Arrivals(spark, tmp_path)
    for year in (2024, 2022, 2025):         # the first start seen moves back with the second load
        a.load(year)
        a.check()
    last = max(r[0] for r in spark.read.parquet(f"{a.rollup}/batches").select("batch_id").collect())
    replayed = spark.read.parquet(f"{a.rollup}/batches").filter(f"batch_id = {last}").drop("batch_id").cache()
    replayed.count()
    assert refresh.compact(spark, a.rollup, "month", keep=True) == last     # older parts still there: not counted twice
    a.check()
    assert refresh.compact(spark, a.rollup, "month") == last
    a.check()
    assert spark.read.schema("batch_id bigint").parquet(f"{a.rollup}/batches").count() == 0
    replayed.write.mode("overwrite").parquet(f"{a.rollup}/batches/batch_id={last}")   # a repeated batch
    a.check()
    a.load(2021)
    a.check()
    newer = refresh.compact(spark, a.rollup, "month")
    assert newer > last and refresh.compact(spark, a.rollup, "month") == newer
    a.check()
    assert [r[0] for r in spark.read.parquet(f"{a.rollup}/base").select("base_id").distinct().collect()] == [newer]


def test_empty_rollup(spark, tmp_path):
    assert refresh.read_rollup(spark, str(tmp_path / "none"), "month").collect() == []
    assert refresh.compact(spark, str(tmp_path / "none")) is None


def test_daily_rollup_keeps_its_base_too(spark, tmp_path):
    trips = spark.createDataFrame([(dt.datetime(2024, 1, 1 + i % 3), i) for i in range(9)], TRIPS)
    for i in range(2):
        daily_rollup(trips).write.parquet(f"{tmp_path}/r/batches/batch_id={i}")
    refresh.compact(spark, f"{tmp_path}/r")
    assert [r["trip_count"] for r in refresh.read_rollup(spark, f"{tmp_path}/r").collect()] == [6, 6, 6]


# -- models ------------------------------------------------------------------------------------


def models(limit=2):
    return [
        Model("small", ("a",), lambda a: a.filter(F.col("id") < limit)),
        Model("joined", ("small", "b"), lambda small, b: small.join(b, "id")),
        Model("other", ("b",), lambda b: b.agg(F.sum("id").alias("total"))),
        Model("last", ("joined",), lambda joined: joined.groupBy("id").count()),
    ]


def test_only_what_changed_is_built(spark, tmp_path):
    for name, n in (("a", 5), ("b", 3)):
        spark.range(n).write.parquet(str(tmp_path / name))
    seeds = {n: spark.read.parquet(str(tmp_path / n)) for n in "ab"}
    folder = str(tmp_path / "out")
    frames, built = run_changed(spark, models(), seeds, folder)
    assert set(built) == {"small", "joined", "other", "last"} and built.index("small") < built.index("joined") < built.index("last")
    assert frames["last"].count() == 2 and frames["other"].first()[0] == 3
    again, built = run_changed(spark, models(), {n: spark.read.parquet(str(tmp_path / n)) for n in "ab"}, folder)
    assert built == [] and rows(again["joined"]) == rows(frames["joined"])
    # A new definition reaches its dependants; going back finds the earlier results.
    frames, built = run_changed(spark, models(1), seeds, folder)
    assert built == ["small", "joined", "last"] and frames["last"].count() == 1
    assert run_changed(spark, models(), seeds, folder)[1] == []
    # A changed seed reaches all that read it.
    spark.range(10, 14).write.mode("append").parquet(str(tmp_path / "b"))
    frames, built = run_changed(spark, models(), {**seeds, "b": spark.read.parquet(str(tmp_path / "b"))}, folder)
    assert sorted(built) == ["joined", "last", "other"] and frames["other"].first()[0] == 49


def test_a_run_that_was_cut_short_goes_on(spark, tmp_path):
    seeds = {n: spark.createDataFrame([(i,) for i in range(4)], "id bigint") for n in "ab"}
    folder = str(tmp_path)
    frames, _ = run_changed(spark, models(), seeds, folder)
    place = frames["joined"].inputFiles()[0].rsplit("/data/", 1)[0]
    assert delete_folder(spark, f"{place}/done")
    frames, built = run_changed(spark, models(), seeds, folder)
    assert built == ["joined"] and frames["last"].count() == 2


def test_fingerprints(spark):
    one = spark.createDataFrame([(1, "a"), (2, None)], "i int, s string")
    assert input_fingerprint(one) == input_fingerprint(spark.createDataFrame([(2, None), (1, "a")], "i int, s string"))
    assert input_fingerprint(one) != input_fingerprint(spark.createDataFrame([(1, "a"), (2, "")], "i int, s string"))
    plan = lambda k: spark.range(9).filter(F.exists(F.array("id"), lambda x: x > k)).withColumn("t", F.col("id") + k)
    assert plan_fingerprint(plan(1)) == plan_fingerprint(plan(1)) != plan_fingerprint(plan(2))


# -- draws -------------------------------------------------------------------------------------


def test_draws_do_not_depend_on_partitions(spark):
    df = spark.range(2000).withColumn("k", F.when(F.col("id") % 5 != 0, F.col("id").cast("string")))
    drawn = [rows(d.select("id", uniform(7, "id", "k").alias("u"))) for d in (df.repartition(2), df.repartition(9, "k").orderBy(F.desc("id")))]
    assert drawn[0] == drawn[1]
    values = [u for _, u in drawn[0]]
    assert all(0 <= u < 1 for u in values) and abs(sum(values) / 2000 - 0.5) < 0.03
    assert {i: u for i, u in drawn[0]}[4] == uniform_value(7, 4, "4") and {i: u for i, u in drawn[0]}[5] == uniform_value(7, 5, None)
    for other in (uniform(8, "id", "k"), uniform(7, "id", "k", draw=1)):
        assert set(values).isdisjoint(r[0] for r in df.select(other).collect())


def test_random_ranges_are_ordered_and_within_bounds(spark):
    low, high = dt.date(2024, 1, 1), dt.date(2024, 1, 10)
    got = spark.range(500).select("id", random_days(3, low, high, "id").alias("r")).select("id", "r.*").collect()
    assert all(low <= r["start_day"] <= r["end_day"] <= high for r in got)
    assert {r["start_day"] for r in got} | {r["end_day"] for r in got} == {low + dt.timedelta(days=i) for i in range(10)}
    assert all(random_day_range(3, low, high, r["id"]) == (r["start_day"], r["end_day"]) for r in got)
    assert random_day_range(3, low, low, 1) == (low, low)


# -- intermediate results ----------------------------------------------------------------------


def test_release_leaves_what_is_needed(spark):
    before = cut_lineage(spark.range(3))
    mark = stored_so_far(spark)
    cut_lineage(spark.range(4)), cut_lineage(spark.range(6))
    result = cut_lineage(spark.range(5))
    assert release_stored(spark, mark, keep=result) == 2
    assert before.count() == 3 and result.count() == 5
    assert release_stored(spark, mark) == 1 and before.count() == 3


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, key, default=None):
            return {"spark.sql.warehouse.dir": "/w"}.get(key, default)

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        shared_folder(Session())
    Session.sparkContext.master = "local[4]"
    assert shared_folder(Session()) == "/w/_stored"
