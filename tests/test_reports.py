"""Filters, profiles, quality checks, unions, joins, models, trips."""

import datetime as dt
import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.functions import calendar_days, day_of_week, hash_below, ratio_to_report
from tidemark.operators import filters, materialise as mat, profile, quality
from tidemark.operators.joins import calendar_spine
from tidemark.operators.sets import union_distinct, union_relations
from tidemark.plans import bookings as book, trips as trip
from tidemark.plans.models import Model, SqlModel, publish_views, run_models, run_order

SPEC = [
    filters.FilterSpec("Current", "is_current", "flag", True),
    filters.FilterSpec("Off", "tenure", "range", (0, 0), enabled=False),
    filters.FilterSpec("Tenure", "TENURE", "range", (2, 4)),
]


@pytest.fixture(scope="module")
def members(spark):
    data = [(True, 1), (True, 2), (True, 4), (False, 3), (None, 3), (True, None)]
    return spark.createDataFrame(data, "is_current boolean, tenure int")


def test_filters_in_order(members):
    assert rows(filters.apply_filters(members, SPEC)) == [(True, 2), (True, 4)]


def test_statement_texts_run_as_they_are(spark, members):
    steps = filters.statement_texts("{members}", SPEC)
    assert [(number, label) for number, label, _ in steps] == [(1, "Original data"), (2, "Filter: 'Current'"), (3, "Filter: 'Tenure'")]
    assert [spark.sql(text, members=members).count() for _, _, text in steps] == [6, 4, 2]


def test_funnel_equals_counting_each_step(members):
    got = filters.filter_funnel(members, SPEC).orderBy("step").collect()
    steps = [filters.apply_filters(members, SPEC[:n]).count() for n in (0, 1, 3)]
    assert [r["row_count"] for r in got] == steps == [6, 4, 2]
    assert [r["source_label"] for r in got] == ["Original data", "Filter: 'Current'", "Filter: 'Tenure'"]
    assert got[-1]["target_label"] == "Result"


def test_statement_sequence(members):
    steps = filters.statement_sequence(members, SPEC)
    assert [s[:2] for s in steps] == [(1, "Original data"), (2, "Filter: 'Current'"), (3, "Filter: 'Tenure'")]
    assert "tenure" in steps[2][2]


def test_unknown_filter_kind():
    with pytest.raises(ValueError):
        filters.FilterSpec("x", "y", "regex")


def test_slider_bounds(members):
    assert rows(filters.slider_bounds(members, ["tenure"])) == [("tenure", 0, 4)]


def test_date_range_rules(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, d),) for d in range(1, 10)], "t timestamp_ntz")
    assert filters.date_range(df, "t").count() == 9
    assert filters.date_range(df, "t", "01/02/2024", "01/04/2024").count() == 3
    assert filters.date_range(df, "t", dt.date(2024, 1, 2), dt.datetime(2024, 1, 4, 12)).count() == 3
    for bounds in (("01/02/2024", None), (None, "01/02/2024")):
        with pytest.raises(ValueError):
            filters.date_range(df, "t", *bounds)


def test_date_range_reaches_the_scan(spark):
    trips = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = filters.plan_text(filters.date_range(trips, "o_orderdate", "01/01/1996", "02/01/1996").select("o_orderkey"))
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    assert "GreaterThanOrEqual(o_orderdate" in pushed and "LessThanOrEqual(o_orderdate" in pushed
    assert "o_totalprice" not in next(line for line in plan.splitlines() if "ReadSchema" in line)


def trips_frame(spark, n=400, seed=1):
    rng = random.Random(seed)
    start = dt.datetime(2019, 5, 1)
    data = [(start + dt.timedelta(minutes=rng.randrange(365 * 1440)),) for _ in range(n)]
    return spark.createDataFrame(data, "starttime timestamp_ntz")


@pytest.mark.parametrize("seed", range(4))
def test_month_counts_of_random_ranges_add_up(spark, seed):
    trips, rng = trips_frame(spark), random.Random(seed)
    days = sorted(dt.date(2019, 5, 1) + dt.timedelta(days=rng.randrange(365)) for _ in range(2))
    got = trip.trips_by_month(trips, *days).agg(F.sum("trip_count")).first()[0] or 0
    assert got == filters.date_range(trips, "starttime", *days).count()


def test_rollups_agree_with_trips(spark):
    trips = trips_frame(spark)
    raw = rows(trip.trips_by_month(trips))
    assert rows(trip.trips_by_month(trips, rollup=trip.daily_rollup(trips))) == raw
    assert rows(trip.month_rollup(trips).select("trip_count", "month")) == raw


def test_rollup_takes_in_the_last_day_of_a_range(spark):
    trips = spark.createDataFrame([(dt.datetime(2024, 1, 5, 0),), (dt.datetime(2024, 1, 5, 9),)], "starttime timestamp_ntz")
    bounds = ("2024-01-04", "2024-01-05")
    assert trip.trips_by_month(trips, *bounds).first()["trip_count"] == 1
    assert trip.trips_by_month(trips, *bounds, rollup=trip.daily_rollup(trips)).first()["trip_count"] == 2


def test_temperature_fan_out_nulls_and_rounding(spark):
    trips = spark.createDataFrame(
        [(dt.datetime(2024, 1, d, h),) for d, h in ((1, 1), (1, 23), (2, 5), (3, 5), (4, 0))], "starttime timestamp_ntz"
    )
    weather = spark.createDataFrame(
        [("NY", dt.date(2024, 1, 1), 25.0), ("NJ", dt.date(2024, 1, 1), 24.9), ("NY", dt.date(2024, 1, 2), -25.0), ("NY", dt.date(2024, 1, 3), None)],
        "state string, observation_date date, temp_avg_f double",
    ).withColumn("temp_avg_f", F.col("temp_avg_f").cast("decimal(5,1)"))
    got = [(None if r[0] is None else float(r[0]), r[1]) for r in trip.trips_by_temperature(trips, weather).collect()]
    assert got == [(None, 1), (-30.0, 1), (20.0, 2), (30.0, 2)]
    assert trip.trips_by_temperature(trips, weather, keep_unknown=False).count() == 3


def test_weekdays_start_on_sunday(spark):
    trips = spark.createDataFrame([(dt.datetime(2024, 3, d),) for d in (1, 2, 3, 3)], "starttime timestamp_ntz")
    assert [tuple(r) for r in trip.trips_by_weekday(trips).collect()] == [(2, "Sun"), (1, "Fri"), (1, "Sat")]
    assert trips.select(day_of_week("starttime")).distinct().count() == 3


def test_calendar_days_count_midnights(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23), dt.datetime(2024, 1, 2, 1))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(calendar_days("a", "b")).first()[0] == 1


def test_spine(spark):
    events = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5),), (dt.datetime(2024, 1, 4, 1),)], "t timestamp_ntz")
    who = spark.range(2)
    assert calendar_spine(who, events, "t").count() == 8
    assert calendar_spine(who, events, "t", include_last_day=False).count() == 6
    assert calendar_spine(who, events.limit(1), "t", include_last_day=False).count() == 0


def test_spine_needs_no_join(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = filters.plan_text(calendar_spine(events.select("user_id").distinct(), events, "ts"), "simple")
    assert "Join" not in plan and "CartesianProduct" not in plan


# Unions, ratios, profiles ------------------------------------------------------------------


def test_unions(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x")], "id int, n string")
    b = spark.createDataFrame([("x", 1, 2.0)], "n string, id int, extra double")
    assert union_distinct(a, a).count() == 1
    got = union_relations({"a": a, "b": b})
    assert got.columns == ["id", "n", "source_relation", "extra"] and got.count() == 3
    assert union_relations({"a": a, "b": b}, source=None).count() == 3


def test_ratio_sums_to_one_hundred(spark):
    df = spark.createDataFrame([("a", 1, 3), ("a", 2, 1), ("b", 1, 5)], "g string, k int, n int")
    assert ratio_to_report(df, "n", scale=100).agg(F.sum("ratio")).first()[0] == pytest.approx(100)
    by = ratio_to_report(df, "n", ["g"], scale=100).groupBy("g").agg(F.sum("ratio").alias("s"))
    assert all(r["s"] == pytest.approx(100) for r in by.collect())
    assert ratio_to_report(df.withColumn("n", F.lit(0)), "n").first()["ratio"] is None


def test_correlation_matrix(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 3))
    x[:, 1] += x[:, 0]
    data = [(*map(float, r), 1.0) for r in x] + [(None, 1.0, 2.0, 1.0)]
    df = spark.createDataFrame(data, "a double, b double, c double, same double")
    got = {r["column_name"]: r for r in profile.correlation_matrix(df).collect()}
    assert set(got) == {"a", "b", "c", "same"}
    assert got["a"]["b"] == pytest.approx(np.corrcoef(x[:, 0], x[:, 1])[0, 1])
    assert got["a"]["b"] == pytest.approx(got["b"]["a"], abs=1e-12) and got["c"]["c"] == pytest.approx(1)
    assert got["same"]["a"] is None and got["a"]["same"] is None


def test_histogram_keeps_empty_bins_and_closes_the_last(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (1.0,), (9.99,), (10.0,), (None,)], "v double")
    got = profile.histogram(df, ["v"], 10).orderBy("bin").collect()
    assert [r["row_count"] for r in got] == list(np.histogram([0, 0.5, 1, 9.99, 10], 10)[0])
    same = profile.histogram(spark.createDataFrame([(2.0,), (2.0,)], "v double"), ["v"], 4).orderBy("bin").collect()
    assert [r["row_count"] for r in same] == [2, 0, 0, 0]


def test_density_integrates_to_one(spark):
    rng = np.random.default_rng(1)
    data = rng.normal(size=500)
    got = profile.density(spark.createDataFrame([(float(v),) for v in data], "v double"), "v", 100).orderBy("grid_point").collect()
    x, y = np.array([r["position"] for r in got]), np.array([r["density"] for r in got])
    width = len(data) ** -0.2 * data.std(ddof=1)
    want = np.exp(-(((x[:, None] - data) / width) ** 2) / 2).sum(axis=1) / (len(data) * width * np.sqrt(2 * np.pi))
    assert y == pytest.approx(want)


def test_describe_and_profile(spark):
    df = spark.createDataFrame([(1, 2.0, "a"), (3, None, "b")], "i int, d double, s string")
    got = {r["column_name"]: r for r in profile.describe(df).collect()}
    assert set(got) == {"i", "d"} and got["i"]["stddev"] == pytest.approx(2**0.5) and got["d"]["count"] == 1
    assert rows(profile.table_profile(df)) == [
        (0, "i", "int", 2, 2), (1, "d", "double", 2, 1), (2, "s", "string", 2, 2)
    ]
    assert rows(profile.category_counts(df, ["s"])) == [("s", "a", 1), ("s", "b", 1)]


def test_hash_split_does_not_depend_on_partitioning(spark):
    df = spark.range(2000)
    part = F.when(hash_below(["id"], 101, 0.7), 1).otherwise(0).alias("p")
    one = rows(df.coalesce(1).select("id", part))
    assert one == rows(df.repartition(7).select("id", part))
    assert 0.65 < sum(r[1] for r in one) / 2000 < 0.75


# Quality -----------------------------------------------------------------------------------


def test_checks_pass_and_fail(spark):
    df = spark.createDataFrame([(1, "north"), (2, "south")], "id int, name string")
    checks = [quality.MetricCheck("small", "<", 2), quality.MetricCheck("no nulls", "=", 0, "name")]
    assert rows(quality.run_checks(df, checks)) == [("no nulls", "pass", 0), ("small", "fail", 2)]
    with pytest.raises(ValueError):
        quality.MetricCheck("x", "~", 1)


def test_schema_changes_warn(spark, tmp_path):
    before = spark.createDataFrame([(1, "a", 2.0)], "id int, name string, gone double")
    now = spark.createDataFrame([("a", 1, True)], "name string, id bigint, fresh boolean")
    quality.save_schema(before, str(tmp_path / "schema"))
    baseline = quality.load_schema(spark, str(tmp_path / "schema"))
    assert set(quality.schema_changes(baseline, now.schema)) == {
        ("gone", "removed"), ("fresh", "added"), ("id", "type"), ("id", "position"), ("name", "position")
    }
    assert rows(quality.check_schema(now, baseline)) == [("schema", "warn", 5)]
    assert rows(quality.check_schema(before, baseline)) == [("schema", "pass", 0)]


# Models ------------------------------------------------------------------------------------

BOOKING_ROWS = {
    "bookings_1": [(1, 11, "Park", "2021-03-19", 100), (1, 12, "Lake", "2021-03-20", 200), (1, 13, "Park", "2021-03-19", 600)],
    "bookings_2": [(2, 21, "Lake", "2021-03-19", 100), (2, 22, "Lake", "2021-03-20", 300), (9, 23, "Hill", "2021-03-20", 300)],
}


def seeds(spark):
    out = {
        name: spark.createDataFrame(data, "id int, booking_reference bigint, hotel string, day string, cost int").select(
            "id", "booking_reference", "hotel", F.to_date("day").alias("booking_date"), "cost"
        )
        for name, data in BOOKING_ROWS.items()
    }
    out["customers"] = spark.createDataFrame(
        [(1, "mira", "okoye", dt.date(1977, 5, 2), 5), (2, "tomas", "reyes", dt.date(1981, 11, 30), 6)],
        "id int, first_name string, last_name string, birthdate date, membership_no int",
    )
    return out


def test_models_run_in_dependency_order(spark):
    order = run_order(book.booking_models())
    assert order.index("combined_bookings") < order.index("prepped_data") < order.index("thirty_day_avg_cost")
    views = run_models(spark, book.booking_models(), seeds(spark), "t_")
    assert spark.table("t_prepped_data").columns == [
        "id", "first_name", "last_name", "birthdate", "booking_reference", "hotel", "booking_date", "cost"
    ]
    assert views["prepped_data"].count() == 5
    assert rows(views["hotel_count_by_day"].filter("hotel = 'Lake'").select("count_bookings")) == [(1,), (2,)]
    averages = [r["avg_cost_30"] for r in views["thirty_day_avg_cost"].orderBy("booking_date", "booking_reference").collect()]
    assert averages == pytest.approx([100, 350, 800 / 3, 250, 260])


def test_sql_models_become_views_in_their_schemas(spark):
    mat.overwrite_table(seeds(spark)["bookings_1"], "seed_bookings")
    models = [
        SqlModel("cost_by_hotel", ("prepared",), "SELECT hotel, SUM(cost) AS cost FROM {prepared} GROUP BY hotel", schema=" reports "),
        SqlModel("prepared", ("bookings",), "SELECT hotel, cost FROM {bookings} WHERE cost < 500"),
    ]
    names = publish_views(spark, models, {"bookings": "seed_bookings"}, "staging")
    assert names == {"cost_by_hotel": "reports.cost_by_hotel", "prepared": "staging.prepared"}
    assert rows(spark.table("reports.cost_by_hotel")) == [("Lake", 200), ("Park", 100)]
    publish_views(spark, models, {"bookings": "seed_bookings"}, "staging")
    for schema in ("reports", "staging"):
        spark.sql(f"DROP DATABASE {schema} CASCADE")
    mat.drop_table(spark, "seed_bookings")


def test_stored_rollups_answer_for_the_trips(spark):
    trips = trips_frame(spark)
    daily = mat.overwrite_table(trip.daily_rollup(trips), "count_by_day")
    monthly = mat.overwrite_table(trip.month_rollup(trips), "count_by_month")
    assert rows(trip.trips_by_month(trips, rollup=daily)) == rows(trip.trips_by_month(trips))
    stored = trip.trips_by_month_stored(monthly).collect()
    assert [r["starttime"] for r in stored] == sorted(r["starttime"] for r in stored)
    for name in ("count_by_day", "count_by_month"):
        mat.drop_table(spark, name)


def test_model_cycle_is_an_error():
    with pytest.raises(ValueError):
        run_order([Model("a", ("b",), lambda b: b), Model("b", ("a",), lambda a: a)])
