"""Ranges put together from rollups, against counts of the trips themselves."""

import datetime as dt
import random

import pytest
from conftest import rows
from hypothesis import given, settings, strategies as st

from tidemark.operators.filters import plan_text
from tidemark.plans.rollups import FIRST, LAST, Rollup, cover, month_counts, range_parts, stored_months, temperature_counts, weekday_counts
from tidemark.plans.trips import daily_rollup, trips_by_month, trips_by_temperature, trips_by_weekday

NEW_YEAR = dt.datetime(2023, 12, 25)
MOMENTS = st.datetimes(dt.datetime(2020, 1, 1), dt.datetime(2025, 1, 1))


def _ends(unit, moment):
    return moment.time() == dt.time() and (unit == "day" or moment.day == 1)


@given(MOMENTS, MOMENTS, MOMENTS, MOMENTS)
@settings(max_examples=300, deadline=None)
def test_parts_touch_and_are_whole(a, b, known_from, known_to):
    rollups = [Rollup("month", None, known_from, known_to), Rollup("day", None, known_from)]
    parts = cover(a, b, rollups)
    assert [p.low for p in parts[1:]] == [p.high for p in parts[:-1]]
    assert not parts if a >= b else (parts[0].low, parts[-1].high) == (a, b)
    for part in parts:
        assert part.low < part.high
        if part.rollup:
            assert _ends(part.rollup.unit, part.low) and _ends(part.rollup.unit, part.high)
            assert part.rollup.complete_from <= part.low and part.high <= part.rollup.complete_to
    # Nothing that a coarser part could answer is left to a finer one.
    raw = [p for p in parts if p.rollup is None and p.low >= known_from]
    assert all(p.high - p.low < dt.timedelta(days=2) for p in raw)
    days = [p for p in parts if p.rollup and p.rollup.unit == "day" and known_from <= p.low and p.high <= known_to]
    assert all(p.high - p.low < dt.timedelta(days=62) for p in days)


def test_no_bounds_need_the_coarsest_rollup_only():
    assert [(p.rollup.unit, p.low, p.high) for p in range_parts(None, None, [Rollup("month"), Rollup("day")])] == [("month", FIRST, LAST)]
    with pytest.raises(ValueError):
        range_parts("2024-01-01", None, [])


@pytest.fixture(scope="module")
def trips(spark):
    rng = random.Random(8)
    starts = [NEW_YEAR + dt.timedelta(microseconds=rng.randrange(100 * 86_400_000_000)) for _ in range(400)]
    starts += [dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1), dt.datetime(2024, 1, 31, 23, 59, 59, 999_999), None]
    return spark.createDataFrame([(s,) for s in starts], "starttime timestamp_ntz")


@pytest.fixture(scope="module")
def rollups(trips):
    days = daily_rollup(trips)
    return [Rollup("month", stored_months(days)), Rollup("day", days)]


RANGES = [
    (None, None), ("2024-01-01", "2024-01-31"), ("2024-01-01 00:00:00", "2024-02-01 00:00:00"),
    ("2024-01-31 23:59:59.999999", "2024-01-31 23:59:59.999999"), ("2023-12-30 11:22:33.444", "2024-03-17 01:02:03.000004"),
    ("2024-03-01", "2024-02-01"), ("12/01/2023", "04/30/2024"), (dt.date(2024, 1, 5), dt.datetime(2024, 1, 5, 13)),
]


@pytest.mark.parametrize("start, end", RANGES)
def test_counts_equal_those_of_the_trips(spark, trips, rollups, start, end):
    weather = spark.createDataFrame(
        [(s, (NEW_YEAR + dt.timedelta(days=d)).date(), None if d % 9 == 0 else d * 1.3 - 20) for s in "ab" for d in range(0, 100, 2)],
        "state string, observation_date date, temp_avg_f double",
    )
    assert rows(month_counts(trips, rollups, start, end)) == rows(trips_by_month(trips, start, end))
    assert rows(weekday_counts(trips, rollups, start, end)) == rows(trips_by_weekday(trips, start, end))
    assert rows(temperature_counts(trips, weather, rollups, start, end)) == rows(trips_by_temperature(trips, weather, start, end))


def test_incomplete_rollups_leave_the_rest_to_the_trips(trips):
    known = trips.filter("starttime < timestamp_ntz'2024-02-10 12:00:00'")
    at = dt.datetime(2024, 2, 10, 12)
    rollups = [Rollup("month", stored_months(known), complete_to=at), Rollup("day", daily_rollup(known), complete_to=at)]
    for bounds in RANGES[1:]:
        assert rows(month_counts(trips, rollups, *bounds)) == rows(trips_by_month(trips, *bounds))


def test_edges_reach_the_scans(spark, trips, rollups, tmp_path):
    stored = []
    for name, frame in (("trips", trips), ("months", rollups[0].frame), ("days", rollups[1].frame)):
        frame.write.parquet(str(tmp_path / name))
        stored.append(spark.read.parquet(str(tmp_path / name)))
    raw, months, days = stored
    counts = month_counts(raw, [Rollup("month", months), Rollup("day", days)], "2023-12-30 11:22:33", "2024-03-17 01:02:03")
    scans = [line for line in plan_text(counts).splitlines() if "PushedFilters" in line]
    assert len(scans) == 5      # a raw edge and days on each side of the months
    assert all("GreaterThanOrEqual(starttime" in s and "LessThan(starttime" in s for s in scans)
    assert any("2023-12-30T11:22:33" in s and "2023-12-31T00:00" in s for s in scans)
    assert any("2024-01-01T00:00" in s and "2024-03-01T00:00" in s for s in scans)
