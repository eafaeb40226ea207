"""Counts over any range of time, put together from stored rollups and as few raw rows as possible.

A range is split into whole periods of the coarsest rollup, the periods of finer rollups on both sides
of them, and what is left at the two edges, which only the trips themselves can answer.  The
split is arithmetic on the bounds; every part becomes a literal range on the stored times, so
each one reaches its file scan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import as_bound, as_moment, day_name, day_of_week, day_start, month_name, month_start
from tidemark.operators.filters import Bound
from tidemark.operators.joins import join_by_day

FIRST, LAST = dt.datetime.min, dt.datetime.max
_INSTANT = dt.timedelta(microseconds=1)


def _next_month(day: dt.datetime) -> dt.datetime:
    return LAST if (day.year, day.month) == (9999, 12) else (day.replace(day=28) + dt.timedelta(days=4)).replace(day=1)


#: What a unit does to a time: back to the start of its period, on to the start of the next one.
_UNITS: dict[str, tuple[Callable, Callable]] = {
    "day": (
        lambda t: t.replace(hour=0, minute=0, second=0, microsecond=0),
        lambda t: t + dt.timedelta(days=1) if t < LAST - dt.timedelta(days=1) else LAST,
    ),
    "month": (lambda t: t.replace(day=1, hour=0, minute=0, second=0, microsecond=0), _next_month),
}


@dataclass(frozen=True)
class Rollup:
    """``trip_count`` per period of a ``unit``, whose start is ``starttime``.

    It answers for times from ``complete_from`` up to but without ``complete_to``: periods that were not
    yet over when it was stored, or that have been dropped from it, are left to finer parts.
    """

    unit: str                      # "day" or "month"
    frame: DataFrame | None = None
    complete_from: dt.datetime = FIRST
    complete_to: dt.datetime = LAST


@dataclass(frozen=True)
class Part:
    """A half-open piece of a range and the rollup that answers it; None stands for the trips."""

    rollup: Rollup | None
    low: dt.datetime
    high: dt.datetime


def cover(low: dt.datetime, high: dt.datetime, rollups: Sequence[Rollup]) -> list[Part]:
    """``low <= time < high`` as parts in time order that touch and never overlap; coarsest rollup first."""
    if low >= high:
        return []
    if not rollups:
        return [Part(None, low, high)]
    coarsest, finer = rollups[0], rollups[1:]
    start, step = _UNITS[coarsest.unit]
    from_, to = max(low, coarsest.complete_from), min(high, coarsest.complete_to)
    from_ = from_ if from_ == start(from_) else step(start(from_))
    to = to if to == LAST else start(to)
    if from_ >= to:
        return cover(low, high, finer)
    return [*cover(low, from_, finer), Part(coarsest, from_, to), *cover(to, high, finer)]


def stored_months(trips: DataFrame) -> DataFrame:
    """Trips per calendar month, from trips or from their daily rollup."""
    count = F.sum("trip_count") if "trip_count" in trips.columns else F.count(F.lit(1))
    return trips.groupBy(month_start("starttime").alias("starttime")).agg(count.alias("trip_count"))


def range_parts(start: Bound, end: Bound, rollups: Sequence[Rollup]) -> list[Part]:
    """The parts of ``start <= time <= end``; without bounds, of all times."""
    if start is None and end is None:
        return cover(FIRST, LAST, rollups)
    if start is None or end is None:
        raise ValueError("a date range needs both a start and an end")
    return cover(as_moment(start), as_moment(end) + _INSTANT, rollups)


def counts_in_range(
    trips: DataFrame, rollups: Sequence[Rollup], start: Bound = None, end: Bound = None
) -> DataFrame:
    """``starttime`` (the start of a period, none longer than the coarsest rollup's) and ``trip_count``.

    ``rollups`` go from the coarsest to the finest.  Raw edges are counted per day.  Both bounds belong to
    the range, which may begin and end at any microsecond.  Times are stored to the microsecond, so
    the end bound is the half-open range up to the next one.  Without bounds, times that are null count
    too, as one period without a start.
    """
    found = []
    for part in range_parts(start, end, rollups):
        source = trips if part.rollup is None else part.rollup.frame
        if part.low != FIRST:
            source = source.filter(F.col("starttime") >= as_bound(part.low))
        if part.high != LAST:
            source = source.filter(F.col("starttime") < as_bound(part.high))
        if part.rollup is None:
            source = source.groupBy(day_start("starttime").alias("starttime")).agg(F.count(F.lit(1)).alias("trip_count"))
        found.append(source.select("starttime", "trip_count"))
    if not found:
        return trips.select("starttime", F.lit(0).cast("long").alias("trip_count")).limit(0)
    return reduce(DataFrame.unionAll, found)


def month_counts(trips: DataFrame, rollups: Sequence[Rollup], start: Bound = None, end: Bound = None) -> DataFrame:
    """Trips per calendar month over all years, in month order, by the cheapest parts."""
    return (
        counts_in_range(trips, rollups, start, end)
        .groupBy(F.month("starttime").alias("month_number"), month_name("starttime").alias("month"))
        .agg(F.sum("trip_count").alias("trip_count"))
        .orderBy("month_number")
        .select("trip_count", "month")
    )


def _days_only(rollups: Sequence[Rollup]) -> list[Rollup]:
    return [r for r in rollups if r.unit == "day"]


def weekday_counts(trips: DataFrame, rollups: Sequence[Rollup], start: Bound = None, end: Bound = None) -> DataFrame:
    """Trips per weekday, Sunday first; rollups of longer periods than a day do not serve here."""
    return (
        counts_in_range(trips, _days_only(rollups), start, end)
        .groupBy(day_of_week("starttime").alias("day_number"), day_name("starttime").alias("day_of_week"))
        .agg(F.sum("trip_count").alias("trip_count"))
        .orderBy("day_number")
        .select("trip_count", "day_of_week")
    )


def temperature_counts(
    trips: DataFrame, weather: DataFrame, rollups: Sequence[Rollup], start: Bound = None, end: Bound = None
) -> DataFrame:
    """Trips per ten degrees; a trip counts once for every weather row of its day."""
    days = counts_in_range(trips, _days_only(rollups), start, end).groupBy("starttime").agg(F.sum("trip_count").alias("trip_count"))
    return (
        join_by_day(days, "starttime", weather, "observation_date")
        .groupBy(F.round("temp_avg_f", -1).alias("temp"))
        .agg(F.sum("trip_count").alias("trip_count"))
        .orderBy("temp")
    )
