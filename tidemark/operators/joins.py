"""Joins and the calendar spine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def calendar_spine(
    entities: DataFrame, events: DataFrame, ts: str, alias: str = "tx_date", include_last_day: bool = True
) -> DataFrame:
    """One row per entity and day between the first and last day of ``events``.

    Without ``include_last_day`` the calendar has as many days as midnights were crossed, which
    leaves out the last day.  The days are generated beside each entity row, in the task that
    holds it: no join, no shuffle.
    """
    first, last = spine_bounds(events, ts)
    end = last if include_last_day else F.date_sub(last, 1)
    days = F.when(end >= first, F.sequence(first, end)).otherwise(F.array().cast("array<date>"))
    return entities.select("*", F.explode(days).alias(alias))


def spine_bounds(events: DataFrame, ts: str) -> tuple[Column, Column]:
    """First and last day of the events, as scalar subqueries."""
    bounds = events.agg(F.struct(F.min(ts).alias("first"), F.max(ts).alias("last")).alias("b")).scalar()
    return F.to_date(bounds["first"]), F.to_date(bounds["last"])


def spine_totals(
    spine: DataFrame, daily: DataFrame, keys: Sequence[str], zero: Sequence[str]
) -> DataFrame:
    """Daily totals on every spine row, with 0 where an entity had no events that day.

    ``daily`` is already aggregated to the keys, so the join never sees single events.
    """
    return spine.join(daily, list(keys), "left").withColumns(
        {c: F.coalesce(c, F.lit(0)) for c in zero}
    )


def without(df: DataFrame, excluded: DataFrame, on) -> DataFrame:
    """Rows of ``df`` with no partner in ``excluded``."""
    return df.join(excluded, on, "left_anti")


def join_by_day(facts: DataFrame, ts: str, dimension: DataFrame, day: str, how: str = "inner") -> DataFrame:
    """Facts joined to every dimension row of their day."""
    return facts.join(dimension, F.to_date(ts) == F.col(day), how)
