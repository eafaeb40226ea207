"""Trip counts by month, weekday and temperature."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import day_name, day_of_week, day_start, month_name
from tidemark.operators.filters import Bound, date_range
from tidemark.operators.joins import join_by_day


def daily_rollup(trips: DataFrame) -> DataFrame:
    """Trips per day; small enough to keep as a summary table."""
    return trips.groupBy(day_start("starttime").alias("starttime")).agg(
        F.count(F.lit(1)).alias("trip_count")
    )


def month_rollup(trips: DataFrame) -> DataFrame:
    """Trips per month name with the first start seen."""
    return trips.groupBy(month_name("starttime").alias("month")).agg(
        F.count(F.lit(1)).alias("trip_count"), F.min("starttime").alias("starttime")
    )


def trips_by_month(
    trips: DataFrame, start: Bound = None, end: Bound = None, rollup: DataFrame | None = None
) -> DataFrame:
    """Trips per calendar month over all years, in month order.

    With a daily ``rollup`` the counts are summed from it.  Its times are midnights, so an end
    bound at midnight then takes in that whole day, while the trips themselves stop there.
    """
    source, count = (trips, F.count(F.lit(1))) if rollup is None else (rollup, F.sum("trip_count"))
    return (
        date_range(source, "starttime", start, end)
        .groupBy(F.month("starttime").alias("month_number"), month_name("starttime").alias("month"))
        .agg(count.alias("trip_count"))
        .orderBy("month_number")
        .select("trip_count", "month")
    )


def trips_by_month_stored(rollup: DataFrame) -> DataFrame:
    """The month rollup as it is, in order of first start."""
    return rollup.orderBy("starttime")


def trips_by_weekday(trips: DataFrame, start: Bound = None, end: Bound = None) -> DataFrame:
    """Trips per weekday, Sunday first."""
    return (
        date_range(trips, "starttime", start, end)
        .groupBy(day_of_week("starttime").alias("day_number"), day_name("starttime").alias("day_of_week"))
        .agg(F.count(F.lit(1)).alias("trip_count"))
        .orderBy("day_number")
        .select("trip_count", "day_of_week")
    )


def trips_by_temperature(
    trips: DataFrame, weather: DataFrame, start: Bound = None, end: Bound = None, keep_unknown: bool = True
) -> DataFrame:
    """Trips per ten degrees; a trip counts once for every weather row of its day.

    Trips are counted per day before they meet the weather, so the join sees days, not trips.
    ``keep_unknown=False`` drops the bucket of days without a temperature.
    """
    per_day = daily_rollup(date_range(trips, "starttime", start, end))
    out = (
        join_by_day(per_day, "starttime", weather, "observation_date")
        .groupBy(F.round("temp_avg_f", -1).alias("temp"))
        .agg(F.sum("trip_count").alias("trip_count"))
        .orderBy("temp")
    )
    return out if keep_unknown else out.filter(F.col("temp").isNotNull())
