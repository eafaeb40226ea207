"""Trip counts and their rollups."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import day_of_week, day_start, random_day_range, random_days
from tidemark.operators.distinct import count_ids, id_parts, numbered
from tidemark.operators.joins import join_by_day
from tidemark.operators.materialise import cut_lineage
from tidemark.plans import trips as trip
from tidemark.sources.samples import SampleTables
from tidemark.suite.base import query
from tidemark.suite.sqltext import WEATHER

FROM, TO = "01/01/1996", "12/31/1998"                 # MM/DD/YYYY as a user types them
RANGE_SQL = "BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1998-12-31'"
TIMED_FROM, TIMED_TO = "2024-01-05", "2024-01-20"
TIMED_SQL = "BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20'"

_DAY = "SELECT COUNT(*) AS trip_count, date_trunc('day', {ts})::TIMESTAMP AS starttime FROM {table} GROUP BY 2"
_MONTHS = "SELECT {count} AS trip_count, strftime({ts}, '%b') AS month FROM {table} {where} GROUP BY month({ts}), 2"


@query("daily_trip_rollup", _DAY.format(ts="ts", table="events"))
def daily_trip_rollup(t: SampleTables) -> DataFrame:
    return trip.daily_rollup(t.timed_trips())


@query(
    "month_trip_rollup",
    """SELECT COUNT(*) AS trip_count, strftime(o_orderdate, '%b') AS month, min(o_orderdate) AS starttime
    FROM orders GROUP BY 2""",
)
def month_trip_rollup(t: SampleTables) -> DataFrame:
    return trip.month_rollup(t.trips())


@query("trips_by_month", _MONTHS.format(count="COUNT(*)", ts="o_orderdate", table="orders", where=""))
def trips_by_month(t: SampleTables) -> DataFrame:
    return trip.trips_by_month(t.trips())


@query(
    "trips_by_month_in_range",
    _MONTHS.format(count="COUNT(*)", ts="o_orderdate", table="orders", where=f"WHERE o_orderdate {RANGE_SQL}"),
)
def trips_by_month_in_range(t: SampleTables) -> DataFrame:
    return trip.trips_by_month(t.trips(), FROM, TO)


@query(
    "trips_by_month_stored_rollup",
    """SELECT COUNT(*) AS trip_count, strftime(o_orderdate, '%b') AS month, min(o_orderdate) AS starttime
    FROM orders GROUP BY 2 ORDER BY starttime""",
)
def trips_by_month_stored_rollup(t: SampleTables) -> DataFrame:
    return trip.trips_by_month_stored(trip.month_rollup(t.trips()))


@query(
    "trips_by_month_from_daily_rollup",
    "WITH d AS (" + _DAY.format(ts="o_orderdate", table="orders") + ") "
    + _MONTHS.format(count="CAST(SUM(trip_count) AS BIGINT)", ts="starttime", table="d", where=f"WHERE starttime {RANGE_SQL}"),
)
def trips_by_month_from_daily_rollup(t: SampleTables) -> DataFrame:
    trips = t.trips()
    return trip.trips_by_month(trips, FROM, TO, rollup=trip.daily_rollup(trips))


@query(
    "timed_trips_by_month_in_range",
    _MONTHS.format(count="COUNT(*)", ts="ts", table="events", where=f"WHERE ts {TIMED_SQL}"),
)
def timed_trips_by_month_in_range(t: SampleTables) -> DataFrame:
    return trip.trips_by_month(t.timed_trips(), TIMED_FROM, TIMED_TO)


@query(
    "timed_trips_by_month_from_daily_rollup",
    "WITH d AS (" + _DAY.format(ts="ts", table="events") + ") "
    + _MONTHS.format(count="CAST(SUM(trip_count) AS BIGINT)", ts="starttime", table="d", where=f"WHERE starttime {TIMED_SQL}"),
)
def timed_trips_by_month_from_daily_rollup(t: SampleTables) -> DataFrame:
    trips = t.timed_trips()
    return trip.trips_by_month(trips, TIMED_FROM, TIMED_TO, rollup=trip.daily_rollup(trips))


_WEEK = "SELECT COUNT(*) AS trip_count, strftime({ts}, '%a') AS day_of_week FROM {table} {where} GROUP BY 2"


@query("trips_by_weekday", _WEEK.format(ts="o_orderdate", table="orders", where=""))
def trips_by_weekday(t: SampleTables) -> DataFrame:
    return trip.trips_by_weekday(t.trips())


@query("trips_by_weekday_in_range", _WEEK.format(ts="ts", table="events", where=f"WHERE ts {TIMED_SQL}"))
def trips_by_weekday_in_range(t: SampleTables) -> DataFrame:
    return trip.trips_by_weekday(t.timed_trips(), TIMED_FROM, TIMED_TO)


_TEMP = f"""WITH {WEATHER}, weather_trips AS (
      SELECT * FROM orders t JOIN weather w ON date_trunc('day', t.o_orderdate) = w.observation_date)
    SELECT round(temp_avg_f, -1) AS temp, COUNT(*) AS trip_count FROM weather_trips {{where}} GROUP BY 1"""


@query("trips_by_temperature", _TEMP.format(where=""))
def trips_by_temperature(t: SampleTables) -> DataFrame:
    return trip.trips_by_temperature(t.trips(), t.weather())


@query("trips_by_temperature_in_range", _TEMP.format(where=f"WHERE o_orderdate {RANGE_SQL}"))
def trips_by_temperature_in_range(t: SampleTables) -> DataFrame:
    return trip.trips_by_temperature(t.trips(), t.weather(), FROM, TO)


@query("trips_by_known_temperature", _TEMP.format(where="WHERE temp_avg_f IS NOT NULL"))
def trips_by_known_temperature(t: SampleTables) -> DataFrame:
    return trip.trips_by_temperature(t.trips(), t.weather(), keep_unknown=False)


@query(
    "trip_weather_rows",
    f"""WITH {WEATHER} SELECT o_orderdate AS starttime, o_custkey AS bikeid, state, temp_avg_f
    FROM orders t JOIN weather w ON date_trunc('day', t.o_orderdate) = w.observation_date""",
)
def trip_weather_rows(t: SampleTables) -> DataFrame:
    return join_by_day(t.trips(), "starttime", t.weather(), "observation_date").select(
        "starttime", "bikeid", "state", "temp_avg_f"
    )


@query(
    "trip_days_and_counts",
    """SELECT date_trunc('day', ts)::TIMESTAMP AS day, CAST(dayofweek(ts) AS INTEGER) AS weekday,
    COUNT(*) AS trip_count FROM events GROUP BY 1, 2""",
)
def trip_days_and_counts(t: SampleTables) -> DataFrame:
    return t.timed_trips().groupBy(
        day_start("starttime").alias("day"), day_of_week("starttime").alias("weekday")
    ).agg(F.count(F.lit(1)).alias("trip_count"))


@query(
    "riders_by_month_from_days",
    "SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, COUNT(DISTINCT o_custkey) AS riders FROM orders GROUP BY 1",
)
def riders_by_month_from_days(t: SampleTables) -> DataFrame:
    """Distinct bikes per month, from bitmaps stored per day."""
    days = cut_lineage(id_parts(t.trips(), [F.to_date("starttime").alias("day")], "bikeid"))
    return count_ids(days, [F.to_date(F.date_trunc("month", "day")).alias("month")], "riders")


@query(
    "rider_names_by_year_from_months",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, COUNT(DISTINCT c_name) AS riders
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
)
def rider_names_by_year_from_months(t: SampleTables) -> DataFrame:
    """Distinct texts per year, numbered once, from bitmaps stored per month."""
    names = t.table("customer").select(F.col("c_custkey").alias("bikeid"), F.col("c_name").alias("name"))
    numbers = cut_lineage(numbered(names, "name"))
    named = t.trips().join(names, "bikeid").join(numbers, "name")
    months = cut_lineage(id_parts(named, [F.trunc(F.to_date("starttime"), "month").alias("month")], "number"))
    return count_ids(months, [F.year("month").alias("year")], "riders")


# Random ranges: days drawn by (seed, request), the earlier one first ------------------------

SEED, EARLIEST, LATEST = 2020, dt.date(1995, 5, 1), dt.date(1998, 5, 1)


def _drawn_sql(key: str, draw: int) -> str:
    digits = f"('0x' || substr(md5('{SEED}|{draw}|' || {key}), 1, 13))::BIGINT"
    return f"CAST(DATE '{EARLIEST}' + CAST(floor({digits} / 4503599627370496.0::DOUBLE * {(LATEST - EARLIEST).days + 1}) AS INTEGER) AS DATE)"


@query(
    "random_request_ranges",
    f"""SELECT c_custkey AS request, strftime(least({_drawn_sql("c_custkey", 0)}, {_drawn_sql("c_custkey", 1)}), '%m/%d/%Y') AS start_range,
    strftime(greatest({_drawn_sql("c_custkey", 0)}, {_drawn_sql("c_custkey", 1)}), '%m/%d/%Y') AS end_range FROM customer""",
)
def random_request_ranges(t: SampleTables) -> DataFrame:
    """One random range per request, as a user would type it."""
    requests = t.table("customer").select(F.col("c_custkey").alias("request"))
    drawn = requests.withColumn("r", random_days(SEED, EARLIEST, LATEST, "request"))
    return drawn.select(
        "request", F.date_format("r.start_day", "MM/dd/yyyy").alias("start_range"), F.date_format("r.end_day", "MM/dd/yyyy").alias("end_range")
    )


@query(
    "trips_by_month_random_range",
    _MONTHS.format(
        count="COUNT(*)", ts="o_orderdate", table="orders",
        where=f"""WHERE o_orderdate BETWEEN least({_drawn_sql("'7'", 0)}, {_drawn_sql("'7'", 1)})
        AND greatest({_drawn_sql("'7'", 0)}, {_drawn_sql("'7'", 1)})""",
    ),
)
def trips_by_month_random_range(t: SampleTables) -> DataFrame:
    """The counts of request 7, whose bounds are drawn before the scan."""
    return trip.trips_by_month(t.trips(), *random_day_range(SEED, EARLIEST, LATEST, 7))
