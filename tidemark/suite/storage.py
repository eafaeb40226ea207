"""Loading and storing: the given tables go out through a sink and come back through a source.

Files and tables get new names under the session's shared folder on every run.
"""

from __future__ import annotations

import datetime as dt
import posixpath
import uuid

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from tidemark.operators import materialise as mat, quality
from tidemark.operators.filters import apply_filters
from tidemark.plans.features import feature_table
from tidemark.plans.models import SqlModel, publish_views
from tidemark.plans.rollups import Rollup, month_counts, stored_months, temperature_counts, weekday_counts
from tidemark.plans.trips import daily_rollup, month_rollup, trips_by_month, trips_by_month_stored, trips_by_weekday
from tidemark.sources import files, schemas, tables
from tidemark.sources.filestore import copy_store, query_store
from tidemark.sources.samples import SampleTables
from tidemark.streaming.refresh import compact, read_rollup, refresh_daily_rollup, refresh_rollup
from tidemark.suite.base import query
from tidemark.suite.reports import _WORKOUT, FILTERS
from tidemark.suite.sqltext import BOOKINGS, MEMBERS, TX, WEATHER, features


def _new(t: SampleTables, name: str) -> tuple[str, str]:
    """A table name and a folder nobody has used."""
    name = f"tidemark_{name}_{uuid.uuid4().hex}"
    return name, posixpath.join(mat.shared_folder(t.spark), name)


@query(
    "headerless_csv_load",
    f"WITH {TX} SELECT * EXCLUDE (tx_during_weekend, tx_during_night, tx_amount), CAST(tx_amount AS DOUBLE) AS tx_amount FROM tx",
)
def headerless_csv_load(t: SampleTables) -> DataFrame:
    _, folder = _new(t, "csv")
    mat.write_csv(t.transactions(), folder, header=False, compression="gzip")
    return files.read_headerless_csv(t.spark, folder, schemas.TRANSACTIONS)


@query(
    "bulk_load_sorted_table",
    """SELECT o_orderkey AS tripduration, o_orderdate AS starttime, o_orderdate + INTERVAL 1 HOUR AS stoptime,
           o_custkey AS start_station_id, o_custkey AS end_station_id, o_orderkey AS bikeid, o_orderpriority AS usertype,
           NULL::BIGINT AS birth_year, NULL::BIGINT AS gender FROM orders""",
)
def bulk_load_sorted_table(t: SampleTables) -> DataFrame:
    _, folder = _new(t, "stage")
    trips = t.table("orders").select(
        F.col("o_orderkey").alias("a"), F.col("o_orderdate").alias("b"),
        (F.col("o_orderdate") + F.expr("INTERVAL 1 HOUR")).alias("c"), F.col("o_custkey").alias("d"),
        F.col("o_custkey").alias("e"), F.col("o_orderkey").alias("f"), F.col("o_orderpriority").alias("g"),
        F.lit(None).cast("bigint").alias("h"), F.lit(None).cast("bigint").alias("i"),
    )
    mat.write_csv(trips, f"{folder}/trips", compression="gzip")
    mat.write_csv(t.table("nation"), f"{folder}/other")      # not matched by the pattern
    name, path = _new(t, "trips")
    return mat.write_sorted(files.load_directory(t.spark, folder, schemas.TRIPS, "*.csv.gz"), name, "starttime", path=path)


@query(
    "seed_view",
    f"WITH {BOOKINGS} SELECT * FROM bookings_1",
)
def seed_view(t: SampleTables) -> DataFrame:
    name, folder = _new(t, "seed")
    mat.write_csv(t.bookings()["bookings_1"], folder)
    schema = "id BIGINT, booking_reference BIGINT, hotel STRING, booking_date DATE, cost BIGINT"
    files.load_seed(t.spark, folder, schema, view=name)
    return tables.table(t.spark, name)


_SEED_TYPES = {
    "bookings_1": "id BIGINT, booking_reference BIGINT, hotel STRING, booking_date DATE, cost BIGINT",
    "bookings_2": "cost BIGINT, booking_date DATE, hotel STRING, booking_reference BIGINT, id BIGINT",
    "customers": "id BIGINT, first_name STRING, last_name STRING, birthdate DATE",
}


@query(
    "all_seed_views",
    f"WITH {BOOKINGS} SELECT id, first_name, last_name, birthdate, booking_reference, hotel, booking_date, cost FROM prepped",
)
def all_seed_views(t: SampleTables) -> DataFrame:
    """All three seeds go out as CSV, come back as views and are joined by SQL text."""
    views = {}
    for seed, frame in {**t.bookings(), "customers": t.booking_customers()}.items():
        views[seed], folder = _new(t, seed)
        mat.write_csv(frame.select(StructType.fromDDL(_SEED_TYPES[seed]).names), folder)
        files.load_seed(t.spark, folder, _SEED_TYPES[seed], view=views[seed])
    fields = "id, booking_reference, hotel, booking_date, cost"
    return tables.run_sql(
        t.spark,
        "SELECT c.id, first_name, last_name, birthdate, booking_reference, hotel, booking_date, cost "
        f"FROM {views['customers']} c JOIN (SELECT {fields} FROM {views['bookings_1']} "
        f"UNION ALL SELECT {fields} FROM {views['bookings_2']}) b ON b.id = c.id",
    )


@query("inferred_table", "SELECT CAST(s_suppkey AS INTEGER) AS s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def inferred_table(t: SampleTables) -> DataFrame:
    name, folder = _new(t, "inferred")
    mat.write_csv(t.table("supplier"), f"{folder}-in")
    return files.read_inferred_csv(t.spark, f"{folder}-in", name, folder)


@query("created_and_filled_table", "SELECT n_nationkey, n_name FROM nation UNION ALL SELECT s_nationkey, s_name FROM supplier")
def created_and_filled_table(t: SampleTables) -> DataFrame:
    name, folder = _new(t, "created")
    tables.create_table(t.spark, name, "code INT, label STRING", path=folder)
    tables.insert_rows(t.spark, name, t.table("nation").select("n_nationkey", "n_name"))
    tables.insert_rows(t.spark, name, t.table("supplier").select("s_nationkey", "s_name"))
    return tables.table(t.spark, name).select(F.col("code").alias("n_nationkey"), F.col("label").alias("n_name"))


@query(
    "replaced_table_of_literals",
    """SELECT n_name, zone FROM nation JOIN (VALUES (0, 'south'), (1, 'west'), (2, 'east'), (3, NULL)) z(code, zone)
    ON n_regionkey = code""",
)
def replaced_table_of_literals(t: SampleTables) -> DataFrame:
    """A table is created, replaced by one of another type, filled with literal rows and joined; another is dropped."""
    name, folder = _new(t, "zones")
    tables.create_table(t.spark, name, "zone STRING", path=f"{folder}-old")
    tables.create_table(t.spark, name, "code INT, zone STRING", replace=True, path=folder)
    tables.insert_rows(t.spark, name, [(0, "south"), (1, "west")])
    more = tables.rows_frame(t.spark, [(2, "east"), (3, None)], "code INT, zone STRING")
    tables.insert_rows(t.spark, name, more)
    mat.overwrite_table(more, f"{name}_scratch", path=f"{folder}-scratch")
    mat.drop_table(t.spark, f"{name}_scratch")
    mat.drop_table(t.spark, f"{name}_scratch")
    zones = tables.table(t.spark, name)
    return t.table("nation").join(zones, F.col("n_regionkey") == F.col("code")).select("n_name", "zone")


@query(
    "published_catalog_views",
    """SELECT o_orderpriority AS hotel, COUNT(*) AS bookings, CAST(SUM(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cost
    FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1""",
)
def published_catalog_views(t: SampleTables) -> DataFrame:
    """SQL models become catalog views, each in its own schema or in the default one."""
    name, folder = _new(t, "orders")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents")
    mat.overwrite_table(t.table("orders").select("o_orderpriority", "o_orderstatus", cents), name, path=folder)
    models = [
        SqlModel("hotel_cost", ("closed",), "SELECT hotel, COUNT(*) AS bookings, SUM(cents) AS cost FROM {closed} GROUP BY hotel",
                 schema=" tidemark_reports "),
        SqlModel("closed", ("orders",), "SELECT o_orderpriority AS hotel, cents FROM {orders} WHERE o_orderstatus <> 'P'"),
    ]
    return tables.table(t.spark, publish_views(t.spark, models, {"orders": name}, "tidemark_staging")["hotel_cost"])


@query(
    "metric_and_schema_checks",
    """SELECT 'has rows' AS check_name, CASE WHEN COUNT(*) > 0 THEN 'pass' ELSE 'fail' END AS outcome, COUNT(*) AS value FROM supplier
    UNION ALL SELECT 'same columns', 'pass', 0
    UNION ALL SELECT 'as last stored', 'warn', 4
    UNION ALL SELECT 'all named', 'pass', COUNT(*) FILTER (s_name IS NULL) FROM supplier""",
)
def metric_and_schema_checks(t: SampleTables) -> DataFrame:
    """Stored schemas as baselines, beside metrics of the same table: one column new, one of another type, two moved."""
    _, folder = _new(t, "schemas")
    now = t.table("supplier").select("s_suppkey", "s_name", "s_nationkey")
    quality.save_schema(now, f"{folder}/same")
    before = now.select("s_name", F.col("s_suppkey").cast("string").alias("s_suppkey"))
    quality.save_schema(before, f"{folder}/old")
    same, old = (quality.load_schema(t.spark, f"{folder}/{part}") for part in ("same", "old"))
    return quality.run_checks(
        now,
        [
            quality.MetricCheck("has rows", ">", 0), quality.SchemaCheck("same columns", same),
            quality.SchemaCheck("as last stored", old), quality.MetricCheck("all named", "=", 0, "s_name"),
        ],
    )


_STORED_DAY = "SELECT COUNT(*) AS n, date_trunc('day', o_orderdate) AS day FROM orders GROUP BY 2"


@query(
    "trips_by_month_from_stored_days",
    f"""WITH d AS ({_STORED_DAY}) SELECT CAST(SUM(n) AS BIGINT) AS trip_count, strftime(day, '%b') AS month FROM d
    WHERE day BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1998-12-31' GROUP BY month(day), 2""",
)
def trips_by_month_from_stored_days(t: SampleTables) -> DataFrame:
    name, folder = _new(t, "days")
    stored = mat.overwrite_table(daily_rollup(t.trips()), name, path=folder)
    return trips_by_month(t.trips(), "01/01/1996", "12/31/1998", rollup=stored)


@query(
    "trips_by_month_from_stored_months",
    """SELECT COUNT(*) AS trip_count, strftime(o_orderdate, '%b') AS month, min(o_orderdate) AS starttime
    FROM orders GROUP BY 2 ORDER BY starttime""",
)
def trips_by_month_from_stored_months(t: SampleTables) -> DataFrame:
    name, folder = _new(t, "months")
    return trips_by_month_stored(mat.overwrite_table(month_rollup(t.trips()), name, path=folder))


def _rollups(t: SampleTables, trips: DataFrame, **complete) -> list[Rollup]:
    """Stored months and days of the trips; the months are added up from the days."""
    name, folder = _new(t, "days")
    days = mat.overwrite_table(daily_rollup(trips), name, path=folder)
    name, folder = _new(t, "months")
    return [Rollup("month", mat.overwrite_table(stored_months(days), name, path=folder), **complete), Rollup("day", days, **complete)]


_BY_MONTH = "SELECT COUNT(*) AS trip_count, strftime({ts}, '%b') AS month FROM {table} {where} GROUP BY month({ts}), 2"
_LONG_RANGE = ("1994-02-17 00:00:01", "1998-11-30 23:59:59")
_TIMED_RANGE = ("2024-01-03 07:13:21.5", "2024-01-27 18:45:09.25")


def _between(column: str, bounds: tuple[str, str]) -> str:
    return f"WHERE {column} BETWEEN TIMESTAMP '{bounds[0]}' AND TIMESTAMP '{bounds[1]}'"


@query("trips_by_month_cover", _BY_MONTH.format(ts="o_orderdate", table="orders", where=_between("o_orderdate", _LONG_RANGE)))
def trips_by_month_cover(t: SampleTables) -> DataFrame:
    """Whole months, the days around them and two raw edges; no rollup is named."""
    return month_counts(t.trips(), _rollups(t, t.trips()), *_LONG_RANGE)


@query("trips_by_month_cover_all", _BY_MONTH.format(ts="o_orderdate", table="orders", where=""))
def trips_by_month_cover_all(t: SampleTables) -> DataFrame:
    return month_counts(t.trips(), _rollups(t, t.trips()))


@query("trips_by_month_cover_stale", _BY_MONTH.format(ts="o_orderdate", table="orders", where=_between("o_orderdate", _LONG_RANGE)))
def trips_by_month_cover_stale(t: SampleTables) -> DataFrame:
    """The rollups were stored in the middle of June 1997; later times come from the trips."""
    stored = dt.datetime(1997, 6, 15, 11)
    known = t.trips().filter(F.col("starttime") < F.lit(str(stored)).cast("timestamp_ntz"))
    return month_counts(t.trips(), _rollups(t, known, complete_to=stored), *_LONG_RANGE)


@query("timed_trips_by_month_cover", _BY_MONTH.format(ts="ts", table="events", where=_between("ts", _TIMED_RANGE)))
def timed_trips_by_month_cover(t: SampleTables) -> DataFrame:
    return month_counts(t.timed_trips(), _rollups(t, t.timed_trips()), *_TIMED_RANGE)


@query(
    "trips_by_weekday_cover",
    f"SELECT COUNT(*) AS trip_count, strftime(ts, '%a') AS day_of_week FROM events {_between('ts', _TIMED_RANGE)} GROUP BY 2",
)
def trips_by_weekday_cover(t: SampleTables) -> DataFrame:
    return weekday_counts(t.timed_trips(), _rollups(t, t.timed_trips()), *_TIMED_RANGE)


@query(
    "trips_by_temperature_cover",
    f"""WITH {WEATHER} SELECT round(temp_avg_f, -1) AS temp, COUNT(*) AS trip_count
    FROM orders JOIN weather ON date_trunc('day', o_orderdate) = observation_date {_between("o_orderdate", _LONG_RANGE)} GROUP BY 1""",
)
def trips_by_temperature_cover(t: SampleTables) -> DataFrame:
    return temperature_counts(t.trips(), t.weather(), _rollups(t, t.trips()), *_LONG_RANGE)


@query("stored_feature_table", f"WITH {features(False)} SELECT * FROM features")
def stored_feature_table(t: SampleTables) -> DataFrame:
    name, folder = _new(t, "features")
    return mat.write_sorted(feature_table(t.transactions(), per_one=100), name, "tx_datetime", path=folder)


_STORE_SQL = """SELECT o_orderkey, o_orderdate, o_orderpriority, o_totalprice FROM {source}
    WHERE o_orderdate >= TIMESTAMP_NTZ'1996-03-01 00:00:00' AND o_orderdate < TIMESTAMP_NTZ'1996-06-01 00:00:00'
    AND o_orderstatus IN ('F', 'P') AND o_totalprice > 1000"""
_STORE_CHECK = _STORE_SQL.replace("TIMESTAMP_NTZ", "TIMESTAMP ").replace("{source}", "orders")


def _order_store(t: SampleTables) -> tuple[str, StructType]:
    """All orders as a store outside the catalog, laid out by date."""
    _, folder = _new(t, "store")
    orders = t.table("orders")
    laid = orders.repartitionByRange(8, "o_orderdate", "o_orderkey").sortWithinPartitions("o_orderdate")
    laid.write.option("parquet.block.size", 1 << 20).parquet(folder)
    return folder, orders.schema


@query("store_pushed_query", _STORE_CHECK)
def store_pushed_query(t: SampleTables) -> DataFrame:
    """A connector read whose filters the source answers."""
    return query_store(t.spark, *_order_store(t), _STORE_SQL)


@query("store_copy", _STORE_CHECK)
def store_copy(t: SampleTables) -> DataFrame:
    name, folder = _new(t, "copied")
    return copy_store(t.spark, *_order_store(t), _STORE_SQL, name, folder)


@query("table_snapshot", "SELECT * FROM customer")
def table_snapshot(t: SampleTables) -> DataFrame:
    name, folder = _new(t, "customers")
    mat.overwrite_table(t.table("customer"), name, path=folder)
    return mat.snapshot(t.spark, name, path=f"{folder}-snapshot")[1]


@query("checkpoint_and_resume", "SELECT p_partkey, p_brand, p_retailprice * 2 AS doubled FROM part")
def checkpoint_and_resume(t: SampleTables) -> DataFrame:
    _, folder = _new(t, "checkpoint")
    frame = t.table("part").select("p_partkey", "p_brand", (F.col("p_retailprice") * 2).alias("doubled"))
    mat.checkpoint_frame(frame, folder)
    return files.read_checkpoint(t.spark, folder)


@query("csv_export", f"WITH {MEMBERS} SELECT * FROM members WHERE {_WORKOUT}")
def csv_export(t: SampleTables) -> DataFrame:
    _, folder = _new(t, "export")
    members = apply_filters(t.members(), FILTERS)
    mat.write_csv(members, folder)
    return t.spark.read.schema(members.schema).option("header", True).csv(folder)


@query(
    "weekday_counts_as_json",
    """SELECT '{"trip_count":' || COUNT(*) || ',"day_of_week":"' || strftime(o_orderdate, '%a') || '"}' AS value
    FROM orders GROUP BY strftime(o_orderdate, '%a')""",
)
def weekday_counts_as_json(t: SampleTables) -> DataFrame:
    return mat.json_rows(trips_by_weekday(t.trips()))


@query(
    "incremental_trip_rollup",
    "SELECT COUNT(*) AS trip_count, date_trunc('day', ts)::TIMESTAMP AS starttime FROM events GROUP BY 2",
)
def incremental_trip_rollup(t: SampleTables) -> DataFrame:
    """Trips arrive in two loads, by kind of trip; each load is followed by a refresh."""
    _, folder = _new(t, "arrivals")
    trips = t.timed_trips()
    early = F.col("usertype").isin("view", "click")
    for part in (trips.filter(early), trips.filter(~early)):
        part.write.mode("append").parquet(f"{folder}/in")
        refresh_daily_rollup(t.spark, f"{folder}/in", trips.schema, f"{folder}/rollup", f"{folder}/progress")
    return read_rollup(t.spark, f"{folder}/rollup")


@query(
    "incremental_month_rollup",
    """SELECT COUNT(*) AS trip_count, strftime(o_orderdate, '%b') AS month, min(o_orderdate) AS starttime
    FROM orders GROUP BY 2""",
)
def incremental_month_rollup(t: SampleTables) -> DataFrame:
    """Trips arrive with the latest years first; the rollup is compacted after the second of three loads."""
    _, folder = _new(t, "month_arrivals")
    trips, year = t.trips(), F.year("starttime")
    for number, part in enumerate((year >= 1997, year.between(1994, 1996), F.coalesce(year < 1994, F.lit(True)))):
        trips.filter(part).write.mode("append").parquet(f"{folder}/in")
        refresh_rollup(t.spark, f"{folder}/in", trips.schema, f"{folder}/rollup", f"{folder}/progress", "month")
        if number == 1:
            compact(t.spark, f"{folder}/rollup", "month")
    return read_rollup(t.spark, f"{folder}/rollup", "month").select("trip_count", "month", "starttime")
