"""Booking reports."""

from __future__ import annotations

import posixpath
import uuid
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.materialise import cut_lineage, shared_folder
from tidemark.operators.running import order_key, with_position
from tidemark.plans import bookings as book
from tidemark.plans.models import run_changed, run_models
from tidemark.sources.samples import SampleTables
from tidemark.suite.base import query
from tidemark.suite.sqltext import BOOKINGS


def _prepped(t: SampleTables) -> DataFrame:
    return book.prepped_data(book.customer(t.booking_customers()), book.combined_bookings(t.bookings()))


@query("combined_bookings", f"WITH {BOOKINGS} SELECT * FROM combined")
def combined_bookings(t: SampleTables) -> DataFrame:
    return book.combined_bookings(t.bookings())


@query("booking_customers", f"WITH {BOOKINGS} SELECT * FROM customers")
def booking_customers(t: SampleTables) -> DataFrame:
    return book.customer(t.booking_customers())


@query("prepped_bookings", f"WITH {BOOKINGS} SELECT * FROM prepped")
def prepped_bookings(t: SampleTables) -> DataFrame:
    return _prepped(t)


@query(
    "hotel_count_by_day",
    f"WITH {BOOKINGS} SELECT booking_date, hotel, COUNT(id) AS count_bookings FROM prepped GROUP BY booking_date, hotel",
)
def hotel_count_by_day(t: SampleTables) -> DataFrame:
    return book.hotel_count_by_day(_prepped(t))


_AVERAGE = """SELECT booking_date, hotel, booking_reference, CAST(cost AS DOUBLE) AS cost,
       CAST(SUM(cost) OVER w AS DOUBLE) / COUNT(cost) OVER w AS avg_cost_30,
       CAST(cost AS DOUBLE) - CAST(SUM(cost) OVER w AS DOUBLE) / COUNT(cost) OVER w AS diff_from_avg
FROM prepped WINDOW w AS ({partition} ORDER BY booking_date, booking_reference ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)"""


@query("moving_average_cost", f"WITH {BOOKINGS} " + _AVERAGE.format(partition=""))
def moving_average_cost(t: SampleTables) -> DataFrame:
    return book.average_cost(_prepped(t))


@query("moving_average_cost_by_hotel", f"WITH {BOOKINGS} " + _AVERAGE.format(partition="PARTITION BY hotel"))
def moving_average_cost_by_hotel(t: SampleTables) -> DataFrame:
    return book.average_cost(_prepped(t), by_hotel=True)


@query(
    "booking_row_numbers",
    f"""WITH {BOOKINGS} SELECT booking_reference, row_number() OVER (ORDER BY booking_date, booking_reference) - 1 AS position
    FROM combined""",
)
def booking_row_numbers(t: SampleTables) -> DataFrame:
    combined = book.combined_bookings(t.bookings())
    order = ["booking_date", "booking_reference"]
    return with_position(combined, order, order_key(combined, *order)).select("booking_reference", "position")


@query("booking_model_run", f"WITH {BOOKINGS} " + _AVERAGE.format(partition=""))
def booking_model_run(t: SampleTables) -> DataFrame:
    seeds = {**t.bookings(), "customers": t.booking_customers()}
    return run_models(t.spark, book.booking_models(), seeds, "tidemark_")["thirty_day_avg_cost"]


_SHARED = "combined_bookings prepped_data hotel_count_by_day thirty_day_avg_cost".split()
_CHANGED_SQL = " UNION ALL ".join(
    f"""SELECT {run}::INTEGER AS run, '{model}' AS model, {built} AS built, (SELECT COUNT(*) FROM {source}{where}) AS row_count"""
    for run, rebuilt in ((1, [*_SHARED, "customer"]), (2, []), (3, _SHARED))
    for model, source in (
        ("combined_bookings", "combined"), ("customer", "customers"), ("prepped_data", "prepped"), ("thirty_day_avg_cost", "prepped"),
        ("hotel_count_by_day", "(SELECT DISTINCT booking_date, hotel FROM prepped WHERE {})"),
    )
    for built in ("true" if model in rebuilt else "false",)
    for late in ("booking_date < DATE '1998-07-01'" if run == 3 else "true",)
    for source, where in ((source.format(late), "") if "{}" in source else (source, "" if source == "customers" else f" WHERE {late}"),)
)


@query("booking_models_rebuilt", f"WITH {BOOKINGS} {_CHANGED_SQL}")
def booking_models_rebuilt(t: SampleTables) -> DataFrame:
    """Which models three runs build: a first one, one without changes, and one after the second seed was emptied."""
    folder = posixpath.join(shared_folder(t.spark), f"tidemark_models_{uuid.uuid4().hex}")
    seeds = {**{n: cut_lineage(df) for n, df in t.bookings().items()}, "customers": cut_lineage(t.booking_customers())}
    emptied = {**seeds, "bookings_2": cut_lineage(seeds["bookings_2"].limit(0))}
    found = []
    for run, given in enumerate((seeds, seeds, emptied), 1):
        frames, built = run_changed(t.spark, book.booking_models(), given, folder)
        found += [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(run).alias("run"), F.lit(name).alias("model"), F.lit(name in built).alias("built"), "row_count"
            )
            for name, df in frames.items()
        ]
    return reduce(DataFrame.unionAll, found)
