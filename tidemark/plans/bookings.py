"""Booking reports: combined seeds joined to customers, counts, and a moving average."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.running import CHUNK_ROWS, moving_average, order_key
from tidemark.operators.sets import union_relations
from tidemark.plans.models import Model

AVERAGE_ROWS = 30


def combined_bookings(relations: Mapping[str, DataFrame]) -> DataFrame:
    return union_relations(relations)


def customer(customers: DataFrame) -> DataFrame:
    return customers.select("id", "first_name", "last_name", "birthdate")


def prepped_data(customers: DataFrame, bookings: DataFrame) -> DataFrame:
    return customers.join(bookings, "id").select(
        "id", "first_name", "last_name", "birthdate", "booking_reference", "hotel", "booking_date", "cost"
    )


def hotel_count_by_day(prepped: DataFrame) -> DataFrame:
    return prepped.groupBy("booking_date", "hotel").agg(F.count("id").alias("count_bookings"))


def average_cost(
    prepped: DataFrame, by_hotel: bool = False, rows: int = AVERAGE_ROWS, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Cost, its average over the last 30 bookings, and the difference.

    Bookings are ordered by date, then by their reference, which makes ties on a date definite.
    """
    order = ["booking_date", "booking_reference"]
    averaged = moving_average(
        prepped, "cost", rows, order,
        key=order_key(prepped, *order),
        by=["hotel"] if by_hotel else [],
        alias="avg_cost_30", chunk_rows=chunk_rows,
    )
    cost = F.col("cost").cast("double")
    return averaged.select(
        "booking_date", "hotel", "booking_reference", cost.alias("cost"),
        "avg_cost_30", (cost - F.col("avg_cost_30")).alias("diff_from_avg"),
    )


def booking_models() -> list[Model]:
    """The report's models with what each is built from; seeds are given from outside."""
    return [
        Model(
            "combined_bookings", ("bookings_1", "bookings_2"),
            lambda bookings_1, bookings_2: combined_bookings({"bookings_1": bookings_1, "bookings_2": bookings_2}),
        ),
        Model("customer", ("customers",), lambda customers: customer(customers)),
        Model(
            "prepped_data", ("customer", "combined_bookings"),
            lambda customer, combined_bookings: prepped_data(customer, combined_bookings),
        ),
        Model("hotel_count_by_day", ("prepped_data",), lambda prepped_data: hotel_count_by_day(prepped_data)),
        Model("thirty_day_avg_cost", ("prepped_data",), lambda prepped_data: average_cost(prepped_data)),
    ]
