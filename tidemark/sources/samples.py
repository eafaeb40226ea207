"""Shapes the given star-schema tables into the relations the jobs work on.

Every relation is a projection of whole tables: nothing is sampled, capped or thinned out.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions import seconds_since, whole_units

ORIGIN = dt.date(2024, 1, 1)          # day 0 of the transaction clock
BOOKING_CUT = dt.date(1998, 7, 1)     # first booking day of the second booking relation
FRAUD_AMOUNT = 100

# Categories that a customer's key decides: name, customers per step, values in turn.
CREDIT_CATEGORIES = (
    ("other_parties", 1, ("none", "none", "none", "guarantor", "co applicant")),
    ("assets", 2, ("real estate", "life insurance", "car", "no known property")),
    ("qualification", 3, ("skilled", "unskilled", "high qualif/self emp/mgmt")),
    ("sex", 5, ("female", "male")),
    ("marital_status", 7, ("single", "married", "divorced")),
    ("other_payment_plans", 11, ("None", "bank", "stores", "None")),
)
# Whole numbers that a customer's key decides: name, smallest value, factor, number of values.
CREDIT_NUMBERS = (
    ("credit_duration", 6, 13, 55), ("installment_commitment", 1, 1, 4), ("credit_score", 300, 7919, 551),
    ("existing_credits", 1, 3, 5), ("job_history", 0, 17, 31), ("num_dependents", 0, 5, 4), ("residence_since", 1, 7, 12),
)


class SampleTables:
    """Lazy relations over one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def transactions(self) -> DataFrame:
        """Card transactions: one per event."""
        fraud = (F.col("event_type") == "error") & (F.col("value") > FRAUD_AMOUNT)
        flag = F.when(fraud, F.lit(1)).otherwise(F.lit(0)).cast("long")
        return self.table("events").select(
            F.col("event_id").alias("transaction_id"),
            F.col("ts").alias("tx_datetime"),
            F.col("user_id").alias("customer_id"),
            F.get_json_object("props", "$.k").cast("long").alias("terminal_id"),
            F.col("value").alias("tx_amount"),
            seconds_since(ORIGIN, "ts").alias("tx_time_seconds"),
            F.datediff(F.to_date("ts"), F.lit(ORIGIN)).cast("long").alias("tx_time_days"),
            flag.alias("tx_fraud"),
            flag.alias("tx_fraud_scenario"),
        )

    def trips(self) -> DataFrame:
        """Trips over several years, all starting at midnight: one per order."""
        return self.table("orders").select(
            F.col("o_orderdate").alias("starttime"),
            F.col("o_custkey").alias("bikeid"),
            F.col("o_orderstatus").alias("usertype"),
        )

    def timed_trips(self) -> DataFrame:
        """Trips over one month with time of day: one per event."""
        return self.table("events").select(
            F.col("ts").alias("starttime"),
            F.col("user_id").alias("bikeid"),
            F.col("event_type").alias("usertype"),
        )

    def weather(self) -> DataFrame:
        """Daily temperature per state, in whole tenths of a degree.

        Several states share a day, and a day with one reading has no temperature.
        """
        tenths = F.expr("sum(cast(l_quantity as bigint)) * 10 div count(1)")
        return (
            self.table("lineitem")
            .groupBy(
                F.col("l_returnflag").alias("state"),
                F.to_date("l_shipdate").alias("observation_date"),
            )
            .agg(
                F.when(F.count(F.lit(1)) > 1, tenths.cast("double") / 10.0).alias("temp_avg_f")
            )
        )

    def bookings(self) -> dict[str, DataFrame]:
        """Two booking relations (different column order) that together hold every order.

        The cost is in whole cents.
        """
        orders = self.table("orders")
        columns = [
            F.col("o_custkey").alias("id"),
            F.col("o_orderkey").alias("booking_reference"),
            F.col("o_orderpriority").alias("hotel"),
            F.to_date("o_orderdate").alias("booking_date"),
            whole_units("o_totalprice").alias("cost"),
        ]
        early = F.col("o_orderdate") < F.lit(str(BOOKING_CUT)).cast("timestamp_ntz")
        return {
            "bookings_1": orders.filter(early).select(*columns),
            "bookings_2": orders.filter(~early).select(*reversed(columns)),
        }

    def booking_customers(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("id"),
            F.col("c_mktsegment").alias("first_name"),
            F.col("c_name").alias("last_name"),
            F.date_add(F.lit(dt.date(1970, 1, 1)), F.col("c_nationkey")).alias("birthdate"),
            F.col("c_custkey").alias("membership_no"),
        )

    def credit_files(self) -> DataFrame:
        """Credit requests, one per customer: nine categories and twelve numbers.

        Nation, region and segment are categories as they are; the others follow from the customer's key.
        """
        key = F.col("c_custkey")
        derived = [F.get(F.array(*map(F.lit, values)), (key / step).cast("long") % len(values)).alias(name) for name, step, values in CREDIT_CATEGORIES]
        return (
            self.table("customer")
            .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                key.alias("credit_request_id"), F.col("c_acctbal").alias("credit_amount"),
                *[(F.lit(low) + key * factor % width).cast("int").alias(name) for name, low, factor, width in CREDIT_NUMBERS],
                F.col("c_nationkey").alias("age"), (F.col("c_acctbal") - 500).alias("checking_balance"),
                (F.abs("c_acctbal") / 2).alias("savings_balance"),
                F.col("c_mktsegment").alias("purpose"), F.col("r_name").alias("credit_standing"), F.col("n_name").alias("housing"),
                *derived,
            )
        )

    def spend(self) -> DataFrame:
        """Yearly spend with four predictors: one row per order line."""
        return self.table("lineitem").select(
            "l_orderkey",
            "l_linenumber",
            F.col("l_extendedprice").alias("spent"),
            F.col("l_quantity").alias("session_length"),
            F.col("l_discount").alias("time_on_app"),
            F.col("l_tax").alias("time_on_website"),
            F.col("l_linenumber").cast("double").alias("membership_length"),
        )

    def members(self) -> DataFrame:
        """Customers of the filter report."""
        return self.table("customer").select(
            F.col("c_custkey").alias("member_id"),
            (F.col("c_mktsegment") == "BUILDING").alias("is_current_customer"),
            F.col("c_nationkey").alias("years_tenure"),
            F.floor(F.col("c_acctbal") / 1000).cast("int").alias("average_weekly_workout_count"),
        )

