"""Time-window features of card transactions.

Customer behaviour: number and mean amount of a customer's transactions over the last 1, 7 and
30 days, up to and including the current moment.  Terminal risk: share of frauds at a terminal
over windows that end ``delay`` days ago, because frauds become known that late.

The features are defined on a dense calendar (one row per entity and day).  No such calendar is
built here: transactions are aggregated to the days that occur, and windows run over day numbers,
which gives the same values because absent days add nothing.  Whole transactions are exchanged
twice: by moment, to meet the customer's totals up to it, and by terminal-day, to meet the risk.  All
other exchanges carry aggregated rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions import from_units, is_night, is_weekend, whole_units
from tidemark.operators.joins import calendar_spine, spine_bounds, spine_totals
from tidemark.operators.running import running_totals
from tidemark.operators.skew import heavy_keys, skew_join

WINDOWS = (1, 7, 30)
DELAY = 7
CUSTOMER_DAY = ["customer_id", "tx_date"]

KEYS = ["transaction_id", "tx_datetime", "customer_id", "terminal_id"]
INPUT_FEATURES = [
    "tx_amount", "tx_during_weekend", "tx_during_night",
    *[f"{c}_{w}" for w in WINDOWS for c in ("cust_cnt_tx", "cust_avg_amount")],
    *[f"{c}_{w}" for w in WINDOWS for c in ("nb_tx_window", "term_risk")],
]


def with_time_flags(tx: DataFrame) -> DataFrame:
    return tx.withColumns(
        {"tx_during_weekend": is_weekend("tx_datetime"), "tx_during_night": is_night("tx_datetime")}
    )


def _day_number() -> Column:
    return F.unix_date("tx_date")


def _paid() -> Column:
    """1 for a transaction with a positive amount."""
    return F.when(F.col("tx_amount") > 0, F.lit(1)).otherwise(F.lit(0)).cast("long")


def customer_daily(tx: DataFrame, per_one: int | None = None) -> DataFrame:
    """Amount and number of paid transactions per customer and day that occurs.

    With ``per_one`` (here and below) amounts are summed in whole minor units, see
    ``whole_units``.
    """
    amount = whole_units(F.coalesce("tx_amount", F.lit(0)), per_one)
    return tx.groupBy("customer_id", F.to_date("tx_datetime").alias("tx_date")).agg(
        F.sum(amount).alias("tot_amount"), F.sum(_paid()).alias("no_trx")
    )


def terminal_daily(tx: DataFrame) -> DataFrame:
    """Frauds and labelled transactions per terminal and day that occurs."""
    return tx.groupBy("terminal_id", F.to_date("tx_datetime").alias("tx_date")).agg(
        F.sum(F.coalesce("tx_fraud", F.lit(0))).alias("nb_fraud"), F.count("tx_fraud").alias("no_trx")
    )


def dense_customer_daily(
    tx: DataFrame, include_last_day: bool = True, per_one: int | None = None
) -> DataFrame:
    """Customer totals on every day of the calendar, 0 where nothing happened."""
    spine = calendar_spine(tx.select("customer_id").distinct(), tx, "tx_datetime", include_last_day=include_last_day)
    return spine_totals(spine, customer_daily(tx, per_one), ["customer_id", "tx_date"], ["tot_amount", "no_trx"])


def dense_terminal_daily(tx: DataFrame, include_last_day: bool = True) -> DataFrame:
    spine = calendar_spine(tx.select("terminal_id").distinct(), tx, "tx_datetime", include_last_day=include_last_day)
    return spine_totals(spine, terminal_daily(tx), ["terminal_id", "tx_date"], ["nb_fraud", "no_trx"])


def customer_day_windows(dense: DataFrame, windows: Sequence[int] = (7, 30)) -> DataFrame:
    """Previous-day value and trailing sums, today excluded, on dense daily totals.

    One window partition holds the days of one customer, so its size is the calendar's.
    """
    days = Window.partitionBy("customer_id").orderBy("tx_date")
    columns = {
        "cust_tx_prev_1": F.lag("no_trx", 1).over(days),
        "cust_tot_amt_prev_1": F.lag("tot_amount", 1).over(days),
    }
    for w in windows:
        frame = days.rowsBetween(-w, -1)
        columns[f"cust_tx_prev_{w}"] = F.sum("no_trx").over(frame)
        columns[f"cust_tot_amt_prev_{w}"] = F.sum("tot_amount").over(frame)
    return dense.select("*", *[c.alias(n) for n, c in columns.items()])


def _reach(window: int, delay: int, literal: bool) -> int:
    """Length in days of the delayed frame; the literal variant gives week and day one frame."""
    return delay + (1 if literal and window == 7 else window)


def terminal_day_windows(
    dense: DataFrame, windows: Sequence[int] = WINDOWS, delay: int = DELAY, literal_reference: bool = False
) -> DataFrame:
    """Sums over the delay and over delay plus window, today excluded, on dense daily totals."""
    days = Window.partitionBy("terminal_id").orderBy("tx_date")
    columns = {
        "nb_fraud_delay": F.sum("nb_fraud").over(days.rowsBetween(-delay, -1)),
        "nb_tx_delay": F.sum("no_trx").over(days.rowsBetween(-delay, -1)),
    }
    for w in windows:
        frame = days.rowsBetween(-_reach(w, delay, literal_reference), -1)
        columns[f"nb_tx_delay_window_{w}"] = F.sum("no_trx").over(frame)
        columns[f"nb_fraud_delay_window_{w}"] = F.sum("nb_fraud").over(frame)
    return dense.select("*", *[c.alias(n) for n, c in columns.items()])


def day_moments(tx: DataFrame, per_one: int | None = None) -> DataFrame:
    """Number and amount of a customer's transactions of the day up to each moment that occurs.

    ``tx`` has ``tx_date``.  Transactions of one moment are added up first, then the moments of one second
    and last the seconds of a day, so a task sees at most the moments of one second or the seconds of
    one customer-day, however many transactions share a customer, a day or a moment.  A null customer is
    a customer of its own without a number of transactions, as ``customer_id`` is what is counted.
    """
    second = F.hour("tx_datetime") * 3600 + F.minute("tx_datetime") * 60 + F.second("tx_datetime")
    moments = tx.groupBy(*CUSTOMER_DAY, "tx_datetime").agg(
        F.count("customer_id").alias("n"),
        F.count("tx_amount").alias("known"),
        F.coalesce(F.sum(whole_units("tx_amount", per_one)), F.lit(0)).alias("amount"),
    )
    totals = running_totals(moments.withColumn("second", second), "tx_datetime", ["n", "known", "amount"], CUSTOMER_DAY, "second")
    return totals.select(
        *CUSTOMER_DAY, "tx_datetime", F.col("running_n").alias("cur_day_trx"),
        F.when(F.col("running_known") > 0, F.col("running_amount")).alias("cur_day_amt"),
    )


def with_day_so_far(
    tx: DataFrame, day_features: DataFrame | None = None, per_one: int | None = None
) -> DataFrame:
    """Add the number and amount of a customer's transactions of the day up to each one.

    Transactions at the same moment count each other.  Totals are worked out per moment
    (``day_moments``) and joined back, an equi-join that adaptive execution can split.
    ``day_features`` (one row per customer and day) are joined to the moments on the way, which
    drops transactions of days they lack and those without a customer.
    """
    dated = tx.withColumn("tx_date", F.to_date("tx_datetime"))
    moments = day_moments(dated, per_one)
    if day_features is not None:
        moments = moments.join(day_features, CUSTOMER_DAY)
    # Structs of equal fields are equal, nulls included.
    key = F.struct(*CUSTOMER_DAY, "tx_datetime").alias("__moment")
    added = moments.select(key, *[c for c in moments.columns if c not in (*CUSTOMER_DAY, "tx_datetime")])
    return dated.withColumn("__moment", key).join(added, "__moment").drop("__moment")


def customer_days(
    tx: DataFrame, windows: Sequence[int] = WINDOWS, per_one: int | None = None
) -> DataFrame:
    """Number and amount of paid transactions in the windows before each customer-day that occurs."""
    by_day = Window.partitionBy("customer_id").orderBy(_day_number())
    columns = []
    for w in windows:
        frame = by_day.rangeBetween(-w, -1)
        columns += [
            F.coalesce(F.sum("no_trx").over(frame), F.lit(0)).alias(f"prev_n_{w}"),
            F.coalesce(F.sum("tot_amount").over(frame), F.lit(0)).alias(f"prev_amount_{w}"),
        ]
    return customer_daily(tx, per_one).select("customer_id", "tx_date", *columns)


def with_customer_behaviour(
    rows: DataFrame, history: DataFrame, windows: Sequence[int] = WINDOWS, per_one: int | None = None
) -> DataFrame:
    """Add the behaviour features to ``rows``; ``history`` holds all transactions."""
    current = with_day_so_far(rows, customer_days(history, windows, per_one), per_one)
    features = {}
    for w in windows:
        count = F.col(f"prev_n_{w}") + F.col("cur_day_trx")
        amount = F.col(f"prev_amount_{w}") + F.col("cur_day_amt")
        features[f"cust_cnt_tx_{w}"] = count
        features[f"cust_avg_amount_{w}"] = from_units(amount, per_one) / count
    previous = [f"prev_{c}_{w}" for c in ("n", "amount") for w in windows]
    return current.withColumns(features).drop("cur_day_trx", "cur_day_amt", *previous)


def terminal_days(
    tx: DataFrame, windows: Sequence[int] = WINDOWS, delay: int = DELAY, literal_reference: bool = False
) -> DataFrame:
    """Risk features per terminal and day: counts and fraud share in windows ``delay`` days back.

    On the first day of the data there is no history at all: counts are null and the risk is 0.
    """
    first_day, _ = spine_bounds(tx, "tx_datetime")
    by_day = Window.partitionBy("terminal_id").orderBy(_day_number())
    columns = []
    for w in windows:
        frame = by_day.rangeBetween(-_reach(w, delay, literal_reference), -(delay + 1))
        columns += [
            F.coalesce(F.sum("no_trx").over(frame), F.lit(0)).alias(f"n_{w}"),
            F.coalesce(F.sum("nb_fraud").over(frame), F.lit(0)).alias(f"fraud_{w}"),
        ]
    has_history = (F.col("tx_date") > first_day).alias("has_history")
    return terminal_daily(tx).select("terminal_id", "tx_date", has_history, *columns).select(
        "terminal_id",
        "tx_date",
        *[F.when(F.col("has_history"), F.col(f"n_{w}")).alias(f"nb_tx_window_{w}") for w in windows],
        *[
            F.when(F.col(f"fraud_{w}") > 0, F.col(f"fraud_{w}") / F.col(f"n_{w}")).otherwise(F.lit(0.0))
            .alias(f"term_risk_{w}")
            for w in windows
        ],
    )


def feature_table(
    tx: DataFrame,
    windows: Sequence[int] = WINDOWS,
    delay: int = DELAY,
    include_last_day: bool = True,
    literal_reference: bool = False,
    per_one: int | None = None,
) -> DataFrame:
    """Transactions with time flags, customer behaviour and terminal risk.

    ``include_last_day=False`` leaves out transactions of the last day of the data, as a
    calendar with one row per crossed midnight does.  ``literal_reference`` lets the 7-day
    terminal window use the 1-day frame.
    """
    _, last_day = spine_bounds(tx, "tx_datetime")
    rows = with_time_flags(tx)
    if not include_last_day:
        rows = rows.filter(F.col("tx_datetime") < last_day.cast("timestamp_ntz"))
    risk = terminal_days(tx, windows, delay, literal_reference)
    terminal_day = ["terminal_id", "tx_date"]
    # The risk already lies by terminal, so days of a terminal with very many transactions are salted.
    heavy = heavy_keys(tx.select("terminal_id", F.to_date("tx_datetime").alias("tx_date")), terminal_day)
    joined = skew_join(with_customer_behaviour(rows, tx, windows, per_one), risk, terminal_day, heavy=heavy)
    return joined.select(
        *KEYS, "tx_time_seconds", "tx_time_days", F.col("tx_amount").cast("double").alias("tx_amount"),
        "tx_fraud", "tx_fraud_scenario", "tx_during_weekend", "tx_during_night",
        *[f"{c}_{w}" for w in windows for c in ("cust_avg_amount", "cust_cnt_tx")],
        *[f"{c}_{w}" for w in windows for c in ("nb_tx_window", "term_risk")],
    )
