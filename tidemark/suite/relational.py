"""One query per relational building block."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions import (
    as_bound, as_date_bound, calendar_days, day_name, day_of_week, day_start, from_units, iff, is_night, is_weekend,
    month_name, parse_us_date, ratio_to_report, row_json, row_object, whole_units, zero_if_null,
)
from tidemark.operators.filters import date_range, numeric_columns
from tidemark.operators.joins import without
from tidemark.operators.profile import correlation
from tidemark.operators.sets import union_distinct, union_relations
from tidemark.operators.skew import skew_join
from tidemark.operators.topk import top_k
from tidemark.sources.samples import SampleTables
from tidemark.sources.tables import run_sql
from tidemark.suite.base import query

# Sources -----------------------------------------------------------------------------------


@query("table_scan", "SELECT * FROM nation")
def table_scan(t: SampleTables) -> DataFrame:
    return t.table("nation")


@query("sql_text_query", "SELECT o_orderstatus, COUNT(*) AS n FROM orders GROUP BY o_orderstatus")
def sql_text_query(t: SampleTables) -> DataFrame:
    t.table("orders").createOrReplaceTempView("tidemark_orders")
    return run_sql(t.spark, "SELECT o_orderstatus, COUNT(*) AS n FROM tidemark_orders GROUP BY o_orderstatus")


@query(
    "sql_bound_range",
    """SELECT COUNT(*) AS n, min(o_orderkey) AS first_key FROM orders
    WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-12-31'""",
)
def sql_bound_range(t: SampleTables) -> DataFrame:
    t.table("orders").createOrReplaceTempView("tidemark_orders")
    return run_sql(
        t.spark,
        """SELECT COUNT(*) AS n, min(o_orderkey) AS first_key FROM tidemark_orders
        WHERE o_orderdate BETWEEN to_timestamp_ntz(?, 'MM/dd/yyyy') AND to_timestamp_ntz(?, 'MM/dd/yyyy')""",
        ["01/01/1996", "12/31/1996"],
    )


# Projections -------------------------------------------------------------------------------


@query("project_columns", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def project_columns(t: SampleTables) -> DataFrame:
    return t.table("customer").select("c_custkey", "c_name", "c_mktsegment")


@query(
    "replace_columns",
    """SELECT o_orderkey, o_totalprice * 2 AS o_totalprice, o_totalprice + 1 AS raised, o_custkey FROM orders""",
)
def replace_columns(t: SampleTables) -> DataFrame:
    # Both expressions see the column as it was before the replacement.
    rows = t.table("orders").withColumns(
        {"o_totalprice": F.col("o_totalprice") * 2, "raised": F.col("o_totalprice") + 1}
    )
    return rows.select("o_orderkey", "o_totalprice", "raised", "o_custkey")


@query("rename_and_label", "SELECT 'nation' AS \"column\", n_nationkey AS id, n_name AS name FROM nation")
def rename_and_label(t: SampleTables) -> DataFrame:
    named = t.table("nation").select("n_nationkey", "n_name").toDF("id", "name")
    return named.select(F.lit("nation").alias("column"), "id", "name")


@query(
    "price_arithmetic",
    """SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net,
           l_extendedprice / nullif(l_quantity, 0) AS unit_price, l_extendedprice - l_tax AS less_tax FROM lineitem""",
)
def price_arithmetic(t: SampleTables) -> DataFrame:
    return t.table("lineitem").select(
        "l_orderkey", "l_linenumber",
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"),
        (F.col("l_extendedprice") / F.nullif(F.col("l_quantity"), F.lit(0.0))).alias("unit_price"),
        (F.col("l_extendedprice") - F.col("l_tax")).alias("less_tax"),
    )


@query(
    "compare_and_combine",
    """SELECT p_partkey, (p_size < 10 AND p_retailprice > 950) OR p_brand = 'Brand#7' AS picked, p_size >= 25 AS large FROM part""",
)
def compare_and_combine(t: SampleTables) -> DataFrame:
    return t.table("part").select(
        "p_partkey",
        (((F.col("p_size") < 10) & (F.col("p_retailprice") > 950)) | (F.col("p_brand") == "Brand#7")).alias("picked"),
        (F.col("p_size") >= 25).alias("large"),
    )


@query(
    "cast_text",
    """SELECT c_custkey, CAST(substr(c_name, 10) AS BIGINT) AS name_number, TRY_CAST(c_name AS INTEGER) AS not_a_number,
           CAST(CAST(c_custkey AS VARCHAR) AS DOUBLE) AS as_double FROM customer""",
)
def cast_text(t: SampleTables) -> DataFrame:
    return t.table("customer").select(
        "c_custkey",
        F.substring("c_name", 10, 100).cast("long").alias("name_number"),
        F.col("c_name").try_cast("int").alias("not_a_number"),
        F.col("c_custkey").cast("string").cast("double").alias("as_double"),
    )


@query(
    "lateral_alias",
    """SELECT o_orderkey, o_totalprice * 0.1 AS fee, o_totalprice * 0.1 + 1 AS fee_and_one, o_totalprice AS o_totalprice FROM orders""",
)
def lateral_alias(t: SampleTables) -> DataFrame:
    return t.table("orders").select(
        "o_orderkey", (F.col("o_totalprice") * 0.1).alias("fee"), (F.col("fee") + 1).alias("fee_and_one"), "o_totalprice"
    )


@query(
    "lateral_alias_aggregate",
    "SELECT min(o_totalprice) AS low, max(o_totalprice) - min(o_totalprice) AS spread FROM orders",
)
def lateral_alias_aggregate(t: SampleTables) -> DataFrame:
    return t.table("orders").agg(
        F.min("o_totalprice").alias("low"), (F.max("o_totalprice") - F.col("low")).alias("spread")
    )


@query("function_by_name", "SELECT n_nationkey, upper(n_name) AS name, length(n_name) AS size FROM nation")
def function_by_name(t: SampleTables) -> DataFrame:
    return t.table("nation").select(
        "n_nationkey",
        F.call_function("upper", F.col("n_name")).alias("name"),
        F.call_function("length", F.col("n_name")).cast("long").alias("size"),
    )


@query("numeric_columns", "SELECT s_suppkey, s_nationkey, s_acctbal FROM supplier")
def numeric_only(t: SampleTables) -> DataFrame:
    suppliers = t.table("supplier")
    return suppliers.select(*numeric_columns(suppliers))


# Filters -----------------------------------------------------------------------------------


@query("filter_equal", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'")
def filter_equal(t: SampleTables) -> DataFrame:
    return t.table("orders").filter(F.col("o_orderstatus") == "F").select("o_orderkey")


@query(
    "filter_date_range",
    "SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem WHERE l_shipdate BETWEEN TIMESTAMP '1996-03-01' AND TIMESTAMP '1996-09-01'",
)
def filter_date_range(t: SampleTables) -> DataFrame:
    return date_range(t.table("lineitem"), "l_shipdate", dt.date(1996, 3, 1), dt.date(1996, 9, 1)).select(
        "l_orderkey", "l_linenumber", "l_shipdate"
    )


@query("filter_no_range", "SELECT COUNT(*) AS n FROM lineitem")
def filter_no_range(t: SampleTables) -> DataFrame:
    return date_range(t.table("lineitem"), "l_shipdate").agg(F.count(F.lit(1)).alias("n"))


@query(
    "filter_date_bounds",
    "SELECT event_id, ts FROM events WHERE ts <= DATE '2024-01-12' AND ts >= DATE '2024-01-03'",
)
def filter_date_bounds(t: SampleTables) -> DataFrame:
    rows = t.table("events")
    start, end = as_date_bound(dt.datetime(2024, 1, 3, 15)), as_date_bound(dt.datetime(2024, 1, 12, 9))
    return rows.filter((F.col("ts") <= end) & (F.col("ts") >= start)).select("event_id", "ts")


@query(
    "filter_null",
    """SELECT c_custkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_totalprice > 400000
    WHERE o_orderkey IS NULL""",
)
def filter_null(t: SampleTables) -> DataFrame:
    customers = t.table("customer")
    orders = t.table("orders").filter(F.col("o_totalprice") > 400000).select("o_custkey", "o_orderkey")
    joined = customers.join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.filter(F.col("o_orderkey").isNull()).select("c_custkey")


@query("filter_members", "SELECT p_partkey FROM part WHERE p_type IN ('LARGE', 'ECONOMY') AND p_brand NOT IN ('Brand#7')")
def filter_members(t: SampleTables) -> DataFrame:
    rows = t.table("part")
    return rows.filter(F.col("p_type").isin("LARGE", "ECONOMY") & (F.col("p_brand").isin("Brand#7") == F.lit(False))).select(
        "p_partkey"
    )


@query("filter_after_moment", "SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-15 12:30:00'")
def filter_after_moment(t: SampleTables) -> DataFrame:
    return t.table("events").filter(F.col("ts") > as_bound("2024-01-15 12:30:00")).select("event_id", "ts")


# Joins -------------------------------------------------------------------------------------


@query("join_inner", "SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def join_inner(t: SampleTables) -> DataFrame:
    return t.table("nation").join(t.table("region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "r_name")


_DAILY_SPEND = """d AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS spent
  FROM orders GROUP BY 1, 2)"""


def _daily_spend(t: SampleTables) -> DataFrame:
    return t.table("orders").groupBy(F.col("o_custkey").alias("buyer"), F.to_date("o_orderdate").alias("day")).agg(
        from_units(F.sum(whole_units("o_totalprice"))).alias("spent")
    )


@query(
    "join_composite",
    f"""WITH {_DAILY_SPEND} SELECT o_orderkey, CAST(spent AS DOUBLE) AS spent
    FROM orders o JOIN d ON o.o_custkey = d.o_custkey AND CAST(o.o_orderdate AS DATE) = d.day""",
)
def join_composite(t: SampleTables) -> DataFrame:
    # Totals lie by their buyer and day already, so a buyer-day with very many orders has to be salted.
    orders = t.table("orders").select("o_orderkey", F.col("o_custkey").alias("buyer"), F.to_date("o_orderdate").alias("day"))
    return skew_join(orders, _daily_spend(t), ["buyer", "day"]).select("o_orderkey", "spent")


@query(
    "join_outer",
    f"""WITH {_DAILY_SPEND} SELECT c_custkey, day, CAST(COALESCE(spent, 0) AS DOUBLE) AS spent
    FROM d RIGHT JOIN customer ON o_custkey = c_custkey AND day < DATE '1997-01-01'""",
)
def join_outer(t: SampleTables) -> DataFrame:
    on = (F.col("c_custkey") == F.col("buyer")) & (F.col("day") < F.lit(dt.date(1997, 1, 1)))
    return t.table("customer").join(_daily_spend(t), on, "left").select(
        "c_custkey", "day", F.coalesce("spent", F.lit(0.0)).alias("spent")
    )


@query(
    "join_every_pair",
    "SELECT r_name, CAST(g AS INTEGER) AS year FROM region CROSS JOIN range(1995, 2002) r(g)",
)
def join_every_pair(t: SampleTables) -> DataFrame:
    # Every region with every year: the years are generated beside each row.
    return t.table("region").select("r_name", F.explode(F.sequence(F.lit(1995), F.lit(2001))).alias("year"))


@query(
    "join_anti",
    "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')",
)
def join_anti(t: SampleTables) -> DataFrame:
    pending = t.table("orders").filter(F.col("o_orderstatus") == "P").select(F.col("o_custkey").alias("c_custkey"))
    return without(t.table("customer").select("c_custkey", "c_name"), pending, "c_custkey")


# Aggregates --------------------------------------------------------------------------------


@query("group_count", "SELECT event_type, COUNT(event_id) AS n, COUNT(*) AS n_rows FROM events GROUP BY event_type")
def group_count(t: SampleTables) -> DataFrame:
    return t.table("events").groupBy("event_type").agg(
        F.count("event_id").alias("n"), F.count(F.lit(1)).alias("n_rows")
    )


@query(
    "group_sums",
    """SELECT l_returnflag, l_linestatus, CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS sum_qty,
           CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_price FROM lineitem GROUP BY ALL""",
)
def group_sums(t: SampleTables) -> DataFrame:
    return t.table("lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        from_units(F.sum(whole_units("l_quantity"))).alias("sum_qty"),
        from_units(F.sum(whole_units("l_extendedprice"))).alias("sum_price"),
    )


@query("count_distinct", "SELECT l_returnflag, COUNT(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY l_returnflag")
def count_distinct(t: SampleTables) -> DataFrame:
    return t.table("lineitem").groupBy("l_returnflag").agg(F.countDistinct("l_suppkey").alias("suppliers"))


@query(
    "global_statistics",
    """SELECT min(o_totalprice) AS low, max(o_totalprice) AS high, min(o_orderdate) AS first_date, max(o_orderdate) AS last_date,
           CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
           round(CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*), 6) AS mean FROM orders""",
)
def global_statistics(t: SampleTables) -> DataFrame:
    total = from_units(F.sum(whole_units("o_totalprice")))
    return t.table("orders").agg(
        F.min("o_totalprice").alias("low"), F.max("o_totalprice").alias("high"),
        F.min("o_orderdate").alias("first_date"), F.max("o_orderdate").alias("last_date"),
        total.alias("total"), F.round(total / F.count(F.lit(1)), 6).alias("mean"),
    )


@query(
    "group_by_expressions",
    """SELECT CAST(month(o_orderdate) AS INTEGER) AS month_number, strftime(o_orderdate, '%b') AS month,
           round(o_totalprice, -4) AS price_band, COUNT(*) AS n FROM orders GROUP BY ALL""",
)
def group_by_expressions(t: SampleTables) -> DataFrame:
    return t.table("orders").groupBy(
        F.month("o_orderdate").alias("month_number"), month_name("o_orderdate").alias("month"),
        F.round("o_totalprice", -4).alias("price_band"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query("distinct_values", "SELECT DISTINCT o_custkey AS customer_id FROM orders ORDER BY 1")
def distinct_values(t: SampleTables) -> DataFrame:
    return t.table("orders").select(F.col("o_custkey").alias("customer_id")).distinct().orderBy("customer_id")


@query(
    "conditional_count",
    """SELECT l_returnflag, CAST(SUM(CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END) AS BIGINT) AS discounted,
           COUNT(*) FILTER (l_tax = 0) AS untaxed FROM lineitem GROUP BY l_returnflag""",
)
def conditional_count(t: SampleTables) -> DataFrame:
    return t.table("lineitem").groupBy("l_returnflag").agg(
        F.sum(iff(F.col("l_discount") > 0.05, 1, 0)).alias("discounted"),
        F.count_if(F.col("l_tax") == 0).alias("untaxed"),
    )


@query(
    "share_of_flag",
    "SELECT round(avg(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END), 9) AS error_share FROM events",
)
def share_of_flag(t: SampleTables) -> DataFrame:
    return t.table("events").agg(F.round(F.avg(iff(F.col("event_type") == "error", 1, 0)), 9).alias("error_share"))


@query(
    "group_maxima",
    "SELECT c_mktsegment, max(c_custkey) AS c_custkey, max(c_name) AS c_name, max(c_nationkey) AS c_nationkey, max(c_acctbal) AS c_acctbal FROM customer GROUP BY c_mktsegment",
)
def group_maxima(t: SampleTables) -> DataFrame:
    customers = t.table("customer")
    rest = [c for c in customers.columns if c != "c_mktsegment"]
    return customers.groupBy("c_mktsegment").agg(*[F.max(c).alias(c) for c in rest])


@query(
    "group_correlation",
    "SELECT l_returnflag, round(corr(l_quantity, l_extendedprice), 6) AS r FROM lineitem GROUP BY l_returnflag",
)
def group_correlation(t: SampleTables) -> DataFrame:
    return t.table("lineitem").groupBy("l_returnflag").agg(F.round(correlation("l_quantity", "l_extendedprice"), 6).alias("r"))


# Windows -----------------------------------------------------------------------------------


@query(
    "ratio_overall",
    """WITH g AS (SELECT o_orderpriority, COUNT(*) AS n FROM orders GROUP BY 1)
    SELECT o_orderpriority, n, CAST(n AS DOUBLE) / SUM(n) OVER () AS ratio FROM g""",
)
def ratio_overall(t: SampleTables) -> DataFrame:
    return ratio_to_report(t.table("orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n")), "n")


@query(
    "ratio_within_group",
    """WITH g AS (SELECT l_returnflag, l_shipdate, COUNT(*) AS n FROM lineitem GROUP BY ALL)
    SELECT l_returnflag, l_shipdate, n, CAST(n AS DOUBLE) / SUM(n) OVER (PARTITION BY l_shipdate) AS ratio FROM g""",
)
def ratio_within_group(t: SampleTables) -> DataFrame:
    grouped = t.table("lineitem").groupBy("l_returnflag", "l_shipdate").agg(F.count(F.lit(1)).alias("n"))
    return ratio_to_report(grouped, "n", ["l_shipdate"])


_FLOW = "d AS (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS day, SUM(CAST(l_quantity AS DECIMAL(18,2))) AS qty FROM lineitem GROUP BY 1, 2)"


@query(
    "lag_and_trailing_sums",
    f"""WITH {_FLOW} SELECT l_suppkey, day, CAST(lag(qty, 1) OVER w AS DOUBLE) AS previous,
           CAST(SUM(qty) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS DOUBLE) AS trailing_7,
           CAST(SUM(qty) OVER (w ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS DOUBLE) AS trailing_30,
           CAST(SUM(qty) OVER (w RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING) AS DOUBLE) AS within_30_days
    FROM d WINDOW w AS (PARTITION BY l_suppkey ORDER BY day)""",
)
def lag_and_trailing_sums(t: SampleTables) -> DataFrame:
    daily = t.table("lineitem").groupBy("l_suppkey", F.to_date("l_shipdate").alias("day")).agg(
        F.sum(whole_units("l_quantity", 1)).alias("qty")
    )
    by_day = Window.partitionBy("l_suppkey").orderBy("day")
    by_number = Window.partitionBy("l_suppkey").orderBy(F.unix_date("day"))
    return daily.select(
        "l_suppkey", "day",
        F.lag("qty", 1).over(by_day).cast("double").alias("previous"),
        F.sum("qty").over(by_day.rowsBetween(-7, -1)).cast("double").alias("trailing_7"),
        F.sum("qty").over(by_day.rowsBetween(-30, -1)).cast("double").alias("trailing_30"),
        F.sum("qty").over(by_number.rangeBetween(-30, -1)).cast("double").alias("within_30_days"),
    )


# Sorting -----------------------------------------------------------------------------------


@query("sort_ascending", "SELECT p_brand, p_size, p_partkey FROM part ORDER BY p_brand, p_size, p_partkey")
def sort_ascending(t: SampleTables) -> DataFrame:
    return t.table("part").select("p_brand", "p_size", "p_partkey").orderBy("p_brand", "p_size", "p_partkey")


@query("sort_mixed", "SELECT s_nationkey, s_acctbal, s_suppkey FROM supplier ORDER BY s_nationkey ASC, s_acctbal DESC")
def sort_mixed(t: SampleTables) -> DataFrame:
    return t.table("supplier").select("s_nationkey", "s_acctbal", "s_suppkey").orderBy(
        F.asc("s_nationkey"), F.desc("s_acctbal")
    )


@query("first_rows", "SELECT * FROM customer ORDER BY c_custkey LIMIT 10")
def first_rows(t: SampleTables) -> DataFrame:
    return top_k(t.table("customer"), [F.asc("c_custkey")], 10)


@query("largest_orders", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def largest_orders(t: SampleTables) -> DataFrame:
    return top_k(t.table("orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.asc("o_orderkey")], 25)


# Sets --------------------------------------------------------------------------------------


@query(
    "union_distinct",
    "SELECT s_nationkey AS nation FROM supplier UNION SELECT c_nationkey FROM customer",
)
def union_without_duplicates(t: SampleTables) -> DataFrame:
    return union_distinct(
        t.table("supplier").select(F.col("s_nationkey").alias("nation")), t.table("customer").select("c_nationkey")
    )


@query(
    "union_relations",
    """SELECT s_suppkey AS party, s_acctbal AS balance, NULL::VARCHAR AS segment, 'supplier' AS source_relation FROM supplier
    UNION ALL SELECT c_custkey, c_acctbal, c_mktsegment, 'customer' FROM customer""",
)
def union_by_name(t: SampleTables) -> DataFrame:
    return union_relations(
        {
            "supplier": t.table("supplier").select(F.col("s_suppkey").alias("party"), F.col("s_acctbal").alias("balance")),
            "customer": t.table("customer").select(
                F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"), F.col("c_custkey").alias("party")
            ),
        }
    )


# Scalar functions --------------------------------------------------------------------------


@query(
    "date_functions",
    """SELECT event_id, CAST(ts AS DATE) AS day, CAST(dayofweek(ts) AS INTEGER) AS weekday, CAST(hour(ts) AS INTEGER) AS hour,
           CAST(month(ts) AS INTEGER) AS month_number, strftime(ts, '%b') AS month, strftime(ts, '%a') AS weekday_name,
           CAST(date_trunc('day', ts) AS TIMESTAMP) AS midnight,
           CAST(date_diff('day', CAST(ts AS DATE), DATE '2024-02-01') AS INTEGER) AS days_left,
           CAST(CAST(ts AS DATE) + 10 AS DATE) AS later, strftime(ts, '%m/%d/%Y') AS us_text,
           strptime(strftime(ts, '%m/%d/%Y'), '%m/%d/%Y') AS parsed,
           CASE WHEN dayofweek(ts) IN (0, 6) THEN 1 ELSE 0 END AS weekend,
           CASE WHEN hour(ts) < 6 OR hour(ts) > 20 THEN 1 ELSE 0 END AS night
    FROM events""",
)
def date_functions(t: SampleTables) -> DataFrame:
    text = F.date_format("ts", "MM/dd/yyyy")
    return t.table("events").select(
        "event_id", F.to_date("ts").alias("day"), day_of_week("ts").alias("weekday"), F.hour("ts").alias("hour"),
        F.month("ts").alias("month_number"), month_name("ts").alias("month"), day_name("ts").alias("weekday_name"),
        day_start("ts").alias("midnight"), calendar_days("ts", F.lit(dt.date(2024, 2, 1))).alias("days_left"),
        F.date_add(F.to_date("ts"), 10).alias("later"), text.alias("us_text"), parse_us_date(text).alias("parsed"),
        is_weekend("ts").alias("weekend"), is_night("ts").alias("night"),
    )


@query(
    "conditional_functions",
    """WITH o AS (SELECT c_custkey, max(o_totalprice) AS best FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey)
    SELECT c_custkey, COALESCE(best, 0) AS best, CASE WHEN best > 200000 THEN 'big' ELSE 'small' END AS size,
           CASE WHEN best IS NULL THEN 0 ELSE 1 END AS buys FROM o""",
)
def conditional_functions(t: SampleTables) -> DataFrame:
    best = t.table("orders").groupBy("o_custkey").agg(F.max("o_totalprice").alias("best"))
    rows = t.table("customer").join(best, F.col("c_custkey") == F.col("o_custkey"), "left")
    return rows.select(
        "c_custkey", zero_if_null("best").alias("best"), iff(F.col("best") > 200000, "big", "small").alias("size"),
        F.when(F.col("best").isNull(), F.lit(0)).otherwise(F.lit(1)).alias("buys"),
    ).select("c_custkey", "best", "size", "buys")


@query(
    "rounding_functions",
    """SELECT l_orderkey, l_linenumber, round(l_quantity, -1) AS tens, round(-l_quantity, -1) AS negative_tens,
           round(sqrt(l_extendedprice), 3) AS root FROM lineitem""",
)
def rounding_functions(t: SampleTables) -> DataFrame:
    return t.table("lineitem").select(
        "l_orderkey", "l_linenumber", F.round("l_quantity", -1).alias("tens"),
        F.round(-F.col("l_quantity"), -1).alias("negative_tens"), F.round(F.sqrt("l_extendedprice"), 3).alias("root"),
    )


@query(
    "text_functions",
    "SELECT event_id, user_id || CAST(CAST(ts AS DATE) AS VARCHAR) AS day_key, upper(event_type) AS kind FROM events",
)
def text_functions(t: SampleTables) -> DataFrame:
    return t.table("events").select(
        "event_id", F.concat("user_id", F.to_date("ts")).alias("day_key"), F.upper("event_type").alias("kind")
    )


@query(
    "row_as_json",
    """SELECT n_nationkey AS id, '{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '","n_regionkey":' || n_regionkey || '}' AS row_json
    FROM nation""",
)
def row_as_json(t: SampleTables) -> DataFrame:
    return t.table("nation").select(F.col("n_nationkey").alias("id"), row_json().alias("row_json"))


@query("row_object_fields", "SELECT r_regionkey, r_name FROM region")
def row_object_fields(t: SampleTables) -> DataFrame:
    packed = t.table("region").select(row_object().alias("packed"))
    return packed.select("packed.*")
