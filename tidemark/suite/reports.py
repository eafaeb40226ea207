"""Filter reports and data-quality checks."""

from __future__ import annotations

import contextlib
import datetime as dt
import io
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.filters import FilterSpec, apply_filters, filter_funnel, slider_bounds, statement_texts
from tidemark.operators.quality import MetricCheck, run_checks
from tidemark.operators.topk import sample_rows
from tidemark.sources.samples import SampleTables
from tidemark.suite.base import query
from tidemark.suite.sqltext import MEMBERS, TX

FILTERS = (
    FilterSpec("Member today", "IS_CURRENT_CUSTOMER", "flag", True),
    FilterSpec("Years as member", "YEARS_TENURE", "range", (5, 20)),
    FilterSpec("Member for long", "YEARS_TENURE", "range", (24, 24), enabled=False),
    FilterSpec("Visits a week", "AVERAGE_WEEKLY_WORKOUT_COUNT", "range", (0, 6)),
)
_CURRENT = "is_current_customer"
_TENURE = _CURRENT + " AND years_tenure BETWEEN 5 AND 20"
_WORKOUT = _TENURE + " AND average_weekly_workout_count BETWEEN 0 AND 6"


@query("filtered_members", f"WITH {MEMBERS} SELECT * FROM members WHERE {_WORKOUT}")
def filtered_members(t: SampleTables) -> DataFrame:
    return apply_filters(t.members(), FILTERS)


@query(
    "filter_funnel",
    f"""WITH {MEMBERS}
    SELECT 0 AS step, 'Original data' AS source_label, 'Filter: ''Member today''' AS target_label, COUNT(*) AS row_count FROM members
    UNION ALL SELECT 1, 'Filter: ''Member today''', 'Filter: ''Years as member''', COUNT(*) FROM members WHERE {_CURRENT}
    UNION ALL SELECT 2, 'Filter: ''Years as member''', 'Filter: ''Visits a week''', COUNT(*) FROM members WHERE {_TENURE}
    UNION ALL SELECT 3, 'Filter: ''Visits a week''', 'Result', COUNT(*) FROM members WHERE {_WORKOUT}""",
)
def funnel(t: SampleTables) -> DataFrame:
    return filter_funnel(t.members(), FILTERS)


_STEPS = ("is_current_customer = true", "years_tenure BETWEEN 5 AND 20", "average_weekly_workout_count BETWEEN 0 AND 6")
_STEP_LABELS = ("Original data", "Filter: 'Member today'", "Filter: 'Years as member'", "Filter: 'Visits a week'")


def _nested(steps: tuple[str, ...]) -> str:
    return "SELECT * FROM members" if not steps else f"SELECT * FROM ({_nested(steps[:-1])}) WHERE {steps[-1]}"


@query(
    "filter_statements",
    f"WITH {MEMBERS} " + " UNION ALL ".join(
        """SELECT {0}::INTEGER AS step, '{1}' AS label, '{2}' AS statement, (SELECT COUNT(*) FROM ({2})) AS row_count""".format(
            i + 1, label.replace("'", "''"), _nested(_STEPS[:i])
        )
        for i, label in enumerate(_STEP_LABELS)
    ),
)
def filter_statements(t: SampleTables) -> DataFrame:
    """The statement behind each step of the funnel, and what it gives when it is run."""
    members, parts = t.members(), []
    for step, label, text in statement_texts("members", FILTERS):
        counted = t.spark.sql(text.replace("FROM members", "FROM {members}"), members=members).agg(F.count(F.lit(1)).alias("row_count"))
        parts.append(counted.select(F.lit(step).alias("step"), F.lit(label).alias("label"), F.lit(text).alias("statement"), "row_count"))
    return reduce(DataFrame.unionAll, parts)


@query(
    "frame_actions",
    """WITH g AS (SELECT o_orderstatus AS name, COUNT(*) AS n FROM orders GROUP BY 1), first AS (SELECT o_orderkey AS k FROM orders ORDER BY 1 LIMIT 10)
    SELECT 'count' AS action, CAST(COUNT(*) AS VARCHAR) AS result FROM orders
    UNION ALL SELECT 'head', CAST(min(o_orderkey) AS VARCHAR) FROM orders
    UNION ALL SELECT 'take', string_agg(k, ',' ORDER BY k) FROM (FROM first ORDER BY k LIMIT 3)
    UNION ALL SELECT 'show', string_agg(k, ',' ORDER BY k) FROM first
    UNION ALL SELECT 'collect', string_agg(name || ':' || n, ',' ORDER BY name) FROM g
    UNION ALL SELECT 'to_pandas', CAST(SUM(n) AS VARCHAR) FROM g
    UNION ALL SELECT 'rows', string_agg(name, ',' ORDER BY name) FROM g""",
)
def frame_actions(t: SampleTables) -> DataFrame:
    """What each action hands to the caller: the first orders, and all rows of a small aggregate."""
    orders = t.table("orders").select(F.col("o_orderkey").alias("k")).orderBy("k")
    groups = t.table("orders").groupBy(F.col("o_orderstatus").alias("name")).agg(F.count(F.lit(1)).alias("n")).orderBy("name")
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        orders.show(10, truncate=False)
    lines = [line.strip("|").strip() for line in shown.getvalue().splitlines() if line.startswith("|")]
    found = [
        ("count", str(orders.count())), ("head", str(orders.head()["k"])), ("take", ",".join(str(r["k"]) for r in orders.take(3))),
        ("show", ",".join(lines[1:])), ("collect", ",".join(f"{r['name']}:{r['n']}" for r in groups.collect())),
        ("to_pandas", str(int(groups.toPandas()["n"].sum()))), ("rows", ",".join(r["name"] for r in groups.toLocalIterator())),
    ]
    return t.spark.createDataFrame(found, "action string, result string")


@query("stamped_load", "SELECT COUNT(*) AS row_count, 1::BIGINT AS stamps, true AS recent FROM supplier")
def stamped_load(t: SampleTables) -> DataFrame:
    """Rows stamped with the time of their load: one time for all rows of a query, and that of the clock."""
    now = dt.datetime.now(dt.timezone.utc)
    stamped = t.table("supplier").withColumn("loaded_at", F.current_timestamp())
    recent = F.abs(F.unix_micros("loaded_at") - int(now.timestamp() * 1_000_000)) < 3_600_000_000
    return stamped.agg(
        F.count(F.lit(1)).alias("row_count"), F.countDistinct("loaded_at").alias("stamps"), F.coalesce(F.bool_and(recent), F.lit(True)).alias("recent")
    )


@query(
    "slider_bounds",
    f"""WITH {MEMBERS} SELECT 'years_tenure' AS column_name, 0::BIGINT AS low, max(years_tenure)::BIGINT AS high FROM members
    UNION ALL SELECT 'average_weekly_workout_count', 0, max(average_weekly_workout_count)::BIGINT FROM members""",
)
def bounds(t: SampleTables) -> DataFrame:
    return slider_bounds(t.members(), ["years_tenure", "average_weekly_workout_count"])


@query(
    "member_preview",
    f"WITH {MEMBERS} SELECT * FROM members WHERE {_WORKOUT} ORDER BY md5(CAST(member_id AS VARCHAR) || '|7'), member_id LIMIT 5",
)
def member_preview(t: SampleTables) -> DataFrame:
    return sample_rows(apply_filters(t.members(), FILTERS), 5, ["member_id"], seed=7)


@query(
    "quality_checks",
    """SELECT 'few nations' AS check_name, CASE WHEN COUNT(*) < 2 THEN 'pass' ELSE 'fail' END AS outcome,
           COUNT(*) AS value FROM nation
    UNION ALL SELECT 'nations named', CASE WHEN COUNT(*) FILTER (n_name IS NULL) = 0 THEN 'pass' ELSE 'fail' END,
           COUNT(*) FILTER (n_name IS NULL) FROM nation""",
)
def quality_checks(t: SampleTables) -> DataFrame:
    return run_checks(
        t.table("nation"),
        [
            MetricCheck("few nations", "<", 2),
            MetricCheck("nations named", "=", 0, column="n_name"),
        ],
    )


@query(
    "transaction_quality_checks",
    f"""WITH {TX}
    SELECT 'has rows' AS check_name, CASE WHEN COUNT(*) > 0 THEN 'pass' ELSE 'fail' END AS outcome, COUNT(*) AS value FROM tx
    UNION ALL SELECT 'terminal known', CASE WHEN COUNT(*) FILTER (terminal_id IS NULL) = 0 THEN 'pass' ELSE 'fail' END,
           COUNT(*) FILTER (terminal_id IS NULL) FROM tx
    UNION ALL SELECT 'amount known', CASE WHEN COUNT(*) FILTER (tx_amount IS NULL) <= 10 THEN 'pass' ELSE 'fail' END,
           COUNT(*) FILTER (tx_amount IS NULL) FROM tx""",
)
def transaction_quality_checks(t: SampleTables) -> DataFrame:
    return run_checks(
        t.transactions(),
        [
            MetricCheck("has rows", ">", 0),
            MetricCheck("terminal known", "=", 0, column="terminal_id"),
            MetricCheck("amount known", "<=", 10, column="tx_amount"),
        ],
    )
