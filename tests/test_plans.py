"""Physical plans keep their shape when nothing is small enough to broadcast by size."""

import pytest

from tidemark.operators.filters import plan_text
from tidemark.plans.features import feature_table
from tidemark.sources.samples import SampleTables
from tidemark.suite import QUERIES

FOLDER = "/root/testdata/sf0.001"
FITTED = {"forest_scores", "forest_performance", "forest_batch_scores", "forest_sql_scores", "forest_facts"}


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def ancestors(lines, i):
    """The operators above line i, nearest first."""
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    seen, level = [], depth(lines[i])
    for line in reversed(lines[:i]):
        if depth(line) < level:
            level = depth(line)
            seen.append(line.lstrip(" :+-"))
    return seen


@pytest.mark.parametrize("name", sorted(set(QUERIES) - FITTED))
def test_no_pairwise_join_and_no_unbounded_single_task(no_broadcast, name):
    lines = plan_text(QUERIES[name](no_broadcast, FOLDER), "simple").splitlines()
    assert not [x for x in lines if "CartesianProduct" in x or "NestedLoopJoin" in x]
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            user = next(a for a in ancestors(lines, i) if not a.startswith(("Sort ", "Project", "Filter")))
            # A global aggregate, or the window over the table of bucket totals.
            assert "Aggregate" in user or (user.startswith("Window") and "bucket" in user)


def test_feature_table_moves_transactions_twice(no_broadcast):
    """Only two exchanges carry transaction ids: to their moment and to their terminal-day."""
    tx = SampleTables(no_broadcast, FOLDER).transactions()
    text = plan_text(feature_table(tx, per_one=100))
    details = text.split("\n\n")
    wide = [d for d in details if "Exchange\n" in d and "transaction_id" in d]
    by = [d.split("hashpartitioning(")[1].split(")")[0] for d in wide]
    assert sorted(b.split("#")[0] for b in by) == ["__moment", "terminal_id"]


def test_scans_read_only_what_is_needed(spark):
    plan = plan_text(QUERIES["trips_by_month_in_range"](spark, FOLDER))
    schema = next(x for x in plan.splitlines() if "ReadSchema" in x)
    pushed = next(x for x in plan.splitlines() if "PushedFilters" in x)
    assert "o_orderdate" in schema and "o_custkey" not in schema
    assert "GreaterThanOrEqual(o_orderdate" in pushed
