"""Every query with check SQL must agree with it on the smallest data set."""

import pytest
from check_oracle import compare, connect

from tidemark.suite import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_sql(spark, con, name):
    assert compare(spark, con, FOLDER, QUERIES[name], ORACLE[name]) is None


def test_every_check_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_sql_gives_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0
