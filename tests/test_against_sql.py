"""Every query with SQL gives the same names, types, rows and values as the SQL."""

from __future__ import annotations

import pytest

from caseloom.checks.all import QUERIES, SQL
from conftest import SMALL
from harness import connect, differences


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, small, con, name):
    assert differences(QUERIES[name](spark, small), con, SQL[name]) == []


def test_a_difference_is_noticed(spark, small, con):
    df = QUERIES["order_span"](spark, small)
    wrong = SQL["order_span"].replace("max(o_orderkey)", "max(o_orderkey) + 1")
    assert differences(df, con, wrong)
    assert differences(df, con, SQL["order_span"] + " having count(*) > 1000000")
    assert differences(df, con, SQL["order_span"].replace("min(o_orderkey)", "min(o_orderkey)::int"))


def test_every_sql_text_has_a_query():
    assert set(SQL) <= set(QUERIES)
