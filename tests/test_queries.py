"""Every registered query against DuckDB's answer to its SQL."""

from __future__ import annotations

import pytest

import compare
import __spark_entry__ as entry_point
from strandline.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(data):
    return compare.oracle(data)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, data, con, name):
    df = QUERIES[name](spark, data)
    assert compare.difference(df, con, ORACLES[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(ORACLES) <= set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry_returns_sorted_profit(spark):
    rows = [(r.nation, r.o_year) for r in entry_point.entry(spark).collect()]
    assert rows and rows == sorted(rows)
