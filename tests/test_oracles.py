"""Every registered query against its SQL oracle."""

from __future__ import annotations

import pytest
from conftest import SMALL

import __spark_entry__ as entry
from clickpulse.plans.queries import all_queries
from compare import connect, difference

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_an_oracle():
    """Of the library's own queries; some of the training-data operators are beyond SQL."""
    assert set(all_queries()) <= set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", list(ORACLES))
def test_matches_oracle(spark, con, name):
    assert difference(QUERIES[name](spark, SMALL), con, ORACLES[name]) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["window_start", "window_end", "gmv"] and df.count() > 0
