"""Every query with a SQL counterpart holds the same rows as DuckDB."""

from __future__ import annotations

import oracle
import pytest

import __spark_entry__ as entry

ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, sf_dir, name):
    assert oracle.difference(entry.queries()[name](spark, sf_dir), con, ORACLES[name]) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 8
