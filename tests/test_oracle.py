"""Every registered query with SQL gives the SQL's rows; every other one gives rows."""

from __future__ import annotations

import pytest
from compare import connect, run_query, run_sql
from conftest import SF_DIR

from __spark_entry__ import entry, oracle_sql, queries

ORACLES, QUERIES = oracle_sql(), queries()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    _, (columns, rows), _ = run_query(spark, QUERIES[name], SF_DIR)
    _, (sql_columns, sql_rows), _ = run_sql(duck, ORACLES[name])
    assert columns == sql_columns
    assert rows == sql_rows


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
