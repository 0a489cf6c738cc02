"""Every registered query against its DuckDB statement."""

from __future__ import annotations

import oracle
import pytest
from frames import SF

import __spark_entry__ as entry_module

QUERIES = entry_module.queries()
ORACLES = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF)


def test_every_statement_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_has_rows(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(ORACLES)))
def test_same_rows_as_duckdb(spark, sf, duck, name):
    assert oracle.compare(QUERIES[name](spark, sf), duck, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_without_a_statement(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0
