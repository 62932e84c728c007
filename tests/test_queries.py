"""Every catalogued query against the rows its SQL gives."""

import pytest

import __spark_entry__ as contract
from panelcast.catalog import ENTRIES
from tests.oracle import connect, differences

WITH_SQL = sorted(n for n, e in ENTRIES.items() if e.sql is not None)
ROWS_ONLY = sorted(n for n, e in ENTRIES.items() if e.sql is None)


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", WITH_SQL)
def test_rows_match(name, spark, sf_dir, con):
    assert differences(ENTRIES[name].run(spark, sf_dir), con, ENTRIES[name].sql) == []


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_has_rows(name, spark, sf_dir):
    rows = ENTRIES[name].run(spark, sf_dir).collect()
    assert rows
    if "yhat" in rows[0]:
        assert all(r["yhat"] is not None and r["yhat"] == r["yhat"] for r in rows)


def test_contract():
    assert set(contract.oracle_sql()) == set(WITH_SQL) | set(contract.LLM_SQL)
    assert set(contract.queries()) == set(ENTRIES) | set(contract.LLM_QUERIES)


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert len({r["City"] for r in rows}) == 25 and len(rows) == 150
    # The smallest data set has one series under two years: it falls back to a trend.
    assert {r["variant"] for r in rows} == {"holt_winters", "holt"}
