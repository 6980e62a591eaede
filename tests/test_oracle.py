"""Every registered query against its SQL; those without SQL must give rows."""

from __future__ import annotations

import pytest
from compare import differences, duck

from ticketloom.catalog import load

QUERIES = load()
CHECKED = [n for n, q in QUERIES.items() if q.sql is not None]
ROWS_ONLY = [n for n, q in QUERIES.items() if q.sql is None]


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", CHECKED)
def test_matches_sql(spark, sf, con, name):
    assert differences(QUERIES[name].run(spark, sf), con, QUERIES[name].sql) == []


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_gives_rows(spark, sf, name):
    assert QUERIES[name].run(spark, sf).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
