"""Every registered query against its SQL on the smallest data."""

from __future__ import annotations

import pytest
from check_oracle import compare, connect
from conftest import SMALL

import __spark_entry__ as entry
from verification import oracle, registry


@pytest.fixture(scope="module")
def connection():
    return connect(SMALL)


def test_every_query_has_its_sql():
    assert set(registry.QUERIES) == set(oracle.oracle_sql()) <= set(entry.oracle_sql())
    assert set(registry.QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_equals_sql(spark, connection, name):
    rows, difference = compare(spark, connection, name, SMALL)
    assert difference is None
    assert rows > 0


def test_flagship(spark):
    assert entry.entry(spark).count() == 701
