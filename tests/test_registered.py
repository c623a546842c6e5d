"""Every registered query against its SQL on the driver tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from checks import oracles, queries
from checks.compare import difference, oracle_connection

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF_DIR)


def test_every_query_has_its_sql():
    assert set(queries.queries()) == set(oracles.oracle_sql())
    assert set(queries.queries()) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_gives_three_categories(spark):
    df = contract.entry(spark)
    assert df.columns == ["category", "total"] and df.count() == 3


@pytest.mark.parametrize("name", list(queries.queries()))
def test_query_equals_its_sql(spark, connection, name):
    assert difference(spark, connection, SF_DIR, name) is None
