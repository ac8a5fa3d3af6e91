"""Every registered query against its SQL, and the driver contract."""

import pytest

import __spark_entry__ as entry
from check import compare, duck
from kinfold.catalog import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, connection, name):
    assert compare(spark, connection, name, entry.queries()[name], SQL[name], FOLDER) is None


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
