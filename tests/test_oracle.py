"""Every registered query against its SQL in DuckDB."""

import pytest

import check
from __spark_entry__ import entry
from tests.conftest import SMALL
from workload.oracle import SQL
from workload.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return check.oracle(SMALL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_equal(spark, con, name):
    assert check.compare(spark, con, SMALL, name) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    assert entry(spark).count() == 20
