"""All registered queries against their SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from check import compare, connect
from conftest import SMALL
from postmill.plans.oracle import ORACLE
from postmill.plans.queries import QUERIES


@pytest.fixture(scope="module")
def db():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() == 200


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    assert compare(spark, db, SMALL, name) is None
