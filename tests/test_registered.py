"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from deskmill.plans import catalog
from tests.oracle import connect, difference

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SMALL)


# Only queries that SQL can express have some; those of the subpackage without are tested with it.
SQL = sorted(entry.oracle_sql())


def test_every_query_has_sql():
    assert catalog.queries().keys() == catalog.oracle_sql().keys()
    assert entry.queries().keys() >= entry.oracle_sql().keys()


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", SQL)
def test_agrees_with_sql(spark, db, name):
    assert difference(spark, db, SMALL, name) is None
