"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as contract
from catalog.queries import QUERIES
from tests.oracle_check import connect, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert QUERIES.keys() <= contract.queries().keys() and QUERIES.keys() <= contract.oracle_sql().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    frame = contract.queries()[name](spark, SF_DIR)
    assert difference(frame, duck, contract.oracle_sql()[name]) is None


def test_entry_has_rows(spark):
    assert contract.entry(spark).limit(1).count() == 1
