import pytest
from oracle import connect, differences

import __spark_entry__ as contract
from shelfmark.queries import ORACLE, QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(DATA)


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    result = QUERIES[name](spark, DATA)
    assert differences(result, duck, ORACLE[name]) == []
