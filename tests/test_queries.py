"""Every registered query against its SQL on the smallest data."""

import pytest
from oracle_check import differences, duck

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = contract.QUERIES, contract.ORACLE


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()


def test_entry(spark):
    assert contract.entry(spark).count() == 3


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert differences(con, QUERIES[name](spark, SF), ORACLE[name]) is None
