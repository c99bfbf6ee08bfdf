"""What is registered, and every query that has SQL against it."""

from __future__ import annotations

import pytest
from oracle_check import differences, duck

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"
OPERATORS = [name for name in contract.LLM_QUERIES if name.startswith("op")]


def test_one_query_for_each_operator_and_the_pipeline():
    assert sorted(int(name[2:].split("_")[0]) for name in OPERATORS) == list(range(1, 14))
    assert "pipeline" in contract.queries() and "pipeline" not in contract.oracle_sql()
    assert contract.LLM_ORACLE.keys() <= contract.LLM_QUERIES.keys()


@pytest.mark.parametrize("name", sorted(contract.LLM_ORACLE))
def test_query_matches_sql(spark, name):
    assert differences(duck(SF), contract.LLM_QUERIES[name](spark, SF), contract.LLM_ORACLE[name]) is None
