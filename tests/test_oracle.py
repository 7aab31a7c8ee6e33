"""Every registered query that SQL can express equals its SQL at the smallest scale."""

import __spark_entry__ as contract
import check
import pytest
from conftest import SF


def test_queries_without_sql_are_those_of_the_llm_subpackage():
    assert all(name == "pipeline" or name.startswith("op") for name in set(contract.queries()) - set(contract.oracle_sql()))
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, oracle, name):
    assert check.difference(spark, oracle, SF, name) is None


def test_entry(spark):
    assert contract.entry(spark).count() == 1
