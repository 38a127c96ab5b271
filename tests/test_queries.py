"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as contract
from tests.conftest import SF
from workload.check import plain, rows_of
from workload.compare import difference
from workload.registry import CHECKS


@pytest.mark.parametrize("name", list(CHECKS))
def test_query_matches_sql(spark, duck, name):
    assert difference(spark, duck, SF, name) is None


def test_entry_gives_rows(spark):
    edges = contract.entry(spark)
    assert edges.columns == ["src", "dst", "type", "similarity"]
    assert edges.limit(1).count() == 1


def test_contract_lists_agree():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    plain = {name for name in CHECKS if name not in contract.oracle_sql()}
    assert plain == {"stamp_fetched_at"}


def test_comparison_sees_a_difference():
    assert rows_of(["b", "a"], [(1, 2.0)]) == rows_of(["a", "b"], [(2.0, 1)])
    assert rows_of(["a"], [(1.0,)]) != rows_of(["a"], [(1.00001,)])
    assert rows_of(["a"], [(None,)]) != rows_of(["a"], [("",)])
    assert plain(-0.0) == 0.0
