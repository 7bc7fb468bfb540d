import pytest

from betaloom.plans.oracles import ORACLES
from betaloom.plans.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(name, same):
    same(QUERIES[name], ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_runs(name, spark):
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0


def test_entry_and_registry(spark):
    import __spark_entry__ as e

    assert set(QUERIES) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0
