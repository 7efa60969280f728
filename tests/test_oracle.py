import pytest

import __spark_entry__ as contract
from check_oracle import compare
from conftest import SF


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query_agrees_with_sql(spark, duck, name):
    problem, n = compare(spark, duck, SF, name)
    assert problem == ""
    assert n > 0


def test_oracles_belong_to_queries():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_runs(spark):
    df = contract.entry(spark)
    assert df.columns == ["attempt", "pattern_id", "instruction", "input", "output"]
    assert df.count() > 0
