"""Every registered query against its SQL on the smallest tables."""

import pytest

from tests.compare import differences
from voltide.plans.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(spark, sf, oracle, name):
    assert differences(QUERIES[name](spark, sf), oracle, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_has_rows(spark, sf, name):
    df = QUERIES[name](spark, sf)
    rows = df.collect()
    assert rows
    for column, kind in df.dtypes:
        if kind == "double":
            assert any(r[column] is not None for r in rows), column


def test_every_check_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_contract(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() == 1
    assert set(contract.oracle_sql()) <= set(contract.queries())
