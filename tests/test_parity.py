"""Every query with an SQL twin returns what DuckDB returns on the same tables."""

import __spark_entry__ as contract
import parity
import pytest

QUERIES, ORACLE = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    con = parity.connect(sf)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, sf, name):
    assert parity.difference(QUERIES[name](spark, sf), duck, ORACLE[name]) is None


def test_each_query_has_a_twin():
    assert set(contract.ORACLE) == set(contract.QUERIES)
    assert set(ORACLE) <= set(QUERIES)


def test_flagship_query(spark):
    top = contract.entry(spark)
    assert top.columns == ["repo_name", "leak_count", "avg_entropy"]
    assert 0 < top.count() <= 10
