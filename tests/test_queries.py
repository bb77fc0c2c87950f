import pytest
from check_queries import differences, duck

from cadenza.plans import catalog, oracle

SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    return duck(small)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, small, con, name):
    assert differences(catalog.queries()[name](spark, small), con, SQL[name]) == []


def test_every_sql_has_a_query():
    assert set(SQL) <= set(catalog.queries())
