import pytest

from headerflow.plans import registry

from .oracle import connect, same

SQL = registry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, sf_dir, con, name):
    same(registry.queries()[name](spark, sf_dir), con, SQL[name])


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(SQL)))
def test_without_sql(spark, sf_dir, name):
    assert registry.queries()[name](spark, sf_dir).count() > 0
