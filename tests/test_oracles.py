"""Every query with SQL gives the rows of its SQL; every other one runs."""

import oracle
import pytest

from threshmill.plans import registry


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_its_sql(spark, con, sf_dir, name):
    got, wanted, own, theirs = oracle.compare(spark, con, registry.QUERIES[name], registry.ORACLE_SQL[name], sf_dir)
    assert own == theirs
    assert got == wanted


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE_SQL)))
def test_query_without_sql_runs(spark, sf_dir, name):
    assert registry.QUERIES[name](spark, sf_dir).count() >= 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
