"""Every registered query against its check SQL on the smallest tables."""

import pytest

from workload import check, registry

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return check.connect(FOLDER)


def test_each_query_has_check_sql():
    assert set(registry.queries()) == set(registry.check_statements())


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, connection, name):
    result = registry.queries()[name](spark, FOLDER)
    assert check.differences(result, connection, registry.check_statements()[name]) == []


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert __spark_entry__.queries().keys() >= __spark_entry__.oracle_sql().keys()
    assert registry.queries().keys() <= __spark_entry__.oracle_sql().keys()
