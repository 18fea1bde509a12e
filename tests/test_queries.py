"""Every registered query against its SQL on the given tables."""

import pytest

import __spark_entry__ as driver
from starload.queries.oracle import ORACLE
from starload.queries.registry import QUERIES
from starload.session import stored
from tests.conftest import SF_DIR
from tests.oracle import differences, oracle_connection


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF_DIR)


def test_every_query_of_the_library_has_an_oracle():
    assert QUERIES.keys() == ORACLE.keys()
    assert driver.oracle_sql().keys() <= driver.queries().keys()


@pytest.mark.parametrize("name", list(driver.oracle_sql()))
def test_query_equals_sql(spark, connection, name):
    result = stored(driver.queries()[name](spark, SF_DIR), "result")
    assert differences(result, driver.oracle_sql()[name], connection) is None
    assert not result.isEmpty(), "equal because both are empty"
    if name == "constraint_audit":
        assert [r.check_name for r in result.filter("violations = 0").collect()] == []


def test_entry(spark):
    result = driver.entry(spark)
    assert result.columns[:2] == ["date_key", "symbol_code"]
    assert result.count() > 0
