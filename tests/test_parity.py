"""Every query against its SQL."""

import pytest

import __spark_entry__ as driver
from cratelake.plans.oracles import ORACLES as SQL
from cratelake.plans.queries import QUERIES
from tests.parity import connect, spark_rows, sql_rows


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows_as_sql(spark, sf, con, name):
    columns, found = spark_rows(QUERIES[name](spark, sf))
    expected_columns, expected = sql_rows(con, SQL[name])
    assert columns == expected_columns
    assert found == expected
    assert found


def test_entry_runs(spark):
    assert driver.entry(spark).count() > 0
