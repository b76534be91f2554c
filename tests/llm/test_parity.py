"""Queries that SQL can express, against DuckDB on the same tables."""

import pytest

from cratelake.llm.queries import QUERIES
from cratelake.llm.sql import ORACLES
from tests.parity import connect, spark_rows, sql_rows


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, sf, name):
    assert spark_rows(QUERIES[name](spark, sf)) == sql_rows(connect(sf), ORACLES[name])
