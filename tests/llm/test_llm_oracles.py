"""Queries that SQL can express give the same rows as DuckDB."""

import duckdb
import pytest

from conftest import SMALL
from ebbline.llm.queries import ORACLES, QUERIES
from test_registry import TABLES, comparable


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    assert comparable(QUERIES[name](spark, SMALL).toPandas()) == comparable(connection.execute(ORACLES[name]).df())
