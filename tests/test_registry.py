"""Every registered query that has SQL gives the same rows as DuckDB."""

import math
import re
from pathlib import Path

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from conftest import SMALL
from ebbline.plans.oracles import ORACLES
from ebbline.plans.registry import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()
ROWS_ONLY = {
    "model_runs", "logistic_scores", "forest_scores", "batch_scores", "validated_sample", "tuning_results"
}
LIBRARY = Path(entry.__file__).parent / "ebbline"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return connection


def plain(value):
    if value is None or value is pd.NaT or value is pd.NA:
        return None
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, (bool, str)):
        return str(value)
    try:
        return repr(float(value))
    except (TypeError, ValueError):
        return str(value)


def comparable(frame):
    names = sorted(frame.columns)
    return names, sorted(str([plain(v) for v in row]) for row in frame[names].itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    found = entry.queries()[name](spark, SMALL).toPandas()
    expected = duck.execute(entry.oracle_sql()[name]).df()
    assert comparable(found) == comparable(expected)


def test_every_query_has_sql_or_is_iterative():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry_has_one_row_per_customer(spark):
    gold = entry.entry(spark)
    assert gold.count() == 150 and len(gold.columns) == 17


def test_scores_come_from_a_stored_model(spark):
    rows = entry.queries()["batch_scores"](spark, SMALL)
    assert rows.where("churn_probability BETWEEN 0 AND 1 AND prediction IN (0, 1)").count() == rows.count() == 135


@pytest.mark.parametrize(
    "pattern", [r"toPandas\(", r"localCheckpoint", r"crossJoin\(", r"collect_list", r"\.rdd\b", r"\budf\("]
)
def test_library_keeps_rows_distributed(pattern):
    for path in LIBRARY.rglob("*.py"):
        if path.parent.name == "llm":
            continue
        assert not re.search(pattern, path.read_text()), path
