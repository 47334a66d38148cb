"""Exploration of raw tables: distinct values, group counts, key checks, text search."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_counts(df: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    """``column, distinct_values`` without nulls.

    Exact counting shuffles each distinct value once, combined before the shuffle; ``approximate`` exchanges
    sketches of fixed size instead.
    """
    if approximate:
        counted = df.agg(*[F.approx_count_distinct(name).alias(name) for name in columns])
        return counted.unpivot([], columns, "column", "distinct_values")
    texts = df.select([F.col(name).cast("string").alias(name) for name in columns])
    # A null for each column gives one without any row its line, and is not counted.
    always = df.sparkSession.createDataFrame([(name, None) for name in columns], "column string, value string")
    return (
        texts.unpivot([], columns, "column", "value")
        .unionByName(always)
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("copies"))
        .groupBy("column")
        .agg(F.count("value").alias("distinct_values"))
    )


def group_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def key_profile(df: DataFrame, key: str) -> DataFrame:
    """Rows, distinct keys and missing keys in one row."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct(key).alias("distinct_keys"),
        F.count_if(F.col(key).isNull()).alias("missing_keys"),
    )


def containing(df: DataFrame, column: str, text: str) -> DataFrame:
    return df.where(F.col(column).contains(text))
