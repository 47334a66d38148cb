"""Missing values per column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.functions.values import is_missing


def get_missing_values(df: DataFrame, only_missing: bool = False) -> DataFrame:
    """Null, NaN and null-like texts of every column, counted in one pass; fails on an empty frame."""
    fields = df.schema.fields
    totals = df.agg(
        F.count(F.lit(1)).alias("row_total"),
        F.array(
            *[
                F.struct(
                    F.lit(field.name).alias("column"),
                    F.count_if(is_missing(F.col(f"`{field.name}`"), field.dataType)).alias("missing_count"),
                )
                for field in fields
            ]
        ).alias("profile"),
    )
    rows = F.when(F.col("row_total") > 0, F.col("row_total")).otherwise(
        F.raise_error(F.lit("no rows to profile")).cast("long")
    )
    profile = (
        totals.select(rows.alias("row_total"), F.inline("profile"))
        .withColumn("missing_share", F.round(F.col("missing_count") / F.col("row_total"), 4))
        .select("column", "missing_count", "missing_share")
    )
    if only_missing:
        profile = profile.where("missing_count > 0")
    return profile.orderBy(F.desc("missing_count"), "column")
