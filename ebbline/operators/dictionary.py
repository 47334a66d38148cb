"""Category dictionaries of any size: a numbered table on shared storage, applied by a join.

``PreprocessorStatistics`` keeps its dictionaries in the model, on the driver.  Here the categories of a column are
counted, sorted over all tasks and numbered where they lie: a task's first number follows from the row counts of the
tasks before it, the only thing the driver sees beside one row per column.  The numbers and the vectors are those of
the dictionary in the model: categories in order from 0, unknown ones a vector of zeros, null the most frequent one
(ties: the smallest).

A category that a third of the rows hold is one combined row of the dictionary.  In the join its rows are split by
adaptive execution, as the dictionary has one row per category; Spark broadcasts the dictionary only where its size is
below the session's threshold.

Defined results: a column without categories is left out, as in the model; an empty table has none.  Rows that are
repeated are encoded alike.
"""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.operators.preprocess import category_counts

_IN_TASK = (1 << 33) - 1  # fixed value: the bits of monotonically_increasing_id that count within a task
_COLUMNS = "feature string, size long, mode string"


def write_dictionary(df: DataFrame, columns: list[str], path: str) -> None:
    """Number the categories of text columns and store them; the description of the columns is written last, so a
    dictionary without one comes from a write that was lost."""
    spark = df.sparkSession
    spark.createDataFrame([], _COLUMNS).write.mode("overwrite").parquet(f"{path}/columns")
    counts = category_counts(df, columns).select("feature", "category", "entries")
    ordered = counts.repartitionByRange("feature", "category").sortWithinPartitions("feature", "category")
    place = F.monotonically_increasing_id()
    ordered.withColumn("place", place).write.mode("overwrite").parquet(f"{path}/sorted")
    stored = spark.read.parquet(f"{path}/sorted")
    task = F.shiftright("place", 33)
    parts = stored.groupBy("feature", task.alias("task")).agg(
        F.count(F.lit(1)).alias("categories"), F.min("place").alias("first")
    )
    starts, sizes = [], {}
    for row in parts.orderBy("feature", "task").collect():  # a row per column and task
        before = sizes.get(row["feature"], 0)
        starts.append((row["feature"], row["task"], before - (row["first"] & _IN_TASK)))
        sizes[row["feature"]] = before + row["categories"]
    shifts = spark.createDataFrame(starts, "feature string, task long, shift long")
    numbered = stored.withColumn("task", task).join(F.broadcast(shifts), ["feature", "task"])
    index = F.col("place").bitwiseAND(F.lit(_IN_TASK)) + F.col("shift")
    numbered.select("category", index.alias("index"), "entries", "feature").write.mode("overwrite").partitionBy(
        "feature"
    ).parquet(f"{path}/categories")
    top = stored.groupBy("feature").agg(F.min(F.struct(-F.col("entries"), F.col("category"))).alias("top"))
    modes = {row["feature"]: row["top"]["category"] for row in top.collect()}  # a row per column
    rows = [(name, sizes[name], modes[name]) for name in columns if name in sizes]
    spark.createDataFrame(rows, _COLUMNS).coalesce(1).write.mode("overwrite").parquet(f"{path}/columns")


class CategoryDictionary:
    """A stored dictionary."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._spark, self._path = spark, path
        described = spark.read.schema(_COLUMNS).parquet(f"{path}/columns").collect()  # a row per column
        self.sizes = {row["feature"]: row["size"] for row in described}
        self.modes = {row["feature"]: row["mode"] for row in described}

    def categories(self, column: str) -> DataFrame:
        """``category, index, entries`` of a column."""
        every = self._spark.read.schema("category string, index long, entries long, feature string")
        return every.parquet(f"{self._path}/categories").where(F.col("feature") == column).drop("feature")

    def with_indexes(self, df: DataFrame) -> DataFrame:
        """Add ``index_<column>`` for every column of the dictionary: its category's number, the number of categories
        for one that is unknown."""
        for column, size in self.sizes.items():
            filled = F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(self.modes[column]))
            known = self.categories(column).select(F.col("category").alias(f"category of {column}"), "index")
            found = df.withColumn(f"filled {column}", filled).join(
                known, F.col(f"filled {column}") == F.col(f"category of {column}"), "left"
            )
            number = F.coalesce("index", F.lit(size)).alias(f"index_{column}")
            df = found.select(*[F.col(f"`{name}`") for name in df.columns], number)
        return df

    def with_vectors(self, df: DataFrame) -> DataFrame:
        """Add ``one_hot_<column>``, a sparse vector as wide as the column has categories; indexes that ``with_indexes``
        has added are used."""
        if not self.sizes:
            return df
        indexes = [f"index_{column}" for column in self.sizes]
        encoder = OneHotEncoder(
            inputCols=indexes, outputCols=[f"one_hot_{column}" for column in self.sizes], handleInvalid="keep"
        )
        # The encoder learns a width from the largest index, so it is fitted on one row of largest indexes.
        widest = self._spark.createDataFrame([tuple(float(size - 1) for size in self.sizes.values())], indexes)
        numbered = df if set(indexes) <= set(df.columns) else self.with_indexes(df)
        doubled = numbered.withColumns({name: F.col(name).cast("double") for name in indexes})
        encoded = encoder.fit(widest).transform(doubled)
        return encoded.withColumns({name: F.col(name).cast("long") for name in indexes}).select(
            *[F.col(f"`{name}`") for name in [*df.columns, *encoder.getOutputCols()]]
        )
