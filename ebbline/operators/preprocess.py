"""Imputation, scaling and one-hot encoding as a pipeline of built-in stages.

Statistics are exact and come from aggregates; the fitted pipeline is a projection, an index lookup and an
assembler, so it can be saved, loaded and applied in one narrow pass.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import FeatureHasher, OneHotEncoder, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

from ebbline.operators.quantiles import ValueHistogram

LABEL_MARK = "="  # keeps an empty text a valid label


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (NumericType, BooleanType))]


def category_columns(df: DataFrame) -> list[str]:
    numeric = set(numeric_columns(df))
    return [name for name in df.columns if name not in numeric]


def _numeric(name: str, fill: float) -> F.Column:
    value = F.col(f"`{name}`").cast("double")
    return F.coalesce(F.when(~F.isnan(value), value), F.lit(fill))


def numeric_statistics(df: DataFrame, columns: list[str]) -> DataFrame:
    """``feature, median, mean, std`` per numeric column: exact median, then mean and population standard
    deviation after filling with it.  Columns without any value are left out."""
    medians = ValueHistogram(df, columns).quantiles({name: [0.5] for name in columns})
    filled = {name: found[0] for name, found in medians.items() if found[0] is not None}
    schema = "feature string, median double, mean double, std double"
    if not filled:
        return df.sparkSession.createDataFrame([], schema)
    row = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("feature"),
                    F.lit(median).alias("median"),
                    F.avg(_numeric(name, median)).alias("mean"),
                    F.stddev_pop(_numeric(name, median)).alias("std"),
                )
                for name, median in filled.items()
            ]
        ).alias("statistics")
    )
    return row.select(F.inline("statistics"))


def category_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """``feature, category, entries``, combined before the shuffle; missing values are left out."""
    texts = df.select([F.col(f"`{name}`").cast("string").alias(name) for name in columns])
    return (
        texts.unpivot([], columns, "feature", "category")
        .where("category IS NOT NULL")
        .groupBy("feature", "category")
        .agg(F.count(F.lit(1)).alias("entries"))
    )


def category_modes(df: DataFrame, columns: list[str]) -> DataFrame:
    """``feature, mode``: the most frequent category, the smallest of equally frequent ones."""
    best = F.struct((-F.col("entries")).alias("rank"), "category")
    return category_counts(df, columns).groupBy("feature").agg(F.min(best)["category"].alias("mode"))


def _sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _sql_double(value: float) -> str:
    return f"CAST('{value!r}' AS DOUBLE)"


@dataclass(frozen=True)
class PreprocessorStatistics:
    numeric: dict[str, tuple[float, float, float]]
    categories: dict[str, list[str]]
    modes: dict[str, str]
    hashed: dict[str, int] = field(default_factory=dict)

    @classmethod
    def of(
        cls,
        df: DataFrame,
        numeric: list[str],
        categorical: list[str],
        hashed: dict[str, int] | None = None,
        max_categories: int | None = None,
    ) -> PreprocessorStatistics:
        hashed = hashed or {}
        found = numeric_statistics(df, numeric).collect() if numeric else []
        by_name = {row["feature"]: (row["median"], row["mean"], row["std"]) for row in found}
        listed = [name for name in categorical if name not in hashed]
        categories, modes = cls._categories(df, listed, max_categories) if listed else ({}, {})
        if hashed:
            found = category_modes(df, list(hashed)).collect()
            modes |= {row["feature"]: row["mode"] for row in found if row["mode"] is not None}
        widths = {name: width for name, width in hashed.items() if name in modes}
        return cls({name: by_name[name] for name in numeric if name in by_name}, categories, modes, widths)

    @staticmethod
    def _categories(df: DataFrame, columns: list[str], max_categories: int | None) -> tuple[dict, dict]:
        """The encoder's dictionary lives in the model; a bound that the caller states is checked before it is
        fetched."""
        counts = category_counts(df, columns)
        if max_categories is not None:
            for row in counts.groupBy("feature").agg(F.count(F.lit(1)).alias("size")).collect():
                if row["size"] > max_categories:
                    raise ValueError(f"{row['feature']} has {row['size']} categories, more than the stated {max_categories}")
        found: dict[str, dict[str, int]] = {}
        for row in counts.collect():
            found.setdefault(row["feature"], {})[row["category"]] = row["entries"]
        categories = {name: sorted(found[name]) for name in columns if name in found}
        modes = {name: max(sorted(found[name]), key=found[name].get) for name in categories}
        return categories, modes

    def scaled_expression(self, name: str) -> str:
        """Filled and standardised value; a constant column becomes 0."""
        median, mean, std = self.numeric[name]
        value = f"CAST(`{name}` AS DOUBLE)"
        filled = f"coalesce(nanvl({value}, NULL), {_sql_double(median)})"
        return f"({filled} - {_sql_double(mean)}) / {_sql_double(std or 1.0)}"

    def stages(self) -> list:
        projected = [f"{self.scaled_expression(name)} AS `scaled_{name}`" for name in self.numeric]
        projected += [
            f"concat('{LABEL_MARK}', coalesce(CAST(`{name}` AS STRING), {_sql_text(mode)})) AS `filled_{name}`"
            for name, mode in self.modes.items()
        ]
        vector_parts = [f"scaled_{name}" for name in self.numeric]
        stages: list = [SQLTransformer(statement=f"SELECT *, {', '.join(projected)} FROM __THIS__")]
        if self.categories:
            names = list(self.categories)
            stages += [
                StringIndexerModel.from_labels(
                    [LABEL_MARK + label for label in labels],
                    inputCol=f"filled_{name}",
                    outputCol=f"index_{name}",
                    handleInvalid="keep",
                )
                for name, labels in self.categories.items()
            ]
            # "keep" adds one index for unknown categories and dropLast turns it into the zero vector.
            stages.append(
                OneHotEncoder(
                    inputCols=[f"index_{name}" for name in names],
                    outputCols=[f"one_hot_{name}" for name in names],
                    dropLast=True,
                )
            )
            vector_parts += [f"one_hot_{name}" for name in names]
        for name, width in self.hashed.items():
            stages.append(FeatureHasher(inputCols=[f"filled_{name}"], outputCol=f"hashed_{name}", numFeatures=width))
            vector_parts.append(f"hashed_{name}")
        stages.append(VectorAssembler(inputCols=vector_parts, outputCol="features"))
        return stages

    def feature_names(self) -> list[str]:
        one_hot = [f"{name}={category}" for name, found in self.categories.items() for category in found]
        hashed = [f"{name}#{at}" for name, width in self.hashed.items() for at in range(width)]
        return list(self.numeric) + one_hot + hashed


class Preprocessor(Estimator):
    """Numeric columns: median, then standard score.  Other columns: mode, then one-hot, or hashing where it is
    chosen."""

    def __init__(
        self,
        numeric: list[str],
        categorical: list[str],
        hashed: dict[str, int] | None = None,
        max_categories: int | None = None,
    ) -> None:
        super().__init__()
        self.numeric, self.categorical = numeric, categorical
        self.hashed, self.max_categories = hashed, max_categories

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        statistics = PreprocessorStatistics.of(
            dataset, self.numeric, self.categorical, self.hashed, self.max_categories
        )
        return Pipeline(stages=statistics.stages()).fit(dataset)


def build_preprocessor(
    features: DataFrame, hashed: dict[str, int] | None = None, max_categories: int | None = None
) -> Preprocessor:
    """Columns are assigned by type: numbers and booleans are scaled, everything else is encoded.

    ``hashed`` names text columns, with a width each, that are hashed instead of listed in a dictionary; the choice
    is the caller's and never depends on the data.  ``max_categories`` refuses longer dictionaries; without it there
    is no bound.
    """
    return Preprocessor(numeric_columns(features), category_columns(features), hashed, max_categories)
