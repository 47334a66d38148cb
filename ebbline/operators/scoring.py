"""Scoring input, batch scoring and checks of scored output."""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ebbline.columns import FEATURE_COLUMNS, ID_COLUMN, STRING_FEATURES
from ebbline.functions.values import blank_to_null, label_text
from ebbline.operators.forests import with_probability

SAMPLE_SIZE = 100  # fixed value


def prepare_input(df: DataFrame, keep: tuple[str, ...] = (), blanks_to_null: bool = False) -> DataFrame:
    """The model's features in order: texts as text, everything else as double, absent columns as null."""

    def aligned(name: str) -> Column:
        value = F.col(name) if name in df.columns else F.lit(None)
        if name not in STRING_FEATURES:
            return value.cast("double").alias(name)
        text = value.cast("string")
        return (blank_to_null(text) if blanks_to_null else text).alias(name)

    return df.select(*keep, *[aligned(name) for name in FEATURE_COLUMNS])


def churn_probability(scored: DataFrame) -> Column:
    if isinstance(scored.schema["probability"].dataType, VectorUDT):
        return vector_to_array("probability")[1]
    return F.col("probability")[1]


def score(
    model: Transformer,
    df: DataFrame,
    keep: tuple[str, ...] = (ID_COLUMN,),
    threshold: float = 0.5,
    model_info: dict[str, str] | None = None,
) -> DataFrame:
    """Probability of churn and class for every row, as a narrow pass over the input.

    A probability equal to the threshold is class 0, as it is when the larger of two equal votes is looked up.
    """
    ready = prepare_input(df, keep)
    scored = with_probability(model, ready)
    scored = model.transform(ready) if scored is None else scored
    probability = churn_probability(scored)
    named = [F.lit(value).alias(name) for name, value in (model_info or {}).items()]
    return scored.select(
        *keep,
        (probability > threshold).cast("int").alias("prediction"),
        probability.alias("churn_probability"),
        *named,
    ).withColumn("label_text", label_text(F.col("prediction")))


def top_sample(df: DataFrame, order_column: str = ID_COLUMN, size: int = SAMPLE_SIZE) -> DataFrame:
    """The first rows by id, numbered from 1.  Numbering sees only those rows."""
    first = df.orderBy(order_column).limit(size)
    return first.withColumn("sample_row", F.row_number().over(W.orderBy(order_column)))


def prediction_rules(
    scored: DataFrame, prediction: str = "prediction", probability: str = "churn_probability"
) -> DataFrame:
    """Violation counts of scored rows, in the order they are enforced."""
    value = F.col(probability)
    rules = {
        "class_is_binary": F.count_if(~F.coalesce(F.col(prediction).isin(0, 1), F.lit(False))),
        "probability_in_range": F.count_if(~F.coalesce(value.between(0, 1), F.lit(False)) | F.isnan(value)),
        "probability_present": F.count_if(value.isNull() | F.isnan(value)),
    }
    names = list(rules)
    return scored.agg(*[rule.alias(name) for name, rule in rules.items()]).unpivot([], names, "rule", "violations")


def validate_predictions(
    scored: DataFrame, prediction: str = "prediction", probability: str = "churn_probability"
) -> None:
    texts = {
        "class_is_binary": "the model returned classes other than 0 and 1",
        "probability_in_range": "at least one probability is outside [0, 1]",
        "probability_present": "at least one probability is missing",
    }
    for row in prediction_rules(scored, prediction, probability).collect():
        if row["violations"]:
            raise ValueError(f"{texts[row['rule']]}: {row['violations']} rows")


def agreement(
    first: DataFrame, second: DataFrame, id_column: str = ID_COLUMN, prediction: str = "prediction"
) -> DataFrame:
    """How often two scorings of the same ids agree.

    Both sides are stacked and grouped by id rather than joined: a null or repeated id then costs one combined row
    instead of pairs.  Such ids cannot be paired row by row and are counted apart.  A missing class agrees with
    nothing.
    """
    row_id, guess, nothing = F.col(id_column).alias("id"), F.col(prediction), F.lit(None).cast("int")
    sides = first.select(row_id, guess.alias("a"), nothing.alias("b"))
    other = second.select(row_id, nothing.alias("a"), guess.alias("b"))
    per_id = (
        sides.withColumn("in_a", F.lit(1))
        .withColumn("in_b", F.lit(0))
        .unionByName(other.withColumn("in_a", F.lit(0)).withColumn("in_b", F.lit(1)))
        .groupBy("id")
        .agg(
            F.sum("in_a").alias("in_a"),
            F.sum("in_b").alias("in_b"),
            F.max("a").alias("a"),
            F.max("b").alias("b"),
        )
    )
    paired = F.col("id").isNotNull() & (F.col("in_a") == 1) & (F.col("in_b") == 1)
    unmatched = F.col("id").isNull() | (F.col("in_a") == 0) | (F.col("in_b") == 0)
    return per_id.agg(
        F.count_if(paired).alias("paired_ids"),
        F.coalesce(F.sum(F.when(unmatched, F.col("in_a") + F.col("in_b"))), F.lit(0)).alias("unmatched_rows"),
        F.count_if(~unmatched & ~paired).alias("repeated_ids"),
        F.avg(F.when(paired, F.coalesce(F.col("a") == F.col("b"), F.lit(False)).cast("double"))).alias("prediction_agreement"),
    )


def score_summary(
    scored: DataFrame, prediction: str = "prediction", probability: str = "churn_probability"
) -> DataFrame:
    return scored.agg(
        F.count(F.lit(1)).alias("sample_size"),
        F.min(probability).alias("minimum_probability"),
        F.max(probability).alias("maximum_probability"),
        F.sum(F.col(prediction).cast("long")).alias("predicted_churners"),
    )
