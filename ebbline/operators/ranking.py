"""Ranking and classification metrics, exact and distributed.

Rows are first combined per score.  Running totals over the scores are then taken inside score ranges, with
the totals of the higher ranges added, so no single task sees all scores.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ebbline.functions.values import share
from ebbline.operators.quantiles import split_points

METRICS = ["accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc"]
SCORE_RANGES = 2048


def _checked(condition: Column, value: Column, message: str) -> Column:
    return F.when(condition, value).otherwise(F.raise_error(F.lit(message)).cast("double"))


def running_counts(scored: DataFrame, label: str, score: str, extra: dict[str, Column] | None = None) -> DataFrame:
    """One row per distinct score: ``positives, entries`` and their totals from the highest score down.

    ``extra`` adds further summed columns per score.
    """
    extra = extra or {}
    label_value, score_value = F.col(label), F.col(score).cast("double")
    rows = scored.select(
        _checked(
            score_value.isNotNull() & ~F.isnan(score_value), score_value, f"{score} must not be null or NaN"
        ).alias("score"),
        _checked(label_value.isin(0, 1), label_value.cast("double"), f"{label} must be 0 or 1").alias("label"),
        *[expression.alias(name) for name, expression in extra.items()],
    )
    by_score = rows.groupBy("score").agg(
        F.count_if(F.col("label") == 1).alias("positives"),
        F.count(F.lit(1)).alias("entries"),
        *[F.sum(name).alias(name) for name in extra],
    )
    splits = split_points(rows, ["score"], SCORE_RANGES)["score"] or [float("-inf"), 0.0, float("inf")]
    ranged = Bucketizer(splits=splits, inputCol="score", outputCol="score_range").transform(by_score)
    higher = W.orderBy(F.desc("score_range")).rowsBetween(W.unboundedPreceding, -1)
    # One row per score range, so this window without partitions and the broadcast stay small.
    totals = ranged.groupBy("score_range").agg(F.sum("positives").alias("p"), F.sum("entries").alias("n"))
    before = totals.select(
        "score_range",
        F.coalesce(F.sum("p").over(higher), F.lit(0)).alias("positives_before"),
        F.coalesce(F.sum("n").over(higher), F.lit(0)).alias("entries_before"),
    )
    inside = W.partitionBy("score_range").orderBy(F.desc("score"))
    return ranged.join(F.broadcast(before), "score_range").select(
        "score",
        "positives",
        "entries",
        (F.col("positives_before") + F.sum("positives").over(inside)).alias("positives_upto"),
        (F.col("entries_before") + F.sum("entries").over(inside)).alias("entries_upto"),
        *extra,
    )


def _ranking_aggregates() -> dict[str, Column]:
    positives, entries = F.col("positives").cast("double"), F.col("entries").cast("double")
    upto = F.col("positives_upto").cast("double")
    all_positives = F.sum(positives)
    all_negatives = F.sum(entries - positives)
    ordered_pairs = F.sum((entries - positives) * (upto - positives / 2))
    precision_steps = F.sum(positives * upto / F.col("entries_upto"))
    return {
        "roc_auc": F.try_divide(ordered_pairs, all_positives * all_negatives),
        "pr_auc": share(precision_steps, all_positives),
    }


def ranking_metrics(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """``positives, negatives, roc_auc, pr_auc`` in one row.

    ``pr_auc`` is average precision in step form.  ``roc_auc`` gives ties half a point and is null when only
    one class occurs.
    """
    return running_counts(scored, label, score).agg(
        F.coalesce(F.sum("positives"), F.lit(0)).alias("positives"),
        F.coalesce(F.sum(F.col("entries") - F.col("positives")), F.lit(0)).alias("negatives"),
        *[expression.alias(name) for name, expression in _ranking_aggregates().items()],
    )


def grouped_average_precision(
    scored: DataFrame, groups: list[str], label: str = "label", score: str = "score"
) -> DataFrame:
    """Average precision of every group: ``groups``, ``positives``, ``entries``, ``pr_auc``.

    All groups are evaluated together.  Score ranges are common to them, so a group has at most ``SCORE_RANGES``
    totals and no task sees all scores of one.
    """
    score_value, label_value = F.col(score).cast("double"), F.col(label)
    rows = scored.select(
        *groups,
        _checked(
            score_value.isNotNull() & ~F.isnan(score_value), score_value, f"{score} must not be null or NaN"
        ).alias("score"),
        _checked(label_value.isin(0, 1), label_value.cast("double"), f"{label} must be 0 or 1").alias("label"),
    )
    splits = split_points(rows, ["score"], SCORE_RANGES)["score"] or [float("-inf"), 0.0, float("inf")]
    by_score = rows.groupBy(*groups, "score").agg(
        F.count_if(F.col("label") == 1).alias("positives"), F.count(F.lit(1)).alias("entries")
    )
    ranged = Bucketizer(splits=splits, inputCol="score", outputCol="score_range").transform(by_score)
    higher = W.partitionBy(*groups).orderBy(F.desc("score_range")).rowsBetween(W.unboundedPreceding, -1)
    before = (
        ranged.groupBy(*groups, "score_range")
        .agg(F.sum("positives").alias("p"), F.sum("entries").alias("n"))
        .select(
            *groups,
            "score_range",
            F.coalesce(F.sum("p").over(higher), F.lit(0)).alias("positives_before"),
            F.coalesce(F.sum("n").over(higher), F.lit(0)).alias("entries_before"),
        )
    )
    inside = W.partitionBy(*groups, "score_range").orderBy(F.desc("score"))
    steps = ranged.join(before, [*groups, "score_range"]).select(
        *groups,
        "positives",
        "entries",
        (F.col("positives_before") + F.sum("positives").over(inside)).alias("positives_upto"),
        (F.col("entries_before") + F.sum("entries").over(inside)).alias("entries_upto"),
    )
    return steps.groupBy(*groups).agg(
        F.sum("positives").alias("positives"),
        F.sum("entries").alias("entries"),
        _ranking_aggregates()["pr_auc"].alias("pr_auc"),
    )


def evaluate(
    scored: DataFrame,
    label: str = "churn",
    prediction: str = "prediction",
    probability: str = "churn_probability",
) -> DataFrame:
    """The six model metrics in one row; a metric with an empty denominator is 0."""
    truth, guess = F.col(label) == 1, F.col(prediction) == 1
    cells = {
        "hits": (truth & guess).cast("int"),
        "false_alarms": (~truth & guess).cast("int"),
        "misses": (truth & ~guess).cast("int"),
        "correct": (truth == guess).cast("int"),
    }
    counts = running_counts(scored, label, probability, cells)
    sums = counts.agg(
        F.sum("entries").alias("entries"),
        *[F.sum(name).alias(name) for name in cells],
        *[expression.alias(name) for name, expression in _ranking_aggregates().items()],
    )
    hits, alarms, misses = F.col("hits"), F.col("false_alarms"), F.col("misses")
    return sums.select(
        share(F.col("correct"), F.col("entries")).alias("accuracy"),
        share(hits, hits + alarms).alias("precision"),
        share(hits, hits + misses).alias("recall"),
        share(2 * hits, 2 * hits + alarms + misses).alias("f1"),
        "roc_auc",
        "pr_auc",
    )


def metrics_by_ranks(
    scored: DataFrame, label: str = "label", prediction: str = "prediction", probability: str = "churn_probability"
) -> DataFrame:
    """The six metrics another way, with ``test_rows`` and ``test_ones``: a check of recorded values.

    The area under the curve comes from the positives' average ranks, the average precision from the share of
    positives among the rows that score at least as high, both by window functions over single rows.  One task
    orders all rows, so this is for the evaluation of a test part, not for a whole corpus.
    """
    truth, guess = F.col(label).cast("int"), F.col(prediction).cast("int")
    rows = scored.select(truth.alias("y"), guess.alias("p"), F.col(probability).alias("s"))
    rising, falling = W.orderBy("s"), W.orderBy(F.desc("s"))
    tied = W.partitionBy("s")
    ranked = rows.select(
        "y",
        "p",
        (F.rank().over(rising) + (F.count(F.lit(1)).over(tied) - 1) / 2).alias("rank"),
        (F.sum("y").over(falling) / F.count(F.lit(1)).over(falling)).alias("precision_here"),
    )
    y, p = F.col("y"), F.col("p")
    sums = ranked.agg(
        F.count(F.lit(1)).alias("test_rows"),
        F.sum("y").alias("test_ones"),
        F.avg((y == p).cast("int")).alias("accuracy"),
        F.sum(y * p).alias("hits"),
        F.sum("p").alias("guessed"),
        F.sum(F.when(y == 1, F.col("rank"))).alias("rank_sum"),
        F.avg(F.when(y == 1, F.col("precision_here"))).alias("pr_auc"),
    )
    ones, zeros = F.col("test_ones"), F.col("test_rows") - F.col("test_ones")
    return sums.select(
        "test_rows",
        "test_ones",
        "accuracy",
        share(F.col("hits"), F.col("guessed")).alias("precision"),
        share(F.col("hits"), ones).alias("recall"),
        share(2 * F.col("hits"), F.col("guessed") + ones).alias("f1"),
        F.try_divide(F.col("rank_sum") - ones * (ones + 1) / 2, ones * zeros).alias("roc_auc"),
        "pr_auc",
    )
