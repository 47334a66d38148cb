import random

import pytest
from pyspark.sql import functions as F

from ebbline.operators import ranking


def scored(spark, pairs):
    return spark.createDataFrame(pairs, "label int, score double").repartition(3)


def brute(pairs):
    positives = [s for label, s in pairs if label]
    negatives = [s for label, s in pairs if not label]
    auc = None
    if positives and negatives:
        won = sum((p > n) + 0.5 * (p == n) for p in positives for n in negatives)
        auc = won / (len(positives) * len(negatives))
    precision = 0.0
    for threshold in sorted(set(s for _, s in pairs), reverse=True):
        at = [label for label, s in pairs if s >= threshold]
        gained = sum(label for label, s in pairs if s == threshold)
        if positives:
            precision += gained / len(positives) * sum(at) / len(at)
    return auc, precision


@pytest.mark.parametrize("ranges", [4, 512])
@pytest.mark.parametrize("case", ["ties", "distinct", "hot score", "one class", "no positives"])
def test_metrics_equal_brute_force(spark, monkeypatch, case, ranges):
    monkeypatch.setattr(ranking, "SCORE_RANGES", ranges)
    rng = random.Random(5)
    pairs = {
        "ties": [(rng.randrange(2), float(rng.randrange(6))) for _ in range(200)],
        "distinct": [(rng.randrange(2), rng.random()) for _ in range(250)],
        "hot score": [(rng.randrange(2), 0.5 if rng.random() < 0.4 else rng.random()) for _ in range(200)],
        "one class": [(1, rng.random()) for _ in range(20)],
        "no positives": [(0, rng.random()) for _ in range(20)],
    }[case]
    row = ranking.ranking_metrics(scored(spark, pairs)).first()
    auc, precision = brute(pairs)
    assert row["pr_auc"] == pytest.approx(precision, abs=1e-12)
    assert row["roc_auc"] is None if auc is None else row["roc_auc"] == pytest.approx(auc, abs=1e-12)
    assert row["positives"] == sum(label for label, _ in pairs)


def test_monotone_change_of_scores_changes_nothing(spark):
    rng = random.Random(1)
    df = scored(spark, [(rng.randrange(2), rng.random()) for _ in range(100)])
    first = ranking.ranking_metrics(df).first()
    assert ranking.ranking_metrics(df.withColumn("score", F.exp(F.col("score") * 9) - 4)).first() == first


@pytest.mark.parametrize("row", [(None, 0.1), (2, 0.1), (1, None), (1, float("nan"))])
def test_rows_that_cannot_be_ranked_fail(spark, row):
    with pytest.raises(Exception, match="must"):
        ranking.ranking_metrics(scored(spark, [(0, 0.2), row])).collect()


def test_evaluate_counts_cells_and_guards_empty_denominators(spark):
    schema = "churn int, prediction int, churn_probability double"
    df = spark.createDataFrame([(1, 1, 0.9), (0, 1, 0.8), (1, 0, 0.3), (0, 0, 0.2), (0, 0, 0.1)], schema)
    row = ranking.evaluate(df).first()
    assert list(row.asDict()) == ranking.METRICS
    assert (row["accuracy"], row["precision"], row["recall"], row["f1"]) == (0.6, 0.5, 0.5, 0.5)
    assert row["roc_auc"] == pytest.approx(5 / 6)
    none = ranking.evaluate(spark.createDataFrame([(1, 0, 0.2), (0, 0, 0.1)], schema)).first()
    assert (none["precision"], none["recall"], none["f1"]) == (0.0, 0.0, 0.0)
