import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ebbline.columns import FEATURE_COLUMNS, ID_COLUMN
from ebbline.operators import models, ranking, scoring, tuning
from ebbline.plans import jobs


@pytest.fixture(scope="module")
def trained(training):
    return models.train_models(training, only=["dummy", "logistic_regression"])


def test_each_model_has_a_finished_run_with_all_metrics(trained):
    runs = {row["run_name"]: row.asDict() for row in trained.runs.collect()}
    assert set(runs) == {"dummy", "logistic_regression"}
    for run in runs.values():
        assert run["status"] == "FINISHED" and run["run_id"] and run["params.test_size"] == "0.2"
        assert all(run[f"metrics.{name}"] is not None for name in ranking.METRICS)
    assert runs["dummy"]["metrics.roc_auc"] == 0.5
    assert runs["dummy"]["params.serving_candidate"] == "false"
    assert runs["logistic_regression"]["metrics.roc_auc"] > 0.7


def test_prior_is_the_share_of_positive_training_labels(trained, training):
    train, _ = models.split_training_data(training)
    prior = train.agg(F.avg("label")).first()[0]
    row = scoring.score(trained.models["dummy"], training).first()
    assert row["churn_probability"] == pytest.approx(prior)
    assert (row["prediction"], row["label_text"]) == (0, "Kein Churn")


def test_balanced_logistic_regression_meets_its_optimum(spark, trained, training):
    """At the optimum the weighted gradient of loss plus half the squared weights is zero."""
    train, _ = models.split_training_data(training)
    model = trained.models["logistic_regression"]
    weighted = models.with_balanced_weight(model.transform(train))
    pulled = weighted.select("weight", "label", vector_to_array("probability")[1].alias("p"), vector_to_array("features").alias("x"))
    coefficients = model.stages[-1].coefficients.toArray()
    gradient = pulled.select(
        *[F.sum(F.col("weight") * (F.col("p") - F.col("label")) * F.col("x")[at]) for at in range(len(coefficients))],
        F.sum(F.col("weight") * (F.col("p") - F.col("label"))),
    ).first()
    assert list(gradient)[:-1] == pytest.approx(list(-coefficients), abs=2e-2)
    assert gradient[-1] == pytest.approx(0.0, abs=2e-2)


def test_class_weights(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "churn int")
    assert {tuple(row) for row in models.class_weights(df).collect()} == {(0, 3, 4 / 6), (1, 1, 2.0)}
    assert [tuple(row) for row in models.class_weights(df.where("churn = 1")).collect()] == [(1, 1, 1.0)]


def test_training_needs_labels_of_both_classes(training):
    with pytest.raises(ValueError, match="both classes"):
        models.train_models(training.where("churn = 1"), only=["dummy"])
    with pytest.raises(ValueError, match="have no churn"):
        models.train_models(training.withColumn("churn", F.nullif("churn", F.lit(1))), only=["dummy"])


def test_threshold_moves_the_class(trained, training):
    model = trained.models["logistic_regression"]
    low = scoring.score(model, training, threshold=0.1).agg(F.sum("prediction")).first()[0]
    high = scoring.score(model, training, threshold=0.9).agg(F.sum("prediction")).first()[0]
    assert low > high
    info = {"model_name": "m", "model_version": "1", "model_alias": "Champion"}
    row = scoring.score(model, training, model_info=info).first()
    assert (row["model_name"], row["model_version"], row["model_alias"]) == ("m", "1", "Champion")


def test_stored_pipeline_scores_like_the_fitted_one(trained, training, tmp_path):
    rows, summary = jobs.validation_job(
        training, trained.models["logistic_regression"], str(tmp_path / "model"), sample_size=30
    )
    numbered = rows.select(ID_COLUMN, "sample_row").collect()
    assert [row["sample_row"] for row in numbered] == list(range(1, 31))
    assert numbered[0][ID_COLUMN] == "u000"
    row = summary.first()
    assert (row["sample_size"], row["prediction_agreement"]) == (30, 1.0)
    assert 0 <= row["minimum_probability"] <= row["maximum_probability"] <= 1


def test_search_ranks_settings_and_refits_the_best(training):
    space = {
        "n_estimators": [3, 5],
        "max_depth": [2, None],
        "min_samples_leaf": [1, 4],
        "max_features": ["sqrt", "0.5"],
        "class_weight": [None, "balanced"],
    }
    tuned = tuning.search_forest(training, iterations=3, folds=2, space=space)
    rows = tuned.cv_results.collect()
    assert [row["rank_test_score"] for row in rows][0] == 1 and len(rows) == 3
    for row in rows:
        assert row["mean_test_score"] == pytest.approx((row["split0_test_score"] + row["split1_test_score"]) / 2)
        assert row["mean_train_score"] >= 0
    run = tuned.runs.first().asDict()
    assert run["metrics.cv_pr_auc"] == rows[0]["mean_test_score"]
    assert run["params.n_iter"] == "3" and run["params.search_method"] == "randomized_search"
    assert tuned.model.transform(scoring.prepare_input(training)).count() == 200


def test_grouped_average_precision_equals_single_groups(spark):
    rows = [(n % 3, "a" if n % 2 else "b", float(n % 7 < 3), (n * 37 % 11) / 11) for n in range(300)] + [(9, "a", 0.0, 0.5)]
    scored = spark.createDataFrame(rows, "setting int, part string, label double, score double")
    found = ranking.grouped_average_precision(scored, ["setting", "part"]).collect()
    assert len(found) == 7
    for row in found:
        own = scored.where((F.col("setting") == row["setting"]) & (F.col("part") == row["part"]))
        one = ranking.ranking_metrics(own).first()
        assert row["pr_auc"] == pytest.approx(one["pr_auc"]) and row["positives"] == one["positives"] and row["entries"] == own.count()
    assert ranking.grouped_average_precision(scored.limit(0), ["setting"]).count() == 0
    with pytest.raises(Exception, match="must be 0 or 1"):
        ranking.grouped_average_precision(scored.withColumn("label", F.lit(2.0)), ["setting"]).collect()


def test_search_scores_equal_single_evaluations(training):
    space = {"n_estimators": [3], "max_depth": [2, 4], "min_samples_leaf": [1], "max_features": ["sqrt"], "class_weight": [None]}
    tuned = tuning.search_forest(training, iterations=2, folds=2, space=space)
    train, _ = models.split_training_data(training)
    folded = tuning.stratified_folds(train, models.LABEL, ID_COLUMN, 2, models.SEED)
    fit_part, held_out = folded.where("fold <> 0"), folded.where("fold = 0")
    preprocessor = tuning.build_preprocessor(fit_part.select(FEATURE_COLUMNS)).fit(fit_part)
    prepared = models.prepared_rows(preprocessor, fit_part, fit_part.count())
    evaluator = tuning.AveragePrecisionEvaluator()
    for row in tuned.cv_results.collect():
        model = tuning.forest_for(tuning.sample_settings(2, space=space)[row["setting"]]).fit(prepared)
        assert row["split0_train_score"] == pytest.approx(evaluator.evaluate(model.transform(prepared)))
        assert row["split0_test_score"] == pytest.approx(evaluator.evaluate(model.transform(preprocessor.transform(held_out))))


def test_forest_rows_are_bounded_in_class_shares(training):
    train, _ = models.split_training_data(training)
    rows, ones = train.count(), train.agg(F.sum("label")).first()[0]
    fewer = models.bounded_training_rows(train, 40)
    assert fewer.count() == 40 and fewer.columns == train.columns
    assert fewer.agg(F.sum("label")).first()[0] == pytest.approx(40 * ones / rows, abs=1)
    assert sorted(map(str, fewer.collect())) == sorted(map(str, models.bounded_training_rows(train, 40).collect()))
    assert models.bounded_training_rows(train, None) is train and models.bounded_training_rows(train, rows).count() == rows
    tuned = tuning.search_forest(training, iterations=1, folds=2, space={"n_estimators": [3], "max_depth": [2], "min_samples_leaf": [1], "max_features": ["sqrt"], "class_weight": ["balanced"]}, forest_rows=60)
    sizes = models.forest_sizes(tuned.model.stages[-1]).collect()
    assert len(sizes) == 3 and all(row["depth"] <= 2 and row["nodes"] <= 7 and row["nodes"] % 2 for row in sizes)


def test_small_frames_use_few_tasks(spark):
    assert models.in_tasks_of_size(spark.range(0, 5000, 1, 8), 5000).select(F.spark_partition_id()).distinct().count() == 3
    assert models.in_tasks_of_size(spark.range(0, 5000, 1, 2), 10**6).select(F.spark_partition_id()).distinct().count() == 2


def test_large_frames_use_no_more_tasks_than_run_at_once(spark, monkeypatch):
    many = spark.range(0, 5000, 1, 40)
    tasks = lambda rows, busy=None: models.in_tasks_of_size(many, rows, busy=busy).rdd.getNumPartitions()
    assert tasks(10**6) == spark.sparkContext.defaultParallelism == 8
    assert tasks(5000, busy=1) == 1
    monkeypatch.setattr(models, "MOST_ROWS_PER_TASK", 100_000)
    assert tasks(10**6) == 10 and tasks(10**9) == 40


def test_search_scores_with_one_model_at_a_time(training, monkeypatch):
    """Each plan that scores holds the trees of one forest; scores meet as stored rows."""
    space = {"n_estimators": [3], "max_depth": [2, 3], "min_samples_leaf": [1], "max_features": ["sqrt"], "class_weight": [None]}
    read = []

    def evaluated(scored, groups, *columns):
        read.append((scored.inputFiles(), scored.groupBy(groups).count().count()))
        return ranking.grouped_average_precision(scored, groups, *columns)

    monkeypatch.setattr(tuning, "grouped_average_precision", evaluated)
    assert tuning.search_forest(training, iterations=2, folds=2, space=space).cv_results.count() == 2
    ((files, groups),) = read
    assert groups == 2 * 2 * 2 and {name.split("setting=")[1].split("/")[0] for name in files} == {"0", "1"}


def test_metrics_by_ranks_equal_the_scalable_ones(spark):
    rows = [(float(n % 5 < 2), int(n % 3 == 0), (n * 29 % 13) / 13) for n in range(200)]
    scored = spark.createDataFrame(rows, "label double, prediction int, churn_probability double")
    other = ranking.evaluate(scored, "label").first().asDict()
    again = ranking.metrics_by_ranks(scored, "label").first().asDict()
    assert (again["test_rows"], again["test_ones"]) == (200, 80)
    assert all(again[name] == pytest.approx(other[name]) for name in ranking.METRICS)


def test_settings_are_seeded_and_distinct():
    first = tuning.sample_settings(20, 42)
    assert first == tuning.sample_settings(20, 42) and first != tuning.sample_settings(20, 1)
    assert len({tuple(setting.items()) for setting in first}) == 20
    assert len(tuning.sample_settings(10**6)) == 3 * 4 * 4 * 3 * 2
    assert tuning.forest_for({**first[0], "max_depth": None}).getMaxDepth() == 30


def test_evaluator_is_average_precision(spark):
    df = spark.createDataFrame([(1.0, [0.1, 0.9]), (0.0, [0.2, 0.8]), (1.0, [0.7, 0.3])], "label double, probability array<double>")
    evaluator = tuning.AveragePrecisionEvaluator()
    assert evaluator.evaluate(df) == pytest.approx(0.5 + 0.5 * 2 / 3)
    assert evaluator.isLargerBetter()


def test_forest_follows_its_settings(training):
    forest = models.random_forest()
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getSeed()) == (250, 12, 42)
    assert forest.getWeightCol() == "weight"
    assert models.logistic_regression(10).getMaxIter() == 1000
    assert set(models.candidate_models(10)) == {"dummy", "logistic_regression", "random_forest"}


def test_agreement_counts_what_cannot_be_paired(spark):
    schema = "user_id string, prediction int"
    a = spark.createDataFrame([("a", 1), ("b", 0), ("c", 1), ("r", 1), ("r", 0), (None, 1)], schema)
    b = spark.createDataFrame([("a", 1), ("b", 1), ("d", 1), ("r", 1), (None, 1)], schema)
    row = scoring.agreement(a, b).first()
    assert (row["paired_ids"], row["prediction_agreement"]) == (2, 0.5)
    assert (row["unmatched_rows"], row["repeated_ids"]) == (4, 1)


@pytest.mark.parametrize(
    "row,rule",
    [((2, 0.5), "classes"), ((None, 0.5), "classes"), ((1, 1.5), "outside"), ((1, float("nan")), "outside"), ((1, None), "outside")],
)
def test_invalid_scores_are_refused(spark, row, rule):
    df = spark.createDataFrame([(0, 0.0), (1, 1.0), row], "prediction int, churn_probability double")
    scoring.validate_predictions(df.limit(2))
    with pytest.raises(ValueError, match=rule):
        scoring.validate_predictions(df)


def test_models_load_as_plain_pipelines(trained, training, tmp_path):
    path = str(tmp_path / "prior")
    trained.models["dummy"].save(path)
    loaded = PipelineModel.load(path)
    assert scoring.score(loaded, training.select(ID_COLUMN, *FEATURE_COLUMNS)).count() == 200
