import datetime as dt

import pytest

from ebbline.operators import runs

T0 = dt.datetime(2024, 1, 1)
METRICS = ["accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc"]


def table(spark, *rows, params=True):
    names = [f"`metrics.{m}` double" for m in METRICS] + ["`metrics.cv_pr_auc` double"]
    schema = "run_name string, run_id string, start_time timestamp, status string, " + ", ".join(names)
    if params:
        schema += ", `params.n_estimators` string, `params.max_depth` string"
    return spark.createDataFrame(rows, schema)


def run(name, run_id, day, pr_auc, status="FINISHED", metric=0.123456, cv=None, params=("200", None)):
    return (name, run_id, T0 + dt.timedelta(day), status, *[metric] * 5, pr_auc, cv, *params)


def two(spark, base, tuned):
    return table(spark, run("random_forest", "b", 0, base), run("random_forest_tuned", "t", 0, tuned, cv=0.7))


def test_latest_finished_run_of_each_name_in_order(spark):
    df = table(
        spark,
        run("random_forest_tuned", "t1", 5, 0.5),
        run("random_forest", "b1", 1, 0.5),
        run("random_forest", "b2", 3, 0.6),
        run("random_forest", "b3", 3, 0.7),
        run("random_forest", "b4", 9, 0.9, status="FAILED"),
        run("dummy", "d", 10, 0.1),
    )
    latest = runs.get_latest_successful_runs(df)
    assert [row["run_id"] for row in latest.collect()] == ["b3", "t1"]


def test_missing_names_are_reported(spark):
    with pytest.raises(ValueError, match="random_forest_tuned"):
        runs.get_latest_successful_runs(table(spark, run("random_forest", "b", 0, 0.5)))


def test_comparison_is_rounded_and_keeps_existing_metrics(spark):
    comparison = runs.build_comparison(two(spark, 0.5, 0.55555).drop("metrics.recall"))
    assert comparison.columns == [
        "run_name", "run_id", "start_time", "accuracy", "precision", "f1", "roc_auc", "pr_auc", "cv_pr_auc"
    ]
    assert {row["run_id"]: (row["accuracy"], row["pr_auc"]) for row in comparison.collect()} == {
        "b": (0.1235, 0.5), "t": (0.1235, 0.5556)
    }


def test_metrics_must_be_complete(spark):
    df = two(spark, 0.5, 0.6)
    assert runs.get_metrics(df).count() == 12
    with pytest.raises(ValueError, match="recall"):
        runs.get_metrics(df.drop("metrics.recall"))
    with pytest.raises(ValueError, match="pr_auc"):
        runs.get_metrics(two(spark, None, 0.6))


def test_parameters_that_were_not_logged_are_named(spark):
    found = runs.get_tuning_parameters(two(spark, 0.5, 0.6).where("run_id = 't'"))
    values = {row["parameter"]: row["value"] for row in found.collect()}
    assert values == {
        "n_estimators": "200",
        **dict.fromkeys(
            ["max_depth", "max_features", "min_samples_leaf", "min_samples_split", "class_weight"],
            "nicht protokolliert",
        ),
    }


@pytest.mark.parametrize(
    "base,tuned,winner", [(0.5, 0.6, "random_forest_tuned"), (0.6, 0.6, "random_forest"), (0.6, 0.5, "random_forest")]
)
def test_tuned_run_wins_only_when_strictly_better(spark, base, tuned, winner):
    row = runs.select_model(two(spark, base, tuned)).first()
    assert row["selected_model"] == winner
    assert row["selected_run_id"] == ("t" if winner == "random_forest_tuned" else "b")
    assert (row["baseline_pr_auc"], row["tuned_pr_auc"], row["cv_pr_auc"]) == (base, tuned, 0.7)
    assert row["pr_auc_difference"] == pytest.approx(tuned - base)


def test_selection_may_use_another_metric(spark):
    df = table(spark, run("random_forest", "b", 0, 0.9, metric=0.1), run("random_forest_tuned", "t", 0, 0.1, metric=0.2))
    assert runs.select_model(df, metric="f1").first()["selected_model"] == "random_forest_tuned"


def selections(spark, *rows):
    return spark.createDataFrame(
        rows, "run_name string, run_id string, start_time timestamp, status string, `params.selected_run_id` string"
    )


def test_selected_run_is_that_of_the_latest_selection(spark):
    df = selections(
        spark,
        ("model_selection", "1", T0, "FINISHED", "old"),
        ("model_selection", "2", T0 + dt.timedelta(1), "FINISHED", "new"),
        ("model_selection", "3", T0 + dt.timedelta(2), "FAILED", "failed"),
        ("random_forest", "4", T0 + dt.timedelta(3), "FINISHED", "other"),
    )
    assert runs.get_selected_run_id(df) == "new"
    with pytest.raises(ValueError, match="no finished"):
        runs.get_selected_run_id(df.where("run_id = '4'"))
    with pytest.raises(ValueError, match="names no"):
        runs.get_selected_run_id(selections(spark, ("model_selection", "1", T0, "FINISHED", None)))


def test_artifact_matches_by_source_run_or_run(spark):
    rows = [
        ("m1", "r1", None, "READY", T0),
        ("m2", None, "r1", "READY", T0 + dt.timedelta(1)),
        ("m3", "r1", "r1", "READY", T0 + dt.timedelta(1)),
        ("m4", "r1", None, "FAILED", T0 + dt.timedelta(2)),
        ("m5", "r2", "r2", "READY", T0 + dt.timedelta(3)),
    ]
    df = spark.createDataFrame(
        rows, "model_id string, source_run_id string, run_id string, status string, creation_time timestamp"
    )
    assert [row["model_id"] for row in runs.get_logged_model(df, "r1").collect()] == ["m3"]
    with pytest.raises(ValueError, match="r9"):
        runs.get_logged_model(df, "r9")


def test_every_absent_metric_is_named_however_many_runs(spark):
    rows = [run(f"r{n}", str(n), 0, None if n == 12 else 0.5) for n in range(13)]
    df = table(spark, *rows).drop("metrics.accuracy")
    with pytest.raises(ValueError, match="accuracy.*pr_auc"):
        runs.get_metrics(df)
