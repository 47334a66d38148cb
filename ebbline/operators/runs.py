"""Comparison of recorded runs and choice of the model to use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.operators.ranking import METRICS

# Fixed values.
BASELINE, TUNED = "random_forest", "random_forest_tuned"
FINISHED = "FINISHED"
READY = "READY"
SELECTION = "model_selection"
COMPARED_METRICS = [*METRICS, "cv_pr_auc"]
TUNING_PARAMETERS = [
    "n_estimators",
    "max_depth",
    "max_features",
    "min_samples_leaf",
    "min_samples_split",
    "class_weight",
]
NOT_LOGGED = "nicht protokolliert"
# End of fixed values.


def _metric(name: str) -> Column:
    return F.col(f"`metrics.{name}`")


def latest_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last row of every key.  Each task keeps one row per key before the shuffle."""
    last = F.max_by(F.struct("*"), F.struct(*order)).alias("latest")
    return df.groupBy(F.col(key).alias("group_key")).agg(last).select("latest.*")


def get_latest_successful_runs(runs: DataFrame, run_names: tuple[str, ...] = (BASELINE, TUNED)) -> DataFrame:
    """The latest finished run of each name, in the order of the names; the greater run id breaks a tie."""
    finished = runs.where((F.col("status") == FINISHED) & F.col("run_name").isin(*run_names))
    latest = latest_per_key(finished, "run_name", ["start_time", "run_id"])
    # One row per asked name: these are fetched once, and whatever reads them later does not read the runs again.
    found = {row["run_name"]: row for row in latest.collect()}
    absent = sorted(set(run_names) - set(found))
    if absent:
        raise ValueError(f"no finished run with the name: {absent}")
    return runs.sparkSession.createDataFrame([found[name] for name in run_names], latest.schema)


def build_comparison(latest: DataFrame) -> DataFrame:
    """Name, id, start and the metrics that exist, rounded to four digits."""
    metrics = [name for name in COMPARED_METRICS if f"metrics.{name}" in latest.columns]
    return latest.withColumnsRenamed({f"metrics.{name}": name for name in metrics}).select(
        "run_name", "run_id", "start_time", *[F.round(name, 4).alias(name) for name in metrics]
    )


def missing_metrics(runs: DataFrame) -> DataFrame:
    """``run_name, metric`` for every model metric that is absent or null."""
    values = {
        name: _metric(name) if f"metrics.{name}" in runs.columns else F.lit(None) for name in METRICS
    }
    wide = runs.select("run_name", *[value.cast("double").alias(name) for name, value in values.items()])
    long = wide.unpivot(["run_name"], METRICS, "metric", "value")
    return long.where(F.col("value").isNull() | F.isnan("value")).select("run_name", "metric")


def get_metrics(run: DataFrame) -> DataFrame:
    """``run_name, metric, value`` of complete runs; fails if one of the model metrics is absent or null."""
    absent = [row["metric"] for row in missing_metrics(run).select("metric").distinct().collect()]
    if absent:
        raise ValueError(f"metrics missing in the run: {[name for name in METRICS if name in absent]}")
    wide = run.select("run_name", *[_metric(name).alias(name) for name in METRICS])
    return wide.unpivot(["run_name"], METRICS, "metric", "value")


def get_tuning_parameters(runs: DataFrame, not_logged: str = NOT_LOGGED) -> DataFrame:
    """``run_name, parameter, value``, with a text where a parameter was not recorded."""
    values = [
        (F.col(f"`params.{name}`").cast("string") if f"params.{name}" in runs.columns else F.lit(None))
        .cast("string")
        .alias(name)
        for name in TUNING_PARAMETERS
    ]
    long = runs.select("run_name", *values).unpivot(["run_name"], TUNING_PARAMETERS, "parameter", "value")
    return long.withColumn("value", F.coalesce("value", F.lit(not_logged)))


def select_model(
    latest: DataFrame, metric: str = "pr_auc", baseline: str = BASELINE, tuned: str = TUNED
) -> DataFrame:
    """One row: the tuned run wins only with a strictly greater metric."""

    def of(run_name: str, column: str) -> Column:
        return F.max(F.when(F.col("run_name") == run_name, F.col(f"`{column}`")))

    metrics = [name for name in COMPARED_METRICS if f"metrics.{name}" in latest.columns]
    sides = {"baseline": baseline, "tuned": tuned}
    both = latest.agg(
        *[of(name, "run_id").alias(f"{side}_run_id") for side, name in sides.items()],
        *[of(name, f"metrics.{m}").alias(f"{side}_{m}") for side, name in sides.items() for m in metrics],
    )
    difference = F.col(f"tuned_{metric}") - F.col(f"baseline_{metric}")

    def chosen(column: str) -> Column:
        return F.when(difference > 0, F.col(f"tuned_{column}")).otherwise(F.col(f"baseline_{column}"))

    cv = F.col("tuned_cv_pr_auc") if "cv_pr_auc" in metrics else F.lit(None).cast("double")
    return both.select(
        F.lit(metric).alias("primary_metric"),
        F.when(difference > 0, tuned).otherwise(baseline).alias("selected_model"),
        chosen("run_id").alias("selected_run_id"),
        "baseline_run_id",
        "tuned_run_id",
        f"baseline_{metric}",
        f"tuned_{metric}",
        difference.alias(f"{metric}_difference"),
        cv.alias("cv_pr_auc"),
        *[chosen(name).alias(f"selected_{name}") for name in METRICS if name in metrics],
    )


def selection_run(decision: DataFrame) -> DataFrame:
    """The decision as a finished run, to be stored beside the runs it chose from."""
    params = ["selected_model", "selected_run_id", "baseline_run_id", "tuned_run_id"]
    taken = {"primary_metric", "cv_pr_auc", *params}
    metrics = [name for name in decision.columns if name not in taken]
    return decision.select(
        F.lit(SELECTION).alias("run_name"),
        F.expr("uuid()").alias("run_id"),
        F.current_timestamp().alias("start_time"),
        F.lit(FINISHED).alias("status"),
        *[F.col(name).cast("string").alias(f"params.{name}") for name in params],
        F.col("primary_metric").alias("params.selection_metric"),
        *[F.col(name).cast("double").alias(f"metrics.{name}") for name in metrics],
        F.col("cv_pr_auc").alias("metrics.tuned_cv_pr_auc"),
    )


def latest_selection(selections: DataFrame) -> DataFrame:
    """The newest finished selection as one row; only that row leaves each task."""
    finished = selections.where((F.col("status") == FINISHED) & (F.col("run_name") == SELECTION))
    return finished.orderBy(F.desc("start_time"), F.desc("run_id")).limit(1)


def get_selected_run_id(selections: DataFrame, column: str = "params.selected_run_id") -> str:
    row = latest_selection(selections).select(F.col(f"`{column}`").cast("string").alias("selected")).first()
    if row is None:
        raise ValueError(f"no finished {SELECTION} run")
    if not row["selected"]:
        raise ValueError(f"the latest {SELECTION} run names no selected run")
    return row["selected"]


def latest_artifact(artifacts: DataFrame, selected: DataFrame, run_column: str = "selected_run_id") -> DataFrame:
    """The newest ready artifact that belongs to the run named in the one-row frame ``selected``.

    The artifact names its run as source run or as run, so each name is joined on its own key.
    """
    ready = artifacts.where(F.col("status") == READY)
    owners = F.array_distinct(F.array_compact(F.array("source_run_id", "run_id")))
    owned = ready.withColumn("owner", F.explode(owners))
    wanted = selected.select(F.col(run_column).alias("owner")).limit(1)
    matching = owned.join(F.broadcast(wanted), "owner")
    return matching.orderBy(F.desc("creation_time"), F.desc("model_id")).limit(1).drop("owner")


def get_logged_model(artifacts: DataFrame, selected_run_id: str) -> DataFrame:
    """The newest ready artifact of a run; fails if there is none."""
    spark = artifacts.sparkSession
    selected = spark.createDataFrame([(selected_run_id,)], "selected_run_id string")
    found = latest_artifact(artifacts, selected)
    if found.isEmpty():
        raise ValueError(f"no ready model belongs to run {selected_run_id}")
    return found
