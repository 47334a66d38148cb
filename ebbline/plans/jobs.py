"""The jobs a scheduler runs, from raw files to the drift report.

Each job reads tables and writes tables, so the next one starts from stored data and a lost executor costs a
task, not the chain before it.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.columns import FEATURE_COLUMNS, ID_COLUMN, NUMERIC_FEATURES
from ebbline.functions.values import STRICT
from ebbline.operators.artifacts import Identity, load_artifact, save_artifact
from ebbline.operators.clean import clean_events, clean_orders, clean_users
from ebbline.operators.drift import drift_report
from ebbline.operators.features import build_customer_features
from ebbline.operators.models import train_models
from ebbline.operators.prediction_log import failures, from_log_lines, successes, to_log_lines
from ebbline.operators.quality import direct_identifiers, split_scoring_rows, training_data_rules
from ebbline.operators.runs import (
    READY,
    TUNED,
    TUNING_PARAMETERS,
    build_comparison,
    get_latest_successful_runs,
    get_logged_model,
    get_metrics,
    get_selected_run_id,
    get_tuning_parameters,
    select_model,
    selection_run,
)
from ebbline.operators.scoring import (
    SAMPLE_SIZE,
    agreement,
    score,
    score_summary,
    top_sample,
    validate_predictions,
)
from ebbline.operators.tuning import search_forest
from ebbline.sources import (
    create_snapshot_once,
    ensure_schema,
    load_raw_data,
    read_snapshot,
    write_report_csv,
    write_report_json,
    write_tables,
)

THRESHOLD = 0.5  # fixed value


@dataclass(frozen=True)
class Names:
    """Where a deployment keeps its tables."""

    catalog: str = "spark_catalog"
    schema: str = "churn"
    users: str = "silver_users"
    orders: str = "silver_orders"
    events: str = "silver_events"
    gold: str = "gold_customer_features"
    runs: str = "model_runs"
    artifacts: str = "model_artifacts"
    scored: str = "scored_customers"
    refused: str = "refused_customers"
    log: str = "prediction_log"

    def table(self, name: str) -> str:
        return f"{self.catalog}.{self.schema}.{name}"


def silver_job(
    spark: SparkSession,
    names: Names,
    users_path: str,
    orders_path: str,
    events_path: str,
    mode: str = STRICT,
    fmt: str = "parquet",
    location: str | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Raw files to the three silver tables; returns the written row counts.

    With ``buckets``, at least as many as ``spark.sql.shuffle.partitions``, the users are laid out by id, so that the
    gold job does not exchange them.  Orders and events are not: a user who holds many of them would be one task there,
    while their aggregates combine in every task before one short row per user moves.
    """
    ensure_schema(spark, names.catalog, names.schema, location)
    users, orders, events = load_raw_data(spark, users_path, orders_path, events_path, mode=mode)
    silver = {
        names.table(names.users): clean_users(users, mode),
        names.table(names.orders): clean_orders(orders, mode),
        names.table(names.events): clean_events(events, mode),
    }
    laid_out = {names.table(names.users): (buckets, ID_COLUMN)} if buckets else {}
    return write_tables(spark, silver, fmt, laid_out)


def gold_job(
    spark: SparkSession, names: Names, as_of: dt.date | Column, fmt: str = "parquet", check_ids: bool = True
) -> DataFrame:
    """Silver tables to the gold table.  Null or repeated user ids are refused before the join unless asked not to."""
    gold = gold_frame(spark, names, as_of, check_ids)
    return write_tables(spark, {names.table(names.gold): gold}, fmt)


def gold_frame(spark: SparkSession, names: Names, as_of: dt.date | Column, check_ids: bool = True) -> DataFrame:
    users = spark.table(names.table(names.users))
    if check_ids:
        found = {row["rule"]: row["violations"] for row in training_data_rules(users).collect()}
        if found["id_not_null"] or found["id_unique"]:
            raise ValueError(f"{ID_COLUMN} of the users is not unique: {found['id_not_null']} null, {found['id_unique']} repeated")
    gold = build_customer_features(
        users,
        spark.table(names.table(names.orders)),
        spark.table(names.table(names.events)),
        as_of,
        unique_users=check_ids,
    )
    if direct_identifiers(gold):
        raise ValueError(f"direct identifiers in the gold table: {direct_identifiers(gold)}")
    return gold


def training_job(spark: SparkSession, names: Names, model_path: str, **options) -> DataFrame:
    """Train the candidates, store each pipeline and add their runs to the run table."""
    trained = train_models(spark.table(names.table(names.gold)), **options)
    run_ids = {row["run_name"]: row["run_id"] for row in trained.runs.select("run_name", "run_id").collect()}
    threshold = options.get("threshold", THRESHOLD)
    for name, model in trained.models.items():
        save_artifact(spark, model, f"{model_path}/{name}", Identity(name, run_ids[name], threshold))
    _record(trained.runs, names, model_path)
    return trained.runs


def tuning_job(spark: SparkSession, names: Names, model_path: str, **options) -> DataFrame:
    """Search forest settings, store the best pipeline, its run and the ranked settings."""
    tuned = search_forest(spark.table(names.table(names.gold)), **options)
    identity = Identity(TUNED, tuned.runs.first()["run_id"], options.get("threshold", THRESHOLD))
    save_artifact(spark, tuned.model, f"{model_path}/{TUNED}", identity)
    write_report_csv(tuned.cv_results, f"{model_path}/cv_results")
    _record(tuned.runs, names, model_path)
    return tuned.cv_results


def _record(runs: DataFrame, names: Names, model_path: str) -> None:
    """Add run rows, and one artifact row per stored pipeline."""
    _append(runs, names, names.runs)
    stored = runs.select(
        F.concat(F.lit(f"{model_path}/"), "run_name").alias("model_id"),
        F.col("run_id").alias("source_run_id"),
        F.col("run_id").alias("run_id"),
        F.lit(READY).alias("status"),
        F.current_timestamp().alias("creation_time"),
    )
    _append(stored, names, names.artifacts)


def _folder(spark: SparkSession, names: Names, name: str) -> str:
    described = spark.sql(f"DESCRIBE SCHEMA {names.catalog}.{names.schema}")
    location = described.where(F.col("info_name") == "Location").first()["info_value"]
    return f"{location}/{name}_files"


def _append(rows: DataFrame, names: Names, name: str) -> None:
    """Runs of different jobs have different parameter columns, so these rows are files read with merged schemas."""
    rows.write.mode("append").parquet(_folder(rows.sparkSession, names, name))


def read_records(spark: SparkSession, names: Names, name: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(_folder(spark, names, name))


def selection_job(spark: SparkSession, names: Names, report_path: str, metric: str = "pr_auc") -> DataFrame:
    """Compare the latest runs; store the comparison, the decision with the tuned run's parameters and a selection
    run."""
    latest = get_latest_successful_runs(read_records(spark, names, names.runs))
    get_metrics(latest)
    write_report_csv(build_comparison(latest), f"{report_path}/model_comparison")
    decision = select_model(latest, metric)
    tuned = get_tuning_parameters(latest).where(F.col("run_name") == TUNED)
    parameters = {row["parameter"]: row["value"] for row in tuned.collect()}  # one run's
    summary = decision.withColumns({f"tuned_{name}": F.lit(parameters.get(name)) for name in TUNING_PARAMETERS})
    write_report_json(summary, f"{report_path}/selection_summary")
    stored = spark.read.schema(decision.schema).json(f"{report_path}/selection_summary")
    _append(selection_run(stored), names, names.runs)
    return stored


def load_selected_artifact(spark: SparkSession, names: Names) -> tuple[PipelineModel, Identity]:
    """The stored pipeline of the run the latest selection chose, and its identity; fails if a later run has been
    stored in its place."""
    run_id = get_selected_run_id(read_records(spark, names, names.runs))
    artifact = get_logged_model(read_records(spark, names, names.artifacts), run_id)
    return load_artifact(spark, artifact.first()["model_id"], run_id)


def load_selected_model(spark: SparkSession, names: Names) -> PipelineModel:
    return load_selected_artifact(spark, names)[0]


def scoring_job(
    spark: SparkSession, names: Names, model_name: str = "churn_model", fmt: str = "parquet"
) -> DataFrame:
    """Score the gold table with the selected model.

    Rows with negative measures are set aside with their reasons; the others are scored and checked.  Scored and
    refused rows are tables, and each row adds a line to the prediction log.  Returns the written row counts.
    """
    model, identity = load_selected_artifact(spark, names)
    info = {"model_name": model_name, "model_version": identity.run_id}
    accepted, refused = split_scoring_rows(spark.table(names.table(names.gold)))
    written = {
        names.table(names.scored): score(model, accepted, threshold=identity.threshold, model_info=info),
        names.table(names.refused): refused.select(ID_COLUMN, "reasons"),
    }
    counts = write_tables(spark, written, fmt)
    scored = spark.table(names.table(names.scored))
    validate_predictions(scored)
    # A batch has no time per row.
    no_time = F.lit(None).cast("double")
    done = successes(scored, no_time)
    failed = failures(spark.table(names.table(names.refused)), no_time, F.lit("ValueError"), info)
    lines = to_log_lines(done.unionByName(failed))
    lines.write.mode("append").text(_folder(spark, names, names.log))
    return counts


def read_prediction_log(spark: SparkSession, names: Names) -> DataFrame:
    return from_log_lines(spark.read.text(_folder(spark, names, names.log)))


def validation_job(
    gold: DataFrame,
    fitted: PipelineModel,
    model_path: str,
    sample_size: int = SAMPLE_SIZE,
    report_path: str | None = None,
    identity: Identity = Identity("unnamed", "unrecorded"),
) -> tuple[DataFrame, DataFrame]:
    """Store and reload a pipeline, score the same sample with both, and require equal classes.

    Returns the scored sample and its summary, and writes both when given a report folder.  The summary names the
    model as the stored identity does.
    """
    spark = gold.sparkSession
    save_artifact(spark, fitted, model_path, identity)
    loaded, known = load_artifact(spark, model_path, identity.run_id)
    # Everything below reads the sample, which is at most ``sample_size`` rows: it is looked up once.
    sample = top_sample(gold.select(ID_COLUMN, *FEATURE_COLUMNS), ID_COLUMN, sample_size)
    sample = spark.createDataFrame(sample.collect(), sample.schema)
    keep = (ID_COLUMN, "sample_row")
    first = score(fitted, sample, keep, identity.threshold)
    second = score(loaded, sample, keep, known.threshold)
    if first.isEmpty():
        raise ValueError("the gold table has no rows")
    validate_predictions(first)
    agreed = agreement(first, second).first()
    if agreed["prediction_agreement"] != 1.0 or agreed["unmatched_rows"] or agreed["repeated_ids"]:
        raise ValueError("the fitted and the loaded pipeline disagree")
    summary = score_summary(first).withColumns(
        {
            "prediction_agreement": F.lit(agreed["prediction_agreement"]),
            "model_name": F.lit(known.model_name),
            "model_version": F.lit(known.run_id),
            "model_uri": F.lit(model_path),
            "threshold": F.lit(known.threshold),
        }
    )
    rows = first.orderBy("sample_row")
    if report_path:
        write_report_csv(
            rows.select("sample_row", "prediction", "churn_probability"), f"{report_path}/predictions"
        )
        write_report_json(summary, f"{report_path}/summary")
    return rows, summary


def drift_job(current: DataFrame, snapshot_path: str, report_path: str | None = None) -> DataFrame | None:
    """Compare the numeric features with the stored snapshot.

    The first run stores the snapshot and has nothing to compare it with: it returns None and writes no report.
    """
    if create_snapshot_once(current.select(FEATURE_COLUMNS), snapshot_path):
        return None
    report = drift_report(read_snapshot(current.sparkSession, snapshot_path), current, NUMERIC_FEATURES)
    if report_path:
        write_report_csv(report, report_path)
    return report
