"""Registered queries: each takes a session and a folder of the given tables and returns a DataFrame."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ebbline.columns import FEATURE_COLUMNS, NUMERIC_FEATURES, STRING_FEATURES
from ebbline.functions.values import PERMISSIVE
from ebbline.operators import clean, dictionary, drift, features, missing, models, prediction_log, profile, quality
from ebbline.operators import preprocess, ranking, runs, scoring, splits, tuning
from ebbline.operators.artifacts import Identity
from ebbline.plans import driver_tables as given
from ebbline.plans import jobs
from ebbline.sources import list_tables, load_raw_data, read_snapshot, scratch_path
from ebbline.sources import raw_parse_losses as count_lost_lines
from ebbline.sources.tables import create_snapshot_once, ensure_schema, write_report_csv, write_tables
from ebbline.streaming import read_totals, run_available, stream_prediction_metrics

AS_OF = dt.date(2024, 2, 1)
Query = Callable[[SparkSession, str], DataFrame]

_stored: dict[tuple[str, str], str] = {}


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, digits) for name in names})


def silver(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        clean.clean_users(given.raw_users(spark, sf_dir)),
        clean.clean_orders(given.raw_orders(spark, sf_dir)),
        clean.clean_events(given.raw_events(spark, sf_dir)),
    )


def gold_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.build_customer_features(*silver(spark, sf_dir), AS_OF)


def gold_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored gold table, written once per session: what follows reads it several times."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stored:
        path = scratch_path(spark, "gold")
        gold_features(spark, sf_dir).write.parquet(path)
        _stored[key] = path
    return spark.read.parquet(_stored[key])


# Silver and gold


def silver_users(spark, sf_dir):
    return silver(spark, sf_dir)[0]


def silver_orders(spark, sf_dir):
    return silver(spark, sf_dir)[1]


def silver_events(spark, sf_dir):
    return silver(spark, sf_dir)[2]


def silver_orders_permissive(spark, sf_dir):
    return clean.clean_orders(given.raw_orders_with_errors(spark, sf_dir), PERMISSIVE)


def parse_losses(spark, sf_dir):
    return clean.parse_losses(given.raw_orders_with_errors(spark, sf_dir), clean.ORDERS)


def orders_per_user(spark, sf_dir):
    return rounded(features.aggregate_orders(silver_orders(spark, sf_dir)), 4, "avg_order_amount")


def events_per_user(spark, sf_dir):
    return features.aggregate_events(silver_events(spark, sf_dir))


def events_per_user_known_platform(spark, sf_dir):
    return features.aggregate_events(silver_events(spark, sf_dir), treat_unknown_as_null=True)


def gold(spark, sf_dir):
    return rounded(gold_features(spark, sf_dir), 4, "avg_order_amount")


# Sources and sinks


def _row_texts(df: DataFrame, dataset: str, key: str) -> DataFrame:
    fields = [F.coalesce(F.col(name), F.lit("<null>")) for name in df.columns]
    return df.select(
        F.lit(dataset).alias("dataset"), F.col(key).alias("row_id"), F.concat_ws("|", *fields).alias("fields")
    )


def raw_round_trip(spark, sf_dir):
    root = scratch_path(spark, "raw")
    given.raw_users(spark, sf_dir).write.json(f"{root}/users")
    given.raw_orders(spark, sf_dir).write.json(f"{root}/orders")
    keep_blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    # Another order of columns than the reader's, and one that it does not ask for.
    url = F.lit("x").alias("url")
    events = given.raw_events(spark, sf_dir)
    events = events.select("date", "user_id", url, "session_id", "event_id", "action", "platform")
    events.write.options(header=True, **keep_blanks).csv(f"{root}/events")
    users, orders, events = load_raw_data(spark, f"{root}/users", f"{root}/orders", f"{root}/events")
    return (
        _row_texts(users, "users", "id")
        .unionByName(_row_texts(orders, "orders", "id"))
        .unionByName(_row_texts(events, "events", "event_id"))
    )


def raw_parse_losses(spark, sf_dir):
    """Lines that are no records: orders cut in the middle, events without their last columns."""
    root = scratch_path(spark, "raw-errors")
    given.raw_users(spark, sf_dir).write.json(f"{root}/users")
    given.broken_order_lines(spark, sf_dir).write.text(f"{root}/orders")
    # A separator that no line holds keeps Spark from quoting lines that hold commas; the header is the column's name.
    given.broken_event_lines(spark, sf_dir).write.options(header=True, sep="\u0001").csv(f"{root}/events")
    paths = [f"{root}/{name}" for name in ("users", "orders", "events")]
    return count_lost_lines(dict(zip(("users", "orders", "events"), load_raw_data(spark, *paths, mode=PERMISSIVE))))


def table_round_trip(spark, sf_dir):
    location = scratch_path(spark, "tables")
    schema = "ebbline_" + location.rsplit("-", 1)[1]
    ensure_schema(spark, "spark_catalog", schema, location)
    users, orders, events = silver(spark, sf_dir)
    frames = {"silver_users": users, "silver_orders": orders, "silver_events": events}
    counts = write_tables(spark, {f"{schema}.{name}": df for name, df in frames.items()})
    named = counts.withColumn("table_name", F.substring_index("table_name", ".", -1))
    listed = list_tables(spark, schema).withColumnRenamed("tableName", "table_name")
    return named.join(listed, "table_name")


# Exploration and quality


def profile_users(spark, sf_dir):
    return profile.distinct_counts(given.raw_users(spark, sf_dir), ["id", "email", "country", "churn"])


def profile_orders(spark, sf_dir):
    return profile.distinct_counts(given.raw_orders(spark, sf_dir), ["id", "user_id"])


def churn_counts(spark, sf_dir):
    return profile.group_counts(given.raw_users(spark, sf_dir), "churn")


def platform_counts(spark, sf_dir):
    return profile.group_counts(given.raw_events(spark, sf_dir), "platform")


def action_counts(spark, sf_dir):
    return profile.group_counts(given.raw_events(spark, sf_dir), "action")


def countries(spark, sf_dir):
    return profile.distinct_values(given.raw_users(spark, sf_dir), "country")


def event_key_profile(spark, sf_dir):
    return profile.key_profile(given.raw_events(spark, sf_dir), "event_id")


def users_like(spark, sf_dir):
    return profile.containing(given.raw_users(spark, sf_dir), "email", "48")


def missing_profile(spark, sf_dir):
    raw = {"users": given.raw_users, "orders": given.raw_orders, "events": given.raw_events}
    parts = [
        missing.get_missing_values(read(spark, sf_dir)).withColumn("dataset", F.lit(name))
        for name, read in raw.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def missing_profile_numbers(spark, sf_dir):
    """The numeric features, where null and NaN are both missing and zero is not."""
    table = gold_table(spark, sf_dir).select("user_id", *NUMERIC_FEATURES)
    nan = F.when(F.col("user_id").cast("long") % 7 == 3, F.lit(float("nan"))).otherwise(F.col("avg_order_amount"))
    return missing.get_missing_values(table.withColumn("avg_order_amount", nan).drop("user_id"))


def quality_rules(spark, sf_dir):
    return quality.training_data_rules(gold_table(spark, sf_dir))


def scoring_rows_rejected(spark, sf_dir):
    _, refused = quality.split_scoring_rows(given.scoring_rows(gold_table(spark, sf_dir)))
    return refused.select("user_id", "order_count", F.array_join("reasons", ",").alias("reasons"))


def aligned_input(spark, sf_dir):
    aligned = scoring.prepare_input(gold_table(spark, sf_dir), ("user_id",), blanks_to_null=True)
    return rounded(aligned, 4, "avg_order_amount")


# Drift


def psi_lineitem(spark, sf_dir):
    reference, current = given.psi_sides(spark, sf_dir)
    return rounded(drift.psi_table(reference, current), 6, "psi")


def _gold_halves(spark, sf_dir):
    table = gold_table(spark, sf_dir)
    even = F.col("user_id").cast("long") % 2 == 0
    return table.where(even), table.where(~even)


def drift_report(spark, sf_dir):
    """Snapshot, report and report file, each written and read back."""
    reference, current = _gold_halves(spark, sf_dir)
    root = scratch_path(spark, "drift")
    create_snapshot_once(reference.select(FEATURE_COLUMNS), f"{root}/snapshot")
    stored = read_snapshot(spark, f"{root}/snapshot")
    report = drift.drift_report(stored, current.select(FEATURE_COLUMNS))
    write_report_csv(report, f"{root}/report")
    written = spark.read.schema(report.schema).option("header", True).csv(f"{root}/report")
    return rounded(written, 6, "psi")


# Splits, metrics and preprocessing


def stratified_split(spark, sf_dir):
    return splits.stratified_split(gold_table(spark, sf_dir), "churn", "user_id").select(
        "user_id", "churn", "is_test"
    )


def stratified_folds(spark, sf_dir):
    return splits.stratified_folds(gold_table(spark, sf_dir), "churn", "user_id").select(
        "user_id", "churn", "fold"
    )


def class_weights(spark, sf_dir):
    return rounded(models.class_weights(gold_table(spark, sf_dir)), 6, "weight")


def ranking_metrics(spark, sf_dir):
    return rounded(ranking.ranking_metrics(given.binary_scores(spark, sf_dir)), 6, "roc_auc", "pr_auc")


def evaluation_metrics(spark, sf_dir):
    scored = given.binary_scores(spark, sf_dir).withColumn("prediction", (F.col("score") >= 5).cast("int"))
    return rounded(ranking.evaluate(scored, "label", "prediction", "score"), 6, *ranking.METRICS)


def impute_scale_stats(spark, sf_dir):
    return rounded(
        preprocess.numeric_statistics(gold_table(spark, sf_dir), NUMERIC_FEATURES), 4, "median", "mean", "std"
    )


def category_modes(spark, sf_dir):
    return preprocess.category_modes(gold_table(spark, sf_dir), STRING_FEATURES)


def one_hot_features(spark, sf_dir):
    table = gold_table(spark, sf_dir)
    statistics = preprocess.PreprocessorStatistics.of(table, NUMERIC_FEATURES, STRING_FEATURES)
    fitted = Pipeline(stages=statistics.stages()).fit(table)
    values = fitted.transform(table).select("user_id", vector_to_array("features").alias("f"))
    # Adding zero turns a rounded negative zero into zero.
    named = [(F.round(F.col("f")[at], 4) + 0.0).alias(name) for at, name in enumerate(statistics.feature_names())]
    return values.select("user_id", *named)


def one_hot_dictionary(spark, sf_dir):
    """The text features encoded by a stored dictionary: numbers, and where the vectors hold their one."""
    table, path = gold_table(spark, sf_dir), scratch_path(spark, "dictionary")
    dictionary.write_dictionary(table, STRING_FEATURES, path)
    stored = dictionary.CategoryDictionary(spark, path)
    encoded = stored.with_vectors(stored.with_indexes(table.select("user_id", *STRING_FEATURES)))
    ones = {f"one_of_{name}": F.array_position(vector_to_array(f"one_hot_{name}"), 1.0) - 1 for name in stored.sizes}
    return encoded.withColumns(ones).select("user_id", *[f"index_{name}" for name in stored.sizes], *ones)


# Models


def prior_baseline(spark, sf_dir):
    table = gold_table(spark, sf_dir)
    model = models.PriorClassifier().fit(models.training_frame(table))
    scored = scoring.score(model, table)
    return rounded(scored, 6, "churn_probability").select(
        "user_id", "prediction", "churn_probability", "label_text"
    )


def _plain_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.replace("metrics.", "").replace("params.", "param_") for name in df.columns])


def model_runs(spark, sf_dir):
    return _plain_names(models.train_models(gold_table(spark, sf_dir)).runs)


def logistic_scores(spark, sf_dir):
    trained = models.train_models(gold_table(spark, sf_dir), only=["logistic_regression"])
    return scoring.score(trained.models["logistic_regression"], gold_table(spark, sf_dir))


def forest_scores(spark, sf_dir):
    table = gold_table(spark, sf_dir)
    trained = models.train_models(table, only=["random_forest"])
    return scoring.score(trained.models["random_forest"], models.in_tasks_of_size(table, table.count()))


def batch_scores(spark, sf_dir):
    """Score accepted rows with a pipeline that was stored and loaded again."""
    table = gold_table(spark, sf_dir)
    trained = models.train_models(table, only=["logistic_regression"])
    path = scratch_path(spark, "model")
    trained.models["logistic_regression"].save(path)
    accepted, _ = quality.split_scoring_rows(given.scoring_rows(table))
    info = {"model_name": "logistic_regression", "model_version": "1", "model_alias": "Champion"}
    return scoring.score(PipelineModel.load(path), accepted, model_info=info)


def batch_scores_check(spark, sf_dir):
    """Every accepted row is scored once, with a class and a probability."""
    valid = F.col("churn_probability").between(0, 1) & F.col("prediction").isin(0, 1)
    return batch_scores(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("scored_rows"),
        F.sum(F.col("user_id").cast("long")).alias("id_sum"),
        F.count_if(~F.coalesce(valid, F.lit(False))).alias("violations"),
    )


def _validated(spark, sf_dir):
    """The summary of a validated model, and the run id that its training recorded."""
    table, name = gold_table(spark, sf_dir), "logistic_regression"
    trained = models.train_models(table, only=[name])
    run_id = trained.runs.first()["run_id"]
    identity = Identity(name, run_id)
    _, summary = jobs.validation_job(table, trained.models[name], scratch_path(spark, "model"), identity=identity)
    return summary, run_id


def validated_sample(spark, sf_dir):
    return _validated(spark, sf_dir)[0]


def validated_model_identity(spark, sf_dir):
    """What the summary says of the model, read back from beside the stored pipeline."""
    summary, run_id = _validated(spark, sf_dir)
    return summary.select(
        "model_name",
        (F.col("model_version") == run_id).alias("is_recorded_run"),
        "threshold",
        "sample_size",
    )


def validated_sample_check(spark, sf_dir):
    return validated_sample(spark, sf_dir).select("sample_size", "prediction_agreement")


def logistic_optimality(spark, sf_dir):
    """Rows and labels of the train part, and whether the penalised gradient vanishes in every feature."""
    table = gold_table(spark, sf_dir)
    model = models.train_models(table, only=["logistic_regression"]).models["logistic_regression"]
    train, _ = models.split_training_data(table)
    pulled = models.with_balanced_weight(model.transform(train)).select(
        models.LABEL,
        (F.col(models.WEIGHT) * (vector_to_array("probability")[1] - F.col(models.LABEL))).alias("pull"),
        vector_to_array("features").alias("x"),
    )
    coefficients = model.stages[-1].coefficients.toArray().tolist()
    gradients = [F.sum(F.col("pull") * F.col("x")[at]) + own for at, own in enumerate(coefficients)] + [F.sum("pull")]
    largest = F.greatest(*[F.abs(gradient) for gradient in gradients]) / F.count(F.lit(1))
    return pulled.agg(
        F.count(F.lit(1)).alias("train_rows"),
        F.sum(models.LABEL).cast("long").alias("positives"),
        F.round(largest, 3).alias("largest_mean_gradient"),
    )


def scoring_outcomes(spark, sf_dir):
    """Requests by status, read back from the log lines of a batch of which some rows are refused."""
    table = gold_table(spark, sf_dir)
    model = models.train_models(table, only=["logistic_regression"]).models["logistic_regression"]
    info = {"model_name": "logistic_regression", "model_version": "1"}
    accepted, refused = quality.split_scoring_rows(given.scoring_rows(table))
    no_time = F.lit(None).cast("double")
    outcomes = prediction_log.successes(scoring.score(model, accepted, model_info=info), no_time).unionByName(
        prediction_log.failures(refused, no_time, F.lit("ValueError"), info)
    )
    path = scratch_path(spark, "log")
    prediction_log.to_log_lines(outcomes).write.text(path)
    records = prediction_log.from_log_lines(spark.read.text(path))
    return records.groupBy("status", "error_type", "model_name").agg(
        F.count(F.lit(1)).alias("requests"), F.count("churn_probability").alias("probabilities")
    )


def ranked_settings(spark, sf_dir):
    """Twenty settings with scores from the orders, in which some tie."""
    scores = given.read(spark, sf_dir, "orders").groupBy((F.col("o_orderkey") % 20).alias("setting")).agg(
        (F.sum(F.floor("o_totalprice").cast("long")) % 7 / 10.0).alias("mean_test_score")
    )
    return tuning.rank_results(scores)


_searched: dict[tuple[str, str], DataFrame] = {}


def tuning_results(spark, sf_dir):
    """All settings on all folds; the search is run once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _searched:
        _searched[key] = tuning.search_forest(gold_table(spark, sf_dir)).cv_results
    return _searched[key]


def tuning_results_check(spark, sf_dir):
    """Of the search's records: their number, the settings, ranks and means computed again, and that scores are
    possible and better than chance."""
    rows = tuning_results(spark, sf_dir)
    folds = [f"split{fold}" for fold in range(tuning.FOLDS)]
    tests, trains = ([F.col(f"{fold}_{part}_score") for fold in folds] for part in ("test", "train"))
    mean = sum(tests[1:], tests[0]) / len(tests)
    spread = F.sqrt(sum(((score - mean) ** 2 for score in tests[1:]), (tests[0] - mean) ** 2) / len(tests))
    positives = gold_table(spark, sf_dir).agg(F.avg("churn").alias("base_rate"))
    again = rows.join(F.broadcast(positives)).join(F.broadcast(rows.agg(F.max("mean_test_score").alias("best"))))
    possible = [score.between(0, 1) for score in tests + trains]
    names = [name for name in rows.columns if name.startswith("param_")]
    return again.agg(
        F.count(F.lit(1)).alias("settings"),
        F.count_if((F.abs(F.col("mean_test_score") - mean) > 1e-9) | (F.abs(F.col("std_test_score") - spread) > 1e-9)).alias("wrong_means"),
        F.count_if(~F.reduce(F.array(*possible), F.lit(True), lambda a, b: a & b)).alias("impossible_scores"),
        F.count_if(F.greatest(*trains) < F.col("base_rate")).alias("below_chance"),
        F.count_if((F.col("rank_test_score") == 1) != (F.col("mean_test_score") == F.col("best"))).alias("wrong_ranks"),
        F.count_distinct(F.struct(*[F.col(name) for name in names])).alias("distinct_settings"),
    )


def sampled_settings(spark, sf_dir):
    """The settings of the search with the rows and churners that each fold fits them on."""
    train, _ = models.split_training_data(gold_table(spark, sf_dir))
    folded = splits.stratified_folds(train, models.LABEL, models.ID_COLUMN, tuning.FOLDS, models.SEED)
    held = folded.groupBy("fold").agg(F.count(F.lit(1)).alias("held_rows"), F.sum(models.LABEL).alias("held_ones"))
    totals = held.agg(F.sum("held_rows").alias("n"), F.sum("held_ones").alias("ones"))
    fitted = held.join(F.broadcast(totals)).select(
        "fold", (F.col("n") - F.col("held_rows")).alias("fit_rows"), (F.col("ones") - F.col("held_ones")).cast("long").alias("fit_ones")
    )
    settings = tuning.settings_frame(spark, tuning.sample_settings())
    return fitted.join(F.broadcast(settings)).select("setting", *[f"param_{name}" for name in tuning.SEARCH_SPACE], "fold", "fit_rows", "fit_ones")


def forest_check(spark, sf_dir):
    """The forest's form, the rows that fitted it, and that it tells the classes apart better than chance."""
    table = gold_table(spark, sf_dir)
    trained = models.train_models(table, only=["random_forest"])
    sizes = models.forest_sizes(trained.models["random_forest"].stages[-1]).agg(
        F.count(F.lit(1)).alias("trees"),
        F.count_if(F.col("depth") > models.FOREST_DEPTH).alias("too_deep"),
        F.count_if(F.col("nodes") % 2 == 0).alias("not_binary"),
    )
    train, _ = models.split_training_data(table)
    train = models.in_tasks_of_size(train, train.count())
    fitted = train.agg(F.count(F.lit(1)).alias("train_rows"), F.sum(models.LABEL).cast("long").alias("train_ones"))
    scored = scoring.score(trained.models["random_forest"], train, keep=(models.ID_COLUMN, models.LABEL))
    # The metrics need several passes, so the narrow result is kept meanwhile rather than scored in each.
    kept = scored.select(models.LABEL, "churn_probability").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        quality_of = ranking.ranking_metrics(kept, models.LABEL, "churn_probability").select((F.col("roc_auc") > 0.5).alias("beats_chance"))
        quality_of = spark.createDataFrame(quality_of.collect(), quality_of.schema)
    finally:
        kept.unpersist()
    return sizes.join(F.broadcast(fitted)).join(F.broadcast(quality_of))


def bounded_forest_check(spark, sf_dir):
    """The rows and churners that are left when a forest may be fitted on half of the train part at most."""
    train, _ = models.split_training_data(gold_table(spark, sf_dir))
    bound = train.count() // 2
    return models.bounded_training_rows(train, bound).agg(
        F.count(F.lit(1)).alias("forest_rows"), F.sum(models.LABEL).cast("long").alias("forest_ones")
    )


def model_runs_check(spark, sf_dir):
    """Each run's six recorded metrics against those computed again from its scored rows by ranks over single rows."""
    trained = models.train_models(gold_table(spark, sf_dir))
    checks = []
    for name, scored in trained.scored.items():
        recorded = trained.runs.where(F.col("run_name") == name)
        again = ranking.metrics_by_ranks(scored, models.LABEL)
        differs = [~(F.abs(F.col(f"`metrics.{metric}`") - F.col(metric)) < 1e-9) for metric in ranking.METRICS]
        wrong = sum((F.coalesce(one.cast("int"), F.lit(1)) for one in differs[1:]), F.coalesce(differs[0].cast("int"), F.lit(1)))
        checks.append(recorded.join(F.broadcast(again)).select("run_name", "status", "test_rows", "test_ones", wrong.alias("wrong_metrics")))
    return checks[0].unionByName(checks[1]).unionByName(checks[2])


# Runs


def latest_runs(spark, sf_dir):
    latest = runs.get_latest_successful_runs(given.runs(spark, sf_dir))
    return _plain_names(latest).select("run_name", "run_id", "start_time", "status", "pr_auc")


def run_comparison(spark, sf_dir):
    return runs.build_comparison(runs.get_latest_successful_runs(given.runs(spark, sf_dir)))


def run_metrics(spark, sf_dir):
    return runs.get_metrics(runs.get_latest_successful_runs(given.runs(spark, sf_dir)))


def tuning_parameters(spark, sf_dir):
    return runs.get_tuning_parameters(runs.get_latest_successful_runs(given.runs(spark, sf_dir)))


def model_selection(spark, sf_dir):
    decision = runs.select_model(runs.get_latest_successful_runs(given.runs(spark, sf_dir)))
    return rounded(decision, 6, "pr_auc_difference")


def selected_run(spark, sf_dir):
    latest = runs.latest_selection(given.selections(spark, sf_dir))
    return _plain_names(latest).select("run_id", "start_time", "param_selected_run_id")


def selected_artifact(spark, sf_dir):
    decision = runs.select_model(runs.get_latest_successful_runs(given.runs(spark, sf_dir)))
    return runs.latest_artifact(given.artifacts(spark, sf_dir), decision)


# Scored output


def top_sample(spark, sf_dir):
    sample = scoring.top_sample(gold_table(spark, sf_dir))
    return rounded(sample, 4, "avg_order_amount")


def agreement(spark, sf_dir):
    return scoring.agreement(*given.scored_pair(gold_table(spark, sf_dir)))


def score_summary(spark, sf_dir):
    return scoring.score_summary(given.scored_pair(gold_table(spark, sf_dir))[1])


def prediction_rules(spark, sf_dir):
    return scoring.prediction_rules(given.scored_pair(gold_table(spark, sf_dir))[1])


# Prediction log


def _outcomes(spark, sf_dir):
    return given.prediction_outcomes(given.read(spark, sf_dir, "events"))


def prediction_log_records(spark, sf_dir):
    """Records written as log lines and read back."""
    return prediction_log.from_log_lines(prediction_log.to_log_lines(_outcomes(spark, sf_dir)))


def prediction_metrics(spark, sf_dir):
    return prediction_log.prediction_metrics(_outcomes(spark, sf_dir))


def prediction_metrics_stream(spark, sf_dir):
    events = (
        spark.readStream.schema(given.EVENTS_SCHEMA).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    )
    root = scratch_path(spark, "stream")
    log = given.prediction_outcomes(events)
    run_available(stream_prediction_metrics(log, f"{root}/totals", f"{root}/checkpoint"))
    return read_totals(spark, f"{root}/totals")


QUERIES: dict[str, Query] = {
    "gold_features": gold,
    **{
        query.__name__: query
        for query in (
            silver_users,
            silver_orders,
            silver_events,
            silver_orders_permissive,
            parse_losses,
            orders_per_user,
            events_per_user,
            events_per_user_known_platform,
            raw_round_trip,
            raw_parse_losses,
            table_round_trip,
            profile_users,
            profile_orders,
            churn_counts,
            platform_counts,
            action_counts,
            countries,
            event_key_profile,
            users_like,
            missing_profile,
            missing_profile_numbers,
            quality_rules,
            scoring_rows_rejected,
            aligned_input,
            psi_lineitem,
            drift_report,
            stratified_split,
            stratified_folds,
            class_weights,
            ranking_metrics,
            evaluation_metrics,
            impute_scale_stats,
            category_modes,
            one_hot_features,
            one_hot_dictionary,
            prior_baseline,
            model_runs,
            logistic_scores,
            forest_scores,
            batch_scores,
            batch_scores_check,
            validated_sample,
            validated_sample_check,
            validated_model_identity,
            logistic_optimality,
            scoring_outcomes,
            tuning_results,
            tuning_results_check,
            sampled_settings,
            forest_check,
            bounded_forest_check,
            model_runs_check,
            ranked_settings,
            latest_runs,
            run_comparison,
            run_metrics,
            tuning_parameters,
            model_selection,
            selected_run,
            selected_artifact,
            top_sample,
            agreement,
            score_summary,
            prediction_rules,
            prediction_log_records,
            prediction_metrics,
            prediction_metrics_stream,
        )
    },
}
