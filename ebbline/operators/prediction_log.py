"""Prediction log records and the metrics over them, for batch and streaming frames alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.functions.values import share

# Fixed values.
LOG_PREFIX = "prediction_monitoring "
EVENT_NAME = "prediction"
SUCCESS, FAILED = "success", "failed"
LOG_SCHEMA = (
    "churn_probability double, error_type string, event string, latency_ms double, model_name string,"
    " model_version string, prediction int, request_id string, status string, timestamp timestamp"
)
# End of fixed values.

#: Spark's JSON functions cut times to milliseconds unless told otherwise.
FULL_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
MODEL = ("model_name", "model_version")


def successes(scored: DataFrame, latency_ms: Column) -> DataFrame:
    """Outcome records of scored rows, stamped with a request id and the current time.

    ``scored`` carries prediction, churn_probability, model_name and model_version; nothing else of it is kept.
    """
    return scored.select(
        F.expr("uuid()").alias("request_id"),
        F.lit(SUCCESS).alias("status"),
        latency_ms.cast("double").alias("latency_ms"),
        "churn_probability",
        "prediction",
        F.lit(None).cast("string").alias("error_type"),
        F.current_timestamp().alias("timestamp"),
        *MODEL,
    )


def failures(refused: DataFrame, latency_ms: Column, error_type: Column, model: dict[str, str]) -> DataFrame:
    """Outcome records of requests that failed: no class and no probability."""
    return refused.select(
        F.expr("uuid()").alias("request_id"),
        F.lit(FAILED).alias("status"),
        latency_ms.cast("double").alias("latency_ms"),
        F.lit(None).cast("double").alias("churn_probability"),
        F.lit(None).cast("int").alias("prediction"),
        error_type.alias("error_type"),
        F.current_timestamp().alias("timestamp"),
        *[F.lit(model[name]).alias(name) for name in MODEL],
    )


def to_log_records(outcomes: DataFrame) -> DataFrame:
    """Rounded log records.  A failure keeps its error type and latency, a success its class and probability."""
    ok = F.col("status") == SUCCESS
    return outcomes.select(
        F.when(ok, F.round("churn_probability", 6)).alias("churn_probability"),
        F.when(~ok, F.col("error_type")).alias("error_type"),
        F.lit(EVENT_NAME).alias("event"),
        F.round("latency_ms", 2).alias("latency_ms"),
        "model_name",
        "model_version",
        F.when(ok, F.col("prediction")).alias("prediction"),
        "request_id",
        "status",
        "timestamp",
    )


def to_log_lines(outcomes: DataFrame, prefix: str = LOG_PREFIX) -> DataFrame:
    """One text line per record: a JSON object with sorted keys and without null fields."""
    records = to_log_records(outcomes).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    return records.select(F.concat(F.lit(prefix), F.to_json(F.struct(*sorted(records.columns)), FULL_TIMES)).alias("value"))


def from_log_lines(lines: DataFrame, prefix: str = LOG_PREFIX) -> DataFrame:
    """Records of the lines that carry the prefix."""
    record = F.from_json(F.substring("value", len(prefix) + 1, 2**31 - 1), LOG_SCHEMA, FULL_TIMES)
    return lines.where(F.col("value").startswith(prefix)).select(record.alias("record")).select("record.*")


def _metric_columns(started_at: Column | None) -> list[Column]:
    ok = F.col("status") == SUCCESS
    successes, requests = F.count_if(ok), F.count(F.lit(1))
    churners = F.count_if(ok & (F.col("prediction") == 1))
    probability = F.sum(F.when(ok, F.col("churn_probability")))
    started = [] if started_at is None else [started_at.alias("started_at")]
    return [
        requests.alias("total_requests"),
        successes.alias("successful_predictions"),
        F.count_if(~ok).alias("failed_predictions"),
        churners.alias("predicted_churn_count"),
        F.round(share(churners, successes), 6).alias("predicted_churn_rate"),
        F.round(share(F.coalesce(probability, F.lit(0.0)), successes), 6).alias("average_churn_probability"),
        F.round(share(F.coalesce(F.sum("latency_ms"), F.lit(0.0)), requests), 2).alias("average_latency_ms"),
        *started,
        F.max("timestamp").alias("last_request_at"),
    ]


def prediction_metrics(
    log: DataFrame, by: tuple[str, ...] = MODEL, started_at: Column | None = None
) -> DataFrame:
    """Rates over successes, latency over all requests.

    Every buffer is a counter, a sum or a maximum, so a model that serves most requests is combined before the
    shuffle, and streaming state is one row per model.  ``by=()`` gives one row even for an empty log.
    """
    return log.groupBy(*by).agg(*_metric_columns(started_at))
