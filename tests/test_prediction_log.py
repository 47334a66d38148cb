import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from ebbline.operators import prediction_log
from ebbline.streaming import read_totals, run_available, stream_prediction_metrics
from ebbline.streaming.prediction_metrics import complete_batches, retire_batches

SCHEMA = (
    "request_id string, status string, latency_ms double, churn_probability double, prediction int,"
    " error_type string, timestamp timestamp, model_name string, model_version string"
)
T0 = dt.datetime(2024, 1, 1, 12)


def ok(request_id, probability, second=0, version="1"):
    moment = T0 + dt.timedelta(seconds=second)
    return (request_id, "success", 10.126, probability, int(probability >= 0.5), None, moment, "churn", version)


def failed(request_id, second=0):
    return (request_id, "failed", 30.0, None, None, "RuntimeError", T0 + dt.timedelta(seconds=second), "churn", "1")


def log(spark, *rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_an_empty_log_has_zero_counters(spark):
    row = prediction_log.prediction_metrics(log(spark), by=()).first().asDict()
    assert row.pop("last_request_at") is None
    assert all(value == 0 for value in row.values()) and len(row) == 7


def test_one_success(spark):
    row = prediction_log.prediction_metrics(log(spark, ok("a", 0.8274))).first()
    assert (row["total_requests"], row["successful_predictions"], row["failed_predictions"]) == (1, 1, 0)
    assert (row["predicted_churn_count"], row["predicted_churn_rate"]) == (1, 1.0)
    assert row["average_churn_probability"] == 0.8274
    assert row["last_request_at"] == T0


def test_one_failure(spark):
    row = prediction_log.prediction_metrics(log(spark, failed("a"))).first()
    assert (row["total_requests"], row["successful_predictions"], row["failed_predictions"]) == (1, 0, 1)
    assert (row["average_churn_probability"], row["predicted_churn_rate"], row["average_latency_ms"]) == (0, 0, 30.0)


def test_rates_use_successes_and_latency_uses_all_requests_per_model(spark):
    df = log(spark, ok("a", 0.9), ok("b", 0.1, 5), failed("c", 9), ok("d", 0.2, 1, "2"))
    rows = {row["model_version"]: row for row in prediction_log.prediction_metrics(df).collect()}
    first = rows["1"]
    assert (first["predicted_churn_rate"], first["average_churn_probability"]) == (0.5, 0.5)
    assert first["average_latency_ms"] == round((10.126 * 2 + 30) / 3, 2)
    assert first["last_request_at"] == T0 + dt.timedelta(seconds=9)
    assert rows["2"]["total_requests"] == 1


def test_lines_are_sorted_json_and_read_back(spark):
    lines = prediction_log.to_log_lines(log(spark, ok("a", 0.12345678), failed("b")))
    texts = [row["value"] for row in lines.collect()]
    assert all(text.startswith("prediction_monitoring {") for text in texts)
    success, failure = (json.loads(text.split(" ", 1)[1]) for text in texts)
    assert list(success) == sorted(success) and list(failure) == sorted(failure)
    assert (success["churn_probability"], success["latency_ms"], success["event"]) == (0.123457, 10.13, "prediction")
    assert "churn_probability" not in failure and "prediction" not in failure
    assert failure["error_type"] == "RuntimeError" and "error_type" not in success

    other = spark.createDataFrame([("another line",)], "value string")
    records = prediction_log.from_log_lines(lines.unionByName(other))
    assert sorted(row["request_id"] for row in records.collect()) == ["a", "b"]
    metrics = prediction_log.prediction_metrics(records).first()
    assert (metrics["total_requests"], metrics["last_request_at"]) == (2, T0)


def test_scored_and_refused_rows_become_outcomes(spark):
    scored = spark.createDataFrame(
        [("u1", 1, 0.75, "churn", "3"), ("u2", 0, 0.25, "churn", "3")],
        "user_id string, prediction int, churn_probability double, model_name string, model_version string",
    )
    good = prediction_log.successes(scored, F.lit(12.0))
    bad = prediction_log.failures(
        scored.limit(1), F.lit(24.0), F.lit("RuntimeError"), {"model_name": "churn", "model_version": "3"}
    )
    outcomes = good.unionByName(bad)
    assert "user_id" not in outcomes.columns
    assert outcomes.select("request_id").distinct().count() == 3
    row = prediction_log.prediction_metrics(outcomes).first()
    assert (row["total_requests"], row["failed_predictions"], row["predicted_churn_rate"]) == (3, 1, 0.5)
    assert (row["average_churn_probability"], row["average_latency_ms"]) == (0.5, 16.0)


def test_stream_equals_batch_and_goes_on_after_a_stop(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / name) for name in ("log", "totals", "checkpoint"))

    def stream():
        lines = spark.readStream.text(source)
        run_available(stream_prediction_metrics(prediction_log.from_log_lines(lines), target, checkpoint))
        return read_totals(spark, target).collect()

    first = log(spark, *[ok(f"a{n}", n / 20, n) for n in range(20)])
    second = log(spark, *[failed(f"b{n}", 30 + n) for n in range(5)], ok("c", 0.7, 99, "2"))
    prediction_log.to_log_lines(first).write.text(source)
    assert stream()[0]["total_requests"] == 20
    prediction_log.to_log_lines(second).write.mode("append").text(source)
    totals = sorted(stream())
    batch = prediction_log.from_log_lines(spark.read.text(source))
    assert totals == sorted(prediction_log.prediction_metrics(batch).collect())
    assert sum(row["total_requests"] for row in totals) == 26


def test_a_long_stream_leaves_two_folders(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "totals")
    rows = log(spark, ok("a", 0.5))

    def write(batch):
        rows.repartition(1).write.mode("overwrite").parquet(f"{target}/batch={batch}")

    for batch in range(50):
        write(batch)
        retire_batches(spark, target, batch)
    assert complete_batches(spark, target) == [48, 49]
    # A crash between write and removal: nothing is lost, and the next batch removes what was left.
    write(50)
    assert complete_batches(spark, target) == [48, 49, 50] and read_totals(spark, target).count() == 1
    write(50)
    retire_batches(spark, target, 50)
    retire_batches(spark, target, 50)
    assert complete_batches(spark, target) == [49, 50]
    # A write that was cut off has no mark: readers do not see it and it does not retire anything.
    (tmp_path / "totals" / "batch=51").mkdir()
    retire_batches(spark, target, 51)
    assert complete_batches(spark, target) == [49, 50] and read_totals(spark, target).count() == 1
    with pytest.raises(ValueError, match="no complete totals"):
        read_totals(spark, str(tmp_path / "nowhere"))


def test_log_lines_keep_microseconds(spark):
    row = ("a", "success", 1.0, 0.5, 1, None, dt.datetime(2024, 1, 1, 12, 0, 0, 123456), "churn", "1")
    lines = prediction_log.to_log_lines(log(spark, row))
    assert prediction_log.from_log_lines(lines).first()["timestamp"] == row[6]
