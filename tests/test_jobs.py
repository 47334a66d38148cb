import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from ebbline.operators import models
from ebbline.operators.runs import get_selected_run_id
from ebbline.plans import driver_tables, jobs
from ebbline.sources import (
    RawSchemas,
    create_snapshot_once,
    list_schemas,
    list_tables,
    load_raw_data,
    raw_parse_losses,
    read_snapshot,
    session_info,
    write_table,
)

AS_OF = dt.date(2024, 2, 1)


def write_raw(spark, root):
    driver_tables.raw_users(spark, SMALL).write.json(f"{root}/users")
    driver_tables.raw_orders(spark, SMALL).write.json(f"{root}/orders")
    driver_tables.raw_events(spark, SMALL).write.option("header", True).csv(f"{root}/events")
    return [f"{root}/{name}" for name in ("users", "orders", "events")]


def test_from_raw_files_to_a_decision_and_a_drift_report(spark, tmp_path):
    names = jobs.Names(schema="churn_chain")
    paths = write_raw(spark, str(tmp_path / "raw"))
    counts = {row["table_name"]: row["row_count"] for row in jobs.silver_job(spark, names, *paths).collect()}
    assert counts[names.table("silver_users")] == 150
    written = jobs.gold_job(spark, names, AS_OF).first()["row_count"]
    assert written == 150
    gold = spark.table(names.table(names.gold))

    models_path = str(tmp_path / "models")
    runs = jobs.training_job(spark, names, models_path, only=["dummy", "logistic_regression"])
    assert runs.count() == 2
    assert jobs.read_records(spark, names, names.runs).count() == 2

    # The decision needs the two forest runs; the recorded rows are renamed instead of fitting forests.
    renamed = runs.withColumn(
        "run_name", F.when(F.col("run_name") == "dummy", "random_forest").otherwise("random_forest_tuned")
    )
    jobs._append(renamed.withColumn("params.extra", F.lit("x")), names, names.runs)
    decision = jobs.selection_job(spark, names, str(tmp_path / "reports")).first()
    assert decision["selected_model"] in ("random_forest", "random_forest_tuned")
    chosen = get_selected_run_id(jobs.read_records(spark, names, names.runs))
    assert chosen == decision["selected_run_id"]
    model = jobs.load_selected_model(spark, names)
    rows, _ = jobs.validation_job(gold, model, str(tmp_path / "reloaded"), 10, str(tmp_path / "validation"))
    assert rows.count() == 10
    assert spark.read.json(str(tmp_path / "validation" / "summary")).first()["prediction_agreement"] == 1.0
    predictions = spark.read.option("header", True).csv(str(tmp_path / "validation" / "predictions"))
    assert predictions.columns == ["sample_row", "prediction", "churn_probability"] and predictions.count() == 10
    comparison = spark.read.option("header", True).csv(str(tmp_path / "reports" / "model_comparison"))
    assert comparison.count() == 2
    summary = spark.read.json(str(tmp_path / "reports" / "selection_summary")).first()
    assert all(f"tuned_{name}" in summary.asDict() for name in ("n_estimators", "max_depth", "class_weight"))

    counts = {row["table_name"].rsplit(".", 1)[1]: row["row_count"] for row in jobs.scoring_job(spark, names).collect()}
    assert counts == {"scored_customers": gold.count(), "refused_customers": 0}
    log = jobs.read_prediction_log(spark, names)
    assert log.where("status = 'success' AND churn_probability BETWEEN 0 AND 1").count() == gold.count()
    moved = gold.withColumn("order_count", F.when(F.col("user_id") < "2", -1).otherwise(F.col("order_count")))
    negative = moved.where("order_count < 0").count()
    write_table(moved, names.table("gold_with_negatives"))
    other = dataclasses.replace(names, gold="gold_with_negatives", log="second_log")
    counts = {row["table_name"].rsplit(".", 1)[1]: row["row_count"] for row in jobs.scoring_job(spark, other).collect()}
    assert counts == {"scored_customers": gold.count() - negative, "refused_customers": negative} and negative > 0
    failed = jobs.read_prediction_log(spark, other).where("status = 'failed'")
    assert failed.count() == negative and failed.where("error_type = 'ValueError' AND prediction IS NULL").count() == negative

    snapshot, report = str(tmp_path / "snapshot"), str(tmp_path / "report")
    assert jobs.drift_job(gold, snapshot, report) is None and not (tmp_path / "report").exists()
    again = jobs.drift_job(gold, snapshot, report)
    assert {row["status"] for row in again.collect()} <= {"stable", "not_evaluable"}
    moved = gold.withColumn("days_since_creation", F.col("days_since_creation") + 900)
    later = {row["feature"]: row["status"] for row in jobs.drift_job(moved, snapshot).collect()}
    assert later["days_since_creation"] == "drift" and later["total_items"] == "stable"
    assert spark.read.option("header", True).csv(report).columns == ["feature", "psi", "n_bins", "status"]


def test_gold_job_refuses_repeated_users(spark, tmp_path):
    names = jobs.Names(schema="churn_repeated")
    paths = write_raw(spark, str(tmp_path / "raw"))
    driver_tables.raw_users(spark, SMALL).limit(1).write.mode("append").json(paths[0])
    jobs.silver_job(spark, names, *paths)
    with pytest.raises(ValueError, match="unique"):
        jobs.gold_job(spark, names, AS_OF)
    assert jobs.gold_job(spark, names, AS_OF, check_ids=False).first()["row_count"] == 151


def test_inferred_schema_is_an_option(spark, tmp_path):
    paths = write_raw(spark, str(tmp_path / "raw"))
    users, orders, events = load_raw_data(spark, *paths, schemas=None)
    assert dict(events.dtypes)["event_id"] == "int" and dict(events.dtypes)["date"] == "string"
    explicit = load_raw_data(spark, *paths)
    assert explicit[0].schema == RawSchemas().users
    assert explicit[2].where("event_id IS NULL").count() > 0
    assert users.count() == 150 and orders.count() == explicit[1].count()


def test_a_failing_write_leaves_the_old_table(spark):
    write_table(spark.range(5), "t_staged")
    broken = spark.range(10).select(F.when(F.col("id") < 9, F.col("id")).otherwise(F.raise_error(F.lit("stop"))).alias("id"))
    with pytest.raises(Exception, match="stop"):
        write_table(broken, "t_staged")
    assert spark.table("t_staged").count() == 5
    write_table(spark.table("t_staged").where("id < 3"), "t_staged")  # from itself
    assert sorted(row.id for row in spark.table("t_staged").collect()) == [0, 1, 2]
    assert not spark.catalog.tableExists("t_staged__staged") and not spark.catalog.tableExists("t_staged__retired")


def test_a_swap_that_was_cut_off_is_taken_back(spark, monkeypatch):
    write_table(spark.range(4), "t_cut")
    spark.sql("ALTER TABLE t_cut RENAME TO t_cut__retired")  # crashed before the new table got its name
    broken = spark.range(2).select(F.raise_error(F.lit("stop")).alias("id"))
    with pytest.raises(Exception, match="stop"):
        write_table(broken, "t_cut")
    assert spark.table("t_cut").count() == 4


def test_overwrite_replaces_the_schema_and_buckets_avoid_a_shuffle(spark):
    write_table(spark.range(5), "t_overwrite")
    write_table(spark.createDataFrame([("a", 1)], "k string, v int"), "t_overwrite", bucket_by=(4, "k"))
    assert spark.table("t_overwrite").columns == ["k", "v"]
    plan = spark.table("t_overwrite").groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_the_catalog_can_be_listed(spark):
    write_table(spark.range(2), "default.t_listed")
    assert session_info(spark).first()["catalog"] == "spark_catalog"
    assert "default" in [row[0] for row in list_schemas(spark, "spark_catalog").collect()]
    assert list_tables(spark, "default").where("tableName = 't_listed'").count() == 1


def test_snapshot_is_written_once(spark, tmp_path):
    path = str(tmp_path / "snapshot")
    assert create_snapshot_once(spark.range(3), path)
    assert not create_snapshot_once(spark.range(9), path)
    assert read_snapshot(spark, path).count() == 3


def test_a_half_written_snapshot_is_written_again(spark, tmp_path):
    path = str(tmp_path / "snapshot")
    (tmp_path / "snapshot" / "rows" / "_temporary").mkdir(parents=True)
    with pytest.raises(ValueError, match="no complete snapshot"):
        read_snapshot(spark, path)
    spark.range(2).write.mode("overwrite").parquet(f"{path}/rows")
    assert create_snapshot_once(spark.range(3), path)
    assert read_snapshot(spark, path).count() == 3


def write_events(folder, *lines):
    folder.mkdir()
    (folder / "part.csv").write_text("\n".join(lines) + "\n")


def test_events_are_read_by_the_names_in_the_header(spark, tmp_path):
    paths = write_raw(spark, str(tmp_path / "raw"))
    write_events(tmp_path / "e", "user_id,session_id,event_id,date,platform,action,url", "u1,s1,e1,01-02-2023 03:04:05,ios,view,x")
    row = load_raw_data(spark, paths[0], paths[1], str(tmp_path / "e"))[2].first().asDict()
    assert row == {
        "event_id": "e1", "user_id": "u1", "session_id": "s1", "platform": "ios", "action": "view", "date": "01-02-2023 03:04:05",
    }
    write_events(tmp_path / "m", "user_id,session_id,event_id,date,platform", "u1,s1,e1,x,ios")
    with pytest.raises(ValueError, match="action"):
        load_raw_data(spark, paths[0], paths[1], str(tmp_path / "m"))


def test_broken_lines_fail_or_are_counted(spark, tmp_path):
    paths = write_raw(spark, str(tmp_path / "raw"))
    write_events(tmp_path / "e", "date,event_id,user_id,session_id,platform,action,url", "d,e1,u1,s1,ios,view,x", "d,e2", "d,e3,u1,s1,ios,view,x")
    (tmp_path / "o").mkdir()
    (tmp_path / "o" / "part.json").write_text('{"id": "1", "amount": "3"}\n{"id": "2", "amo\n')
    _, orders, events = load_raw_data(spark, paths[0], str(tmp_path / "o"), str(tmp_path / "e"))
    for frame in (orders, events):
        with pytest.raises(Exception):
            frame.collect()
    _, orders, events = load_raw_data(spark, paths[0], str(tmp_path / "o"), str(tmp_path / "e"), mode="permissive")
    assert orders.count() == 2 and events.count() == 3
    lost = {row["dataset"]: row["lost_lines"] for row in raw_parse_losses({"orders": orders, "events": events}).collect()}
    assert lost == {"orders": 1, "events": 1}


def test_run_frames_may_have_different_parameters(spark):
    now = dt.datetime(2024, 1, 1)
    metrics = dict.fromkeys(["accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc"], 0.5)
    rows = [models.run_row("a", metrics, {"x": 1}, now), models.run_row("b", metrics, {"y": None}, now)]
    frame = models.runs_frame(spark, rows)
    assert [(row["params.x"], row["params.y"]) for row in frame.collect()] == [("1", None), (None, "None")]


def test_gold_job_does_not_exchange_bucketed_users(spark, tmp_path):
    names = jobs.Names(schema="bucketed")
    paths = write_raw(spark, str(tmp_path / "raw"))
    jobs.silver_job(spark, names, *paths, buckets=8)
    users = names.table(names.users)
    assert "Num Buckets" in {row[0] for row in spark.sql(f"DESCRIBE EXTENDED {users}").collect()}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        gold = jobs.gold_frame(spark, names, AS_OF)
        plan = gold._jdf.queryExecution().executedPlan().toString()
        rows = gold.collect()
        other = jobs.gold_frame(spark, names, AS_OF, check_ids=False).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = plan.split("\n")
    scan = next(n for n, line in enumerate(lines) if "FileScan" in line and "silver_users" in line)
    depth = lines[scan].index("FileScan")
    above = []  # what the users pass through: the lines up the tree, each further left than the last
    for line in reversed(lines[:scan]):
        at = len(line) - len(line.lstrip(" :+-"))
        if at < depth:
            above.append(line)
            depth = at
    assert any("Join" in line for line in above) and not any("Exchange" in line for line in above), plan
    assert sorted(map(str, rows)) == sorted(map(str, other))
    spark.sql(f"DROP SCHEMA {names.catalog}.{names.schema} CASCADE")
