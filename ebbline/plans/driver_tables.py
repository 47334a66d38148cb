"""Raw-shaped users, orders and events derived from the given Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _text(expression: str) -> str:
    return f"CAST({expression} AS STRING)"


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    created = "date_add(DATE '2022-01-01', CAST(c_custkey % 600 AS INT))"
    active = "date_add(DATE '2023-10-01', CAST((c_custkey * 7) % 120 AS INT))"
    return read(spark, sf_dir, "customer").selectExpr(
        f"{_text('c_custkey')} AS id",
        f"'user' || {_text('c_custkey')} || '@example.com' AS email",
        f"date_format({created}, 'MM-dd-yyyy') || ' 08:00:00' AS creation_date",
        f"date_format({active}, 'MM-dd-yyyy') || ' 21:30:00' AS last_activity_date",
        "lower(c_mktsegment) AS firstname",
        "upper(c_mktsegment) AS lastname",
        f"'addr ' || {_text('c_custkey')} AS address",
        """CASE WHEN c_custkey % 17 = 0 THEN NULL
                WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'WEBAPP'
                WHEN c_mktsegment = 'FURNITURE' THEN 'PHONE' ELSE 'MOBILE' END AS canal""",
        """CASE WHEN c_custkey % 23 = 0 THEN ' ' WHEN c_nationkey < 10 THEN 'FR'
                WHEN c_nationkey < 18 THEN 'USA' ELSE 'SPAIN' END AS country""",
        f"{_text('c_custkey % 2')} AS gender",
        f"CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE {_text('(c_custkey * 13) % 11')} END AS age_group",
        """CASE WHEN (c_custkey * 2654435761) % 100 < (CASE WHEN c_acctbal < 3000 THEN 60 ELSE 25 END)
                THEN '1' ELSE '0' END AS churn""",
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    orders = read(spark, sf_dir, "orders")
    return orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left").selectExpr(
        f"{_text('o_orderkey')} AS id",
        f"CASE WHEN o_custkey % 10 = 0 THEN 'x' ELSE '' END || {_text('o_custkey')} AS user_id",
        f"{_text('CAST(o_totalprice AS INT)')} AS amount",
        f"{_text('n')} AS item_count",
        "date_format(date_add(CAST(o_orderdate AS DATE), 8035), 'MM-dd-yyyy') || ' 12:00:00' AS transaction_date",
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").selectExpr(
        f"CASE WHEN event_id % 101 = 0 THEN NULL ELSE {_text('event_id')} END AS event_id",
        f"CASE WHEN event_id % 97 = 0 THEN NULL ELSE {_text('user_id')} END AS user_id",
        f"{_text('user_id')} || '-' || date_format(ts, 'yyyyMMdd') AS session_id",
        "CASE event_id % 4 WHEN 0 THEN ' iOS ' WHEN 1 THEN 'ANDROID' WHEN 2 THEN 'other' ELSE NULL END AS platform",
        "' ' || upper(event_type) AS action",
        "date_format(ts, 'MM-dd-yyyy HH:mm:ss') AS date",
    )


def raw_orders_with_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw orders in which some amounts are no numbers and some dates have another format."""
    return raw_orders(spark, sf_dir).selectExpr(
        "id",
        "user_id",
        "CASE WHEN CAST(id AS BIGINT) % 13 = 0 THEN 'n/a' ELSE amount END AS amount",
        "item_count",
        "CASE WHEN CAST(id AS BIGINT) % 11 = 0 THEN '2024-01-01' ELSE transaction_date END AS transaction_date",
    )


def broken_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw orders as JSON lines, of which some end too early."""
    line = F.to_json(F.struct("id", "user_id", "amount", "item_count", "transaction_date"))
    cut = F.col("id").cast("long") % 17 == 0
    return raw_orders(spark, sf_dir).select(
        F.when(cut, F.substring(line, 1, 20)).otherwise(line).alias("value")
    )


def broken_event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as CSV lines below a header of other order, of which some lack columns.  The header is the column's name."""
    names = ["date", "user_id", "url", "session_id", "event_id", "action", "platform"]
    short = F.col("event_id") % 19 == 0
    texts = read(spark, sf_dir, "events").selectExpr(
        "event_id", "CAST(user_id AS STRING) AS user_id", "date_format(ts, 'MM-dd-yyyy HH:mm:ss') AS date", "event_type AS action"
    )
    line = F.concat_ws(",", "date", "user_id", F.lit("x"), F.lit("s"), F.col("event_id").cast("string"), "action", F.lit("ios"))
    return texts.select(F.when(short, F.concat_ws(",", "date", "user_id")).otherwise(line).alias(",".join(names)))


def psi_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    lines = read(spark, sf_dir, "lineitem")
    border = F.lit("1998-06-01").cast("timestamp_ntz")
    columns = ["l_quantity", "l_extendedprice", "l_discount"]
    before = lines.where(F.col("l_shipdate") < border).select(columns)
    after = lines.where(F.col("l_shipdate") >= border).select([(F.col(c) * 1.1).alias(c) for c in columns])
    return before, after


def binary_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select("doc_id", "n_chars")
    scored = read(spark, sf_dir, "labels").join(documents, "doc_id")
    return scored.select(
        F.col("quality").alias("label"), F.floor(F.col("n_chars") / 200).cast("double").alias("score")
    )


def scoring_rows(gold: DataFrame) -> DataFrame:
    flipped = F.col("user_id").cast("long") % 10 == 3
    return gold.withColumn(
        "order_count", F.when(flipped, -F.col("order_count") - 1).otherwise(F.col("order_count"))
    )


def scored_pair(gold: DataFrame) -> tuple[DataFrame, DataFrame]:
    number = F.col("user_id").cast("long")
    first = ((number * 37) % 101) / F.lit(100.0)
    second = F.when(number % 50 == 0, 1 - first).otherwise(first)

    def scored(probability):
        return gold.select(
            "user_id",
            probability.alias("churn_probability"),
            (probability >= 0.5).cast("int").alias("prediction"),
        )

    return scored(first), scored(second)


_STATUS = "CASE o_orderstatus WHEN 'F' THEN 'FINISHED' WHEN 'O' THEN 'RUNNING' ELSE 'FAILED' END AS status"


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run table from orders; the run name depends on the priority and the status on the order status."""
    multipliers = {"pr_auc": 7919, "accuracy": 7907, "precision": 7901, "recall": 7883, "f1": 7879, "roc_auc": 7877}
    name = """CASE o_orderpriority WHEN '1-URGENT' THEN 'random_forest'
                   WHEN '2-HIGH' THEN 'random_forest_tuned' ELSE 'dummy' END"""
    return read(spark, sf_dir, "orders").selectExpr(
        f"{name} AS run_name",
        "o_orderkey AS run_id",
        "CAST(o_orderdate AS TIMESTAMP) AS start_time",
        _STATUS,
        *[f"((o_orderkey * {m}) % 10000) / 10000.0D AS `metrics.{metric}`" for metric, m in multipliers.items()],
        f"CASE WHEN {name} = 'random_forest_tuned' THEN ((o_orderkey * 7873) % 10000) / 10000.0D END"
        " AS `metrics.cv_pr_auc`",
        "CASE o_orderkey % 4 WHEN 0 THEN '200' WHEN 1 THEN '300' WHEN 2 THEN '500' END AS `params.n_estimators`",
        "CASE o_orderkey % 3 WHEN 0 THEN '8' WHEN 1 THEN '12' END AS `params.max_depth`",
        "CASE o_orderkey % 2 WHEN 0 THEN 'sqrt' END AS `params.max_features`",
    )


def selections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").selectExpr(
        "CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'model_selection' ELSE 'dummy' END AS run_name",
        "o_orderkey AS run_id",
        "CAST(o_orderdate AS TIMESTAMP) AS start_time",
        _STATUS,
        f"{_text('o_custkey')} AS `params.selected_run_id`",
    )


def artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored models from line items: odd lines name their order as source run, even lines as run."""
    return read(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey * 10 + l_linenumber AS model_id",
        "CASE WHEN l_linenumber % 2 = 1 THEN l_orderkey END AS source_run_id",
        "CASE WHEN l_linenumber % 2 = 0 THEN l_orderkey END AS run_id",
        "CASE WHEN l_returnflag = 'A' THEN 'FAILED' ELSE 'READY' END AS status",
        "CAST(l_shipdate AS TIMESTAMP) AS creation_time",
    )


EVENTS_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def prediction_outcomes(events: DataFrame) -> DataFrame:
    """Scoring requests from events, for a batch or a streaming frame of them."""
    ok = F.col("event_type") != "error"
    return events.select(
        F.col("event_id").cast("string").alias("request_id"),
        F.when(ok, "success").otherwise("failed").alias("status"),
        F.col("value").alias("latency_ms"),
        F.when(ok, F.col("value") / 500).alias("churn_probability"),
        F.when(ok, (F.col("value") >= 250).cast("int")).alias("prediction"),
        F.when(~ok, "RuntimeError").alias("error_type"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit("churn_model").alias("model_name"),
        F.lit("1").alias("model_version"),
    )
