"""Readers of the three raw datasets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ebbline.functions.values import STRICT

CORRUPT = "corrupt_record"


def _texts(*names: str) -> StructType:
    return StructType([StructField(name, StringType()) for name in names])


@dataclass(frozen=True)
class RawSchemas:
    """Explicit schemas: no inference pass over the files, and no type that depends on the data.

    Every field is text.  The cleaners parse it, strictly or permissively.
    """

    users: StructType = _texts(
        "id", "email", "creation_date", "last_activity_date", "firstname", "lastname", "address",
        "canal", "country", "gender", "age_group", "churn",
    )
    orders: StructType = _texts("id", "user_id", "amount", "item_count", "transaction_date")
    events: StructType = _texts("event_id", "user_id", "session_id", "platform", "action", "date")


def load_raw_data(
    spark: SparkSession,
    users_path: str,
    orders_path: str,
    events_path: str,
    schemas: RawSchemas | None = RawSchemas(),
    mode: str = STRICT,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Users and orders from JSON lines, events from CSV with a header.

    Events are taken by the names in the header, whatever their order; further columns are left out and a missing
    one is an error, as are files whose headers differ.  In strict mode a line that is no record fails the job.  In
    permissive mode it becomes a row of nulls whose text stands in ``corrupt_record``, which ``raw_parse_losses``
    counts. ``schemas=None`` lets Spark infer the types, which reads every file once more.
    """
    csv = spark.read.option("header", True)
    if schemas is None:
        users, orders = spark.read.json(users_path), spark.read.json(orders_path)
        return users, orders, csv.option("inferSchema", True).csv(events_path)
    # Without inference this reads the header alone.
    header = csv.csv(events_path).columns
    absent = [name for name in schemas.events.names if name not in header]
    if absent:
        raise ValueError(f"the events have no column {absent}")
    corrupt = [] if mode == STRICT else [CORRUPT]
    handling = {"mode": "FAILFAST"} if mode == STRICT else {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}

    def json_lines(schema: StructType, path: str) -> DataFrame:
        return spark.read.options(**handling).schema(_texts(*schema.names, *corrupt)).json(path)

    # A line is short only in comparison with all columns, so they are all parsed before some are left out.
    lines = csv.options(**handling, enforceSchema=False).schema(_texts(*header, *corrupt))
    events = lines.option("columnPruning", False).csv(events_path).select(*schemas.events.names, *corrupt)
    return json_lines(schemas.users, users_path), json_lines(schemas.orders, orders_path), events


def raw_parse_losses(frames: dict[str, DataFrame]) -> DataFrame:
    """``dataset, lost_lines``: the lines of each permissively read frame that are no records."""

    def lost(frame: DataFrame) -> Column:
        # Spark refuses to read the text of broken lines alone, so a column is read beside it.
        beside = F.coalesce(F.col(frame.columns[0]), F.lit(""))
        return F.count(F.when(F.col(CORRUPT).isNotNull(), beside))

    counts = [
        frame.agg(F.lit(name).alias("dataset"), lost(frame).alias("lost_lines")) for name, frame in frames.items()
    ]
    report = counts[0]
    for count in counts[1:]:
        report = report.unionByName(count)
    return report
