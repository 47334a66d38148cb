"""Raw records to typed silver tables.  Each cleaner is one narrow projection."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.functions.values import STRICT, PERMISSIVE, as_int, parse_timestamp


@dataclass(frozen=True)
class ParsedColumns:
    """Silver column -> raw column, for the columns whose text has to be parsed."""

    timestamps: dict[str, str] = field(default_factory=dict)
    integers: dict[str, str] = field(default_factory=dict)

    def expressions(self, mode: str) -> dict:
        parsed = {out: parse_timestamp(raw, mode) for out, raw in self.timestamps.items()}
        parsed |= {out: as_int(raw, mode) for out, raw in self.integers.items()}
        return {out: expression.alias(out) for out, expression in parsed.items()}


USERS = ParsedColumns(
    timestamps={"creation_date": "creation_date", "last_activity_date": "last_activity_date"},
    integers={"gender": "gender", "age_group": "age_group", "churn": "churn"},
)
ORDERS = ParsedColumns(
    timestamps={"creation_date": "transaction_date"},
    integers={"amount": "amount", "item_count": "item_count"},
)
EVENTS = ParsedColumns(timestamps={"event_time": "date"})


def clean_users(raw: DataFrame, mode: str = STRICT) -> DataFrame:
    """Hash the e-mail address, parse dates and codes, capitalise names; other texts pass through."""
    parsed = USERS.expressions(mode)
    return raw.select(
        F.col("id").alias("user_id"),
        F.sha1("email").alias("email"),
        parsed["creation_date"],
        parsed["last_activity_date"],
        *[F.initcap(name).alias(name) for name in ("firstname", "lastname")],
        "address",
        "canal",
        "country",
        parsed["gender"],
        parsed["age_group"],
        parsed["churn"],
    )


def clean_orders(raw: DataFrame, mode: str = STRICT) -> DataFrame:
    parsed = ORDERS.expressions(mode)
    return raw.select(
        parsed["amount"],
        F.col("id").alias("order_id"),
        "user_id",
        parsed["item_count"],
        parsed["creation_date"],
    )


def clean_events(raw: DataFrame, mode: str = STRICT) -> DataFrame:
    """Normalise the two category texts and drop rows without an event or user id."""
    with_ids = raw.where("event_id IS NOT NULL AND user_id IS NOT NULL")
    categories = [
        F.coalesce(F.lower(F.trim(name)), F.lit("unknown")).alias(name) for name in ("platform", "action")
    ]
    return with_ids.select(
        "event_id", "user_id", "session_id", *categories, EVENTS.expressions(mode)["event_time"]
    )


def parse_losses(raw: DataFrame, columns: ParsedColumns) -> DataFrame:
    """How many raw values permissive cleaning would turn into null, per parsed column, in one pass."""
    permissive = columns.expressions(PERMISSIVE)
    sources = columns.timestamps | columns.integers
    counted = raw.agg(
        *[
            F.count_if(F.col(sources[out]).isNotNull() & permissive[out].isNull()).alias(out)
            for out in sources
        ]
    )
    return counted.unpivot([], list(sources), "column", "lost_values")
