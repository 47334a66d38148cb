import datetime as dt
import hashlib

import pytest

from ebbline.operators import clean
from ebbline.sources.raw import RawSchemas

USER = {
    "id": "u1",
    "email": "a@example.com",
    "creation_date": "01-31-2023 23:59:59",
    "last_activity_date": "02-01-2023 00:00:00",
    "firstname": "jEAN-luc",
    "lastname": "o'NEIL smith",
    "address": " 1 Road ",
    "canal": "WEBAPP",
    "country": " ",
    "gender": " 1 ",
    "age_group": None,
    "churn": "0",
}


def frame(spark, schema, *rows):
    return spark.createDataFrame([tuple(row.get(name) for name in schema.names) for row in rows], schema)


def test_users_are_typed_hashed_and_capitalised(spark):
    row = clean.clean_users(frame(spark, RawSchemas().users, USER)).first()
    assert row["user_id"] == "u1"
    assert row["email"] == hashlib.sha1(b"a@example.com").hexdigest()
    assert row["creation_date"] == dt.datetime(2023, 1, 31, 23, 59, 59)
    assert (row["firstname"], row["lastname"]) == ("Jean-luc", "O'neil Smith")
    assert (row["address"], row["country"]) == (" 1 Road ", " ")
    assert (row["gender"], row["age_group"], row["churn"]) == (1, None, 0)


@pytest.mark.parametrize("field,value", [("gender", "12.5"), ("creation_date", "2024-01-01"), ("churn", "x")])
def test_bad_text_fails_when_strict_and_is_counted_when_permissive(spark, field, value):
    raw = frame(spark, RawSchemas().users, USER, {**USER, "id": "u2", field: value})
    with pytest.raises(Exception):
        clean.clean_users(raw).collect()
    second = {row["user_id"]: row for row in clean.clean_users(raw, "permissive").collect()}["u2"]
    assert second[field] is None
    losses = {row["column"]: row["lost_values"] for row in clean.parse_losses(raw, clean.USERS).collect()}
    assert losses == {name: int(name == field) for name in losses}


def test_unknown_mode_is_refused(spark):
    with pytest.raises(ValueError, match="mode"):
        clean.clean_users(frame(spark, RawSchemas().users, USER), "loose")


def test_doubles_are_cut_toward_zero(spark):
    raw = spark.createDataFrame(
        [("o1", "u1", 12.9, -12.9, "01-01-2024 00:00:00")],
        "id string, user_id string, amount double, item_count double, transaction_date string",
    )
    row = clean.clean_orders(raw).first()
    assert (row["amount"], row["item_count"]) == (12, -12)


def test_orders_keep_rows_without_user(spark):
    raw = frame(spark, RawSchemas().orders, {"id": "o1", "amount": "5"})
    assert clean.clean_orders(raw).count() == 1


def test_events_without_ids_go_and_categories_are_normalised(spark):
    schema = RawSchemas().events
    base = {"event_id": "e", "user_id": "u", "session_id": "s", "date": "01-02-2024 03:04:05"}
    raw = frame(
        spark,
        schema,
        {**base, "platform": " iOS ", "action": "VIEW "},
        {**base, "platform": "  ", "action": None},
        {**base, "event_id": None},
        {**base, "user_id": None},
    )
    rows = [(row["platform"], row["action"]) for row in clean.clean_events(raw).collect()]
    assert sorted(rows) == [("", "unknown"), ("ios", "view")]
