import pytest
from pyspark.sql import functions as F

from ebbline.columns import FEATURE_COLUMNS
from ebbline.operators import missing, profile, quality


def contract(spark, *rows, label="int"):
    return spark.createDataFrame(rows, f"user_id string, churn {label}")


def test_valid_contract_passes(spark):
    quality.validate_training_data(contract(spark, ("a", 0), ("b", 1)))
    quality.validate_training_data(contract(spark, ("a", 0.0), ("b", 1.0), label="double"))


@pytest.mark.parametrize(
    "rows,message",
    [
        ([("a", 0), ("a", 1)], "unique"),
        ([(None, 0), ("a", 1)], "unique"),
        ([("a", 0), ("b", 2)], "not binary: 1 rows"),
        ([("a", None)], "binary"),
        ([], "no row"),
    ],
)
def test_broken_contracts_are_named(spark, rows, message):
    with pytest.raises(ValueError, match=message):
        quality.validate_training_data(contract(spark, *rows))


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="churn"):
        quality.validate_training_data(spark.createDataFrame([("a",)], "user_id string"))


def test_null_label_is_refused_for_training_only(spark):
    df = contract(spark, ("a", 0), ("b", 1), ("c", None))
    quality.validate_training_data(df)
    with pytest.raises(ValueError, match="1 rows have no"):
        quality.validate_training_data(df, require_labels=True)


def test_direct_identifiers_are_found(spark):
    df = spark.createDataFrame([("a", "b")], "Email string, canal string")
    assert quality.direct_identifiers(df) == ["email"]


def test_negative_measures_are_refused_with_their_reasons(spark):
    df = spark.createDataFrame(
        [(1, -1.0, None, -5.0), (2, None, 0.0, -5.0), (3, -1.0, -2.0, 1.0)],
        "user_id int, order_count double, total_items double, age_group double",
    )
    accepted, refused = quality.split_scoring_rows(df, ["order_count", "total_items"])
    assert [row["user_id"] for row in accepted.collect()] == [2]
    assert {row["user_id"]: row["reasons"] for row in refused.collect()} == {
        1: ["order_count < 0"],
        3: ["order_count < 0", "total_items < 0"],
    }


def test_default_measures_leave_codes_alone():
    assert set(FEATURE_COLUMNS) - set(quality.NON_NEGATIVE_FEATURES) == {
        "age_group", "gender", "canal", "country", "platform"
    }


def test_missing_values_cover_null_nan_and_null_like_texts(spark):
    df = spark.createDataFrame(
        [(1, float("nan"), " N/A "), (None, 1.0, "none"), (3, None, "ok"), (4, 2.0, None)],
        "`a.b` int, x double, t string",
    )
    rows = [tuple(row) for row in missing.get_missing_values(df).collect()]
    assert rows == [("t", 3, 0.75), ("x", 2, 0.5), ("a.b", 1, 0.25)]
    full = df.withColumn("full", F.lit(1))
    assert missing.get_missing_values(full, only_missing=True).count() == 3
    assert missing.get_missing_values(full).collect()[-1]["missing_count"] == 0


def test_missing_values_of_an_empty_frame_fail(spark):
    with pytest.raises(Exception, match="no rows"):
        missing.get_missing_values(spark.createDataFrame([], "a int")).collect()


def test_profiles(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), ("b", None), (None, "x")], "k string, v string")
    assert {tuple(row) for row in profile.distinct_counts(df, ["k", "v"]).collect()} == {("k", 2), ("v", 1)}
    approximate = profile.distinct_counts(df, ["k", "v"], approximate=True)
    assert {tuple(row) for row in approximate.collect()} == {("k", 2), ("v", 1)}
    assert tuple(profile.key_profile(df, "k").first()) == (4, 2, 1)
    assert {tuple(row) for row in profile.group_counts(df, "v").collect()} == {("x", 2), (None, 2)}
    assert profile.distinct_values(df, "k").count() == 3
    assert profile.containing(df, "k", "a").count() == 2
