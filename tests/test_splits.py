import hashlib
import math

import pytest
from pyspark.sql import functions as F

from ebbline.operators import splits


def labelled(spark, zeros, ones):
    rows = [(f"id{n}", int(n >= zeros)) for n in range(zeros + ones)]
    return spark.createDataFrame(rows, "user_id string, churn int").repartition(3)


def brute_order(df, label, seed):
    ids = [row["user_id"] for row in df.collect() if row["churn"] == label]
    return sorted(ids, key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i))


@pytest.mark.parametrize("zeros,ones", [(10, 10), (137, 41), (1, 3), (5, 0)])
@pytest.mark.parametrize("test_size", [0.2, 0.33])
def test_split_takes_the_first_rows_of_the_hash_order(spark, zeros, ones, test_size):
    df = labelled(spark, zeros, ones)
    split = splits.stratified_split(df, "churn", "user_id", test_size, seed=42).collect()
    sizes = splits.split_sizes({0: zeros, 1: ones}, test_size)
    assert sum(sizes.values()) == math.ceil(test_size * (zeros + ones))
    for label in (0, 1):
        expected = set(brute_order(df, label, 42)[: sizes[label]])
        assert {row["user_id"] for row in split if row["churn"] == label and row["is_test"]} == expected
    assert len(split) == zeros + ones and all(row["is_test"] is not None for row in split)


def test_split_is_the_same_for_the_same_seed_and_keeps_shares(spark):
    df = labelled(spark, 80, 20)
    first = splits.stratified_split(df, "churn", "user_id")
    second = splits.stratified_split(df.orderBy(F.desc("user_id")), "churn", "user_id")
    assert sorted(first.collect()) == sorted(second.collect())
    other = splits.stratified_split(df, "churn", "user_id", seed=7)
    assert sorted(first.collect()) != sorted(other.collect())
    test = [row["churn"] for row in first.where("is_test").collect()]
    assert (len(test), sum(test)) == (20, 4)


@pytest.mark.parametrize("folds", [2, 3, 5])
def test_folds_are_consecutive_parts_of_the_hash_order(spark, folds):
    df = labelled(spark, 100, 32)
    rows = splits.stratified_folds(df, "churn", "user_id", folds).collect()
    for label, size in ((0, 100), (1, 32)):
        fold_of = {row["user_id"]: row["fold"] for row in rows if row["churn"] == label}
        in_order = [fold_of[i] for i in brute_order(df, label, 42)]
        assert in_order == sorted(in_order)
        sizes = [in_order.count(fold) for fold in range(folds)]
        assert sum(sizes) == size and max(sizes) - min(sizes) <= 1


def test_largest_remainder_sizes():
    assert splits.split_sizes({0: 10, 1: 10}, 0.2) == {0: 2, 1: 2}
    assert splits.split_sizes({0: 928, 1: 572}, 0.2) == {0: 186, 1: 114}
    assert splits.split_sizes({0: 0, 1: 0}, 0.2) == {0: 0, 1: 0}


def test_labels_other_than_zero_and_one_fail(spark):
    df = spark.createDataFrame([("a", 0), ("b", None)], "user_id string, churn int")
    with pytest.raises(Exception, match="must be 0 or 1"):
        splits.stratified_split(df, "churn", "user_id").collect()


def test_numeric_ids(spark):
    df = spark.range(50).select(F.col("id").alias("user_id"), (F.col("id") % 2).alias("churn"))
    assert splits.stratified_split(df, "churn", "user_id").where("is_test").count() == 10


@pytest.mark.parametrize("split", [splits.stratified_split, splits.stratified_folds])
def test_null_ids_are_refused(spark, split):
    df = spark.createDataFrame([("a", 0), (None, 0), ("b", 1)], "id string, label int")
    with pytest.raises(Exception, match="id must not be null"):
        split(df, "label", "id").collect()


@pytest.mark.parametrize("most_ranked", [1, 7])
def test_crowded_prefixes_are_split_by_more_digits(spark, monkeypatch, most_ranked):
    monkeypatch.setattr(splits, "PREFIX_DIGITS", 1)
    df = labelled(spark, 700, 150)
    rows = splits.stratified_folds(df, "churn", "user_id", 4, most_ranked=most_ranked).collect()
    assert sorted(rows) == sorted(splits.stratified_folds(df, "churn", "user_id", 4).collect())
    order = splits.HashOrder(df, "churn", "user_id", 42, most_ranked)
    ranked = []
    monkeypatch.setattr(order, "_ranked", lambda groups: ranked.extend(groups) or {})
    order._cut_keys({0: [100, 500], 1: [30]})
    assert len(ranked) == 3 and all(group.rows <= most_ranked for group in ranked)


def test_an_id_with_a_third_of_the_rows_lies_on_one_side(spark):
    rows = [("hot", 0)] * 200 + [(f"id{n}", 0) for n in range(400)]
    df = spark.createDataFrame(rows, "id string, label int").repartition(3)
    at = sorted(rows, key=lambda r: hashlib.md5(f"42:{r[0]}".encode()).hexdigest())
    for size in (0.1, 0.5, 0.9):
        found = splits.stratified_split(df, "label", "id", size, most_ranked=5).where("is_test").collect()
        cut = at[math.ceil(600 * size) - 1][0]
        last = max(n for n, row in enumerate(at) if row[0] == cut)
        assert sorted(row["id"] for row in found) == sorted(row[0] for row in at[: last + 1])
