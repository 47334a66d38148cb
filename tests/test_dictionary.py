import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ebbline.operators import dictionary
from ebbline.operators.dictionary import CategoryDictionary, write_dictionary
from ebbline.operators.preprocess import PreprocessorStatistics


def rows_of(spark, size=600):
    rng = random.Random(4)
    values = [None, "", "a", "b'", "\\n", "\U0001f600", "￰", "Z"]
    rows = [(n, rng.choice(values), rng.choice(["x", "y", None]), None) for n in range(size)]
    return spark.createDataFrame(rows, "id long, first string, `second part` string, nothing string").repartition(5)


def test_vectors_equal_those_of_the_dictionary_in_the_model(spark, tmp_path):
    df, columns = rows_of(spark), ["first", "second part", "nothing"]
    write_dictionary(df, columns, str(tmp_path / "d"))
    stored = CategoryDictionary(spark, str(tmp_path / "d"))
    known = PreprocessorStatistics.of(df, [], columns)
    assert stored.modes == known.modes
    for name, categories in known.categories.items():
        found = stored.categories(name).orderBy("index").collect()
        assert [row["category"] for row in found] == categories
        assert [row["index"] for row in found] == list(range(len(categories)))
    asked = df.unionByName(spark.createDataFrame([(-1, "unseen", "x", None)], df.schema))
    vectors = stored.with_vectors(asked)
    assert vectors.columns == [*df.columns, "one_hot_first", "one_hot_second part"]
    for row in vectors.withColumn("v", vector_to_array("one_hot_first")).collect():
        value = known.modes["first"] if row["first"] is None else row["first"]
        assert row["v"] == [float(category == value) for category in known.categories["first"]]


def test_many_categories_and_a_hot_one_without_fetching_them(spark, tmp_path, monkeypatch):
    df = spark.range(300_000).select("id", F.when(F.col("id") % 3 > 0, F.md5(F.col("id").cast("string"))).otherwise("hot").alias("c"))
    fetched = []
    frame = type(df)
    collect = frame.collect
    monkeypatch.setattr(frame, "collect", lambda self: fetched.append(collect(self)) or fetched[-1])
    write_dictionary(df, ["c"], str(tmp_path / "d"))
    stored = CategoryDictionary(spark, str(tmp_path / "d"))
    assert max(map(len, fetched)) <= 300
    assert stored.sizes == {"c": 200_001} and stored.modes == {"c": "hot"}
    numbers = stored.categories("c").agg(F.min("index"), F.max("index"), F.count_distinct("index")).first()
    assert tuple(numbers) == (0, 200_000, 200_001)
    vector = stored.with_vectors(df.where("id < 9")).first()["one_hot_c"]
    assert vector.size == 200_001 and vector.numNonzeros() == 1


def test_lost_write_and_empty_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "d")
    write_dictionary(rows_of(spark).limit(0), ["first"], path)
    empty = CategoryDictionary(spark, path)
    assert empty.sizes == {} and empty.with_vectors(rows_of(spark, 3)).count() == 3
    write_dictionary(rows_of(spark), ["first"], path)
    monkeypatch.setattr(dictionary, "category_counts", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        write_dictionary(rows_of(spark), ["first"], path)
    assert CategoryDictionary(spark, path).sizes == {}
