import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ebbline.columns import FEATURE_COLUMNS, NUMERIC_FEATURES, STRING_FEATURES
from ebbline.operators import preprocess, scoring


def three_rows(spark):
    rows = [
        tuple(text if name in STRING_FEATURES else number for name in FEATURE_COLUMNS)
        for text, number in (("category_a", 1.0), ("category_b", None), (None, 12.0))
    ]
    types = ", ".join(f"{n} {'string' if n in STRING_FEATURES else 'double'}" for n in FEATURE_COLUMNS)
    return spark.createDataFrame(rows, types)


def unseen_row(spark):
    rows = [tuple("previously_unknown_category" if n in STRING_FEATURES else 4.0 for n in FEATURE_COLUMNS)]
    types = ", ".join(f"{n} {'string' if n in STRING_FEATURES else 'double'}" for n in FEATURE_COLUMNS)
    return spark.createDataFrame(rows, types)


def vectors(model, df):
    return np.array([row[0] for row in model.transform(df).select(vector_to_array("features")).collect()])


def test_missing_and_unknown_values_give_finite_rows_of_one_width(spark, tmp_path):
    train = three_rows(spark)
    model = preprocess.build_preprocessor(train).fit(train)
    fitted, unseen = vectors(model, train), vectors(model, unseen_row(spark))
    assert fitted.shape == (3, 12 + 3 * 2) and unseen.shape == (1, 18)
    assert np.isfinite(fitted).all() and np.isfinite(unseen).all()
    assert (unseen[0, 12:] == 0).all()
    # median 6.5, population deviation of 1, 6.5, 12; the null category takes the smaller of two equal modes
    std = np.std([1.0, 6.5, 12.0])
    assert fitted[:, 0] == pytest.approx([-5.5 / std, 0.0, 5.5 / std])
    assert fitted[2, 12:14].tolist() == [1.0, 0.0]

    model.save(str(tmp_path / "model"))
    assert (vectors(PipelineModel.load(str(tmp_path / "model")), train) == fitted).all()


def test_constant_column_becomes_zero_and_empty_column_is_left_out(spark):
    df = spark.createDataFrame([(5, None, True, "x"), (5, None, False, "y")], "a int, b double, c boolean, t string")
    assert preprocess.numeric_columns(df) == ["a", "b", "c"]
    assert preprocess.category_columns(df) == ["t"]
    model = preprocess.build_preprocessor(df).fit(df)
    assert vectors(model, df).tolist() == [[0.0, 1.0, 1.0, 0.0], [0.0, -1.0, 0.0, 1.0]]


def test_categories_with_quotes_and_backslashes(spark):
    values = ["it's", 'say "x"', "back\\slash", " ", "", "a\nb"]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), ("it's",)], "t string")
    model = preprocess.build_preprocessor(df).fit(df)
    rows = vectors(model, df)
    assert rows.shape == (8, 6) and (rows.sum(axis=1) == 1).all()
    assert (rows[6] == rows[0]).all()


def test_a_stated_bound_on_categories_is_checked_before_they_are_fetched(spark):
    df = spark.range(6).select(F.col("id").cast("string").alias("t"))
    with pytest.raises(Exception, match="6 categories"):
        preprocess.build_preprocessor(df, max_categories=5).fit(df)
    assert vectors(preprocess.build_preprocessor(df).fit(df), df).shape == (6, 6)


def test_a_wide_column_may_be_hashed(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "y"), ("a", None), (None, "x")], "t string, u string")
    model = preprocess.build_preprocessor(df, hashed={"t": 16}).fit(df)
    rows = vectors(model, df)
    assert rows.shape == (4, 18) and (rows.sum(axis=1) == 2).all()
    assert (rows[0] == rows[2])[2:].all() and (rows[0] == rows[3]).all()


def test_input_is_aligned_to_the_model(spark):
    request = spark.createDataFrame([(12, "850.5", " ")], "order_count int, total_amount string, canal string")
    aligned = scoring.prepare_input(request, blanks_to_null=True)
    assert aligned.columns == FEATURE_COLUMNS
    assert all(dict(aligned.dtypes)[name] == "double" for name in NUMERIC_FEATURES)
    row = aligned.first()
    assert (row["order_count"], row["total_amount"], row["canal"], row["platform"]) == (12.0, 850.5, None, None)
    assert scoring.prepare_input(request).first()["canal"] == " "


def test_an_empty_request_stays_all_null(spark):
    row = scoring.prepare_input(spark.range(1)).first()
    assert all(value is None for value in row)
