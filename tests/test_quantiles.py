import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbline.operators import drift
from ebbline.operators.drift import drift_report, population_stability_index, psi_table
from ebbline.operators.quantiles import ValueHistogram, exact_quantiles

PROBABILITIES = [0, 0.1, 0.25, 0.3, 0.5, 0.77, 0.9, 1]


def column(spark, values, kind="double"):
    return spark.createDataFrame([(value,) for value in values], f"x {kind}").repartition(3)


def samples():
    rng = random.Random(7)
    yield "uniform", [rng.random() for _ in range(2000)]
    yield "hot value", [0.0 if rng.random() < 0.4 else rng.gauss(0, 5) for _ in range(3000)]
    yield "few values", [float(rng.randrange(4)) for _ in range(500)]
    yield "single", [3.5]
    yield "constant", [2.0] * 50
    yield "wide", [10.0 ** rng.randrange(-300, 300) for _ in range(400)]


@pytest.mark.parametrize("name,values", list(samples()))
@pytest.mark.parametrize("buckets", [4, 512])
def test_quantiles_equal_those_of_a_sorted_array(spark, name, values, buckets):
    found = exact_quantiles(column(spark, values), ["x"], PROBABILITIES, buckets)["x"]
    assert found == pytest.approx([float(np.quantile(values, p)) for p in PROBABILITIES], rel=1e-12, abs=1e-300)


def test_missing_text_and_empty_columns(spark):
    df = spark.createDataFrame(
        [(1.0, "x", None, 1), (math.nan, "4", None, 2), (3.0, None, None, 4), (None, "6", None, 9)],
        "a double, b string, c double, d int",
    )
    found = exact_quantiles(df, ["a", "b", "c", "d"], [0.5])
    assert found == {"a": [2.0], "b": [5.0], "c": [None], "d": [3.0]}


def test_distinct_values_are_counted_up_to_the_limit(spark):
    df = spark.range(1000).select(
        F.when(F.col("id") < 990, 0.0).otherwise(F.col("id").cast("double")).alias("x"),
        (F.col("id") % 3).alias("y"),
        F.lit(1).alias("z"),
        F.lit(None).cast("double").alias("n"),
    )
    histogram = ValueHistogram(df, ["x", "y", "z", "n"], buckets=4)
    assert histogram.distinct_up_to(10) == {"x": 10, "y": 3, "z": 1, "n": 0}
    assert histogram.distinct_up_to(50)["x"] == 11


def brute_psi(reference, current, bins=10):
    reference = [x for x in reference if x is not None and not math.isnan(x)]
    current = [x for x in current if x is not None and not math.isnan(x)]
    q = min(bins, len(set(reference)))
    if not reference or not current or q < 2:
        return None
    inner = np.unique(np.quantile(reference, [i / q for i in range(q + 1)]))[1:-1]
    total = 0.0
    for at in range(len(inner) + 1):
        shares = []
        for side in (reference, current):
            inside = sum(1 for x in side if int(np.sum(inner < x)) == at)
            shares.append(max(inside / len(side), 1e-6))
        total += (shares[1] - shares[0]) * math.log(shares[1] / shares[0])
    return total


def test_psi_equals_brute_force(spark):
    rng = random.Random(3)
    cases = {
        "shift": ([rng.gauss(0, 1) for _ in range(900)], [rng.gauss(0.6, 1.2) for _ in range(700)]),
        "codes": ([float(rng.randrange(5)) for _ in range(300)], [float(rng.randrange(3)) for _ in range(400)]),
        "two": ([0.0, 1.0] * 30, [1.0, 1.0, 0.0] * 30),
        "gaps": ([None, math.nan, 1.0, 2.0, 3.0, 4.0], [None, 3.0, 9.0, math.nan]),
        "outside": ([float(x) for x in range(100)], [-5.0, 500.0] * 20),
        "constant": ([1.0] * 9, [1.0, 2.0] * 3),
        "empty side": ([1.0, 2.0, 3.0], [None, math.nan]),
    }
    for name, (reference, current) in cases.items():
        found = population_stability_index(column(spark, reference), column(spark, current), "x")
        expected = brute_psi(reference, current)
        assert (found is None) == (expected is None), name
        if expected is not None:
            assert found == pytest.approx(expected, abs=1e-9), name


def test_psi_of_a_table_with_itself_is_zero(spark, training):
    report = drift_report(training, training).collect()
    assert len(report) == 13  # the twelve numeric features and the label
    assert all(row["psi"] == pytest.approx(0.0, abs=1e-12) and row["status"] == "stable" for row in report)


def test_feature_that_is_mostly_zero_collapses_to_one_bin(spark):
    reference = column(spark, [0.0] * 95 + [1.0, 2.0, 3.0, 4.0, 5.0])
    current = column(spark, [0.0] * 5 + [9.0] * 95)
    row = psi_table(reference, current).first()
    assert (row["psi"], row["n_bins"]) == (0.0, 1)


def test_report_is_ordered_and_classified(spark):
    rows = [(float(i), float(i % 7), 1.0, "text") for i in range(700)]
    schema = "far double, same double, constant double, label string"
    reference = spark.createDataFrame(rows, schema)
    current = reference.withColumn("far", F.col("far") + 300)
    report = [(row["feature"], row["status"]) for row in drift_report(reference, current).collect()]
    assert report == [("far", "drift"), ("same", "stable"), ("constant", "not_evaluable")]


def test_reference_bins_are_counted_without_another_reading(spark):
    df = spark.range(5000).selectExpr("double(id % 37) AS a", "double(pow(id % 101, 2)) AS b", "double(id) AS c")
    found = drift.reference_bins(df, ["a", "b", "c"])
    for name, (edges, counts) in found.items():
        values = [row[0] for row in df.select(name).collect()]
        upto = [sum(value <= edge for value in values) for edge in edges]
        assert counts == [high - low for low, high in zip([0, *upto], [*upto, len(values)])]


def test_approximate_edges_are_near_the_exact_ones(spark):
    reference = spark.range(20_000).selectExpr("double(id * 7919 % 20011) AS a", "1.0D AS one")
    current = reference.selectExpr("a * 1.2 AS a", "one")
    exact = {row["feature"]: row["psi"] for row in drift.psi_table(reference, current).collect()}
    near = {row["feature"]: row["psi"] for row in drift.psi_table(reference, current, approximate=True).collect()}
    assert near["a"] == pytest.approx(exact["a"], rel=0.1) and near["one"] in (None, 0.0)


@pytest.mark.parametrize("most_sorted", [1, 20])
def test_crowded_buckets_are_split_again(spark, most_sorted):
    rng = random.Random(11)
    columns = {
        "spread": [rng.gauss(0, 1) for _ in range(3000)],
        "hot": [7.0] * 2000 + [7.0 + rng.random() / 1000 for _ in range(900)] + [None] * 100,
        "same": [3.0] * 3000,
        "ends": [-math.inf, math.inf, -0.0, 0.0] * 500 + [float(n) for n in range(1000)],
    }
    schema = ", ".join(f"{name} double" for name in columns)
    df = spark.createDataFrame(list(zip(*columns.values())), schema).repartition(4).cache()
    steps = [0.0, 0.01, 0.25, 0.5, 0.7, 0.9, 1.0]
    found = ValueHistogram(df, list(columns), 4, most_sorted).ranked({name: steps for name in columns})
    plain = ValueHistogram(df, list(columns)).ranked({name: steps for name in columns})
    assert repr(found) == repr(plain)
    for name in ("spread", "hot", "same"):
        values = [value for value in columns[name] if value is not None]
        assert [value for value, _ in found[name]] == pytest.approx(list(np.quantile(values, steps)), abs=1e-12)
        assert [count for _, count in found[name]] == [
            sum(x <= value for x in values) for value, _ in found[name]
        ]
