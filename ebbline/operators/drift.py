"""Population stability of numeric features between a reference and a current table."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ebbline.functions.values import psi_status
from ebbline.operators.preprocess import numeric_columns
from ebbline.operators.quantiles import ValueHistogram, clean_double, count_buckets, split_points, with_buckets

# Fixed values.
DEFAULT_BINS = 10
SMALLEST_SHARE = 1e-6
# End of fixed values.

FINER = 64


def reference_bins(
    reference: DataFrame, features: list[str], bins: int = DEFAULT_BINS
) -> dict[str, tuple[list[float], list[int]]]:
    """Inner quantile edges per feature and the reference rows in each bin.

    The rows up to each edge are known from the counts that gave the edge, so the reference is not read again for
    them.  A feature with fewer than two distinct values has no entry.
    """
    histogram = ValueHistogram(reference, features)
    distinct = histogram.distinct_up_to(bins)
    steps = {
        feature: [step / distinct[feature] for step in range(distinct[feature] + 1)]
        for feature in features
        if distinct[feature] >= 2
    }
    found = {}
    for feature, pairs in histogram.ranked(steps).items():
        inner = sorted(dict(pairs).items())[1:-1]
        upto = [0, *[rows for _, rows in inner], histogram.count(feature)]
        found[feature] = [edge for edge, _ in inner], [high - low for low, high in zip(upto, upto[1:])]
    return found


def bin_edges(
    reference: DataFrame, features: list[str], bins: int = DEFAULT_BINS, approximate: bool = False
) -> dict[str, list[float]]:
    """Inner quantile edges per feature.  A feature with fewer than two distinct values has no entry.

    ``approximate`` takes them from mergeable sketches in one reading of the reference, with a rank error below one
    percent.
    """
    if not approximate:
        return {feature: edges for feature, (edges, _) in reference_bins(reference, features, bins).items()}
    values = reference.select([clean_double(name).alias(name) for name in features])
    # A sketch for many more steps than asked for keeps the error small.
    fine = split_points(values, features, FINER * bins)
    steps = {name: [s for s in splits if math.isfinite(s)] for name, splits in fine.items() if splits}
    picked = {
        name: sorted({own[min(len(own) - 1, len(own) * step // bins)] for step in range(1, bins)})
        for name, own in steps.items()
        if len(own) > 1
    }
    return picked


def bin_splits(inner_edges: list[float]) -> list[float]:
    """Splits for bins that are closed on the right and open at both ends.

    Buckets are closed on the left, so each edge moves to the next larger number: ``x > edge`` and
    ``x >= next number`` are the same.
    """
    return [-math.inf, *[math.nextafter(edge, math.inf) for edge in inner_edges], math.inf]


def _bin_counts(df: DataFrame, edges: dict[str, list[float]], side: str) -> DataFrame:
    values = df.select([clean_double(name).alias(name) for name in edges])
    # A feature with one bin needs a split all the same; both halves are counted as bin 0 below.
    splits = {name: bin_splits(inner or [0.0]) for name, inner in edges.items()}
    outputs = {name: f"bin of {name}" for name in edges}
    counted = count_buckets(with_buckets(values, splits, outputs), outputs)
    single = [name for name, inner in edges.items() if not inner]
    number = F.when(F.col("feature").isin(single), F.lit(0)).otherwise(F.col("bucket")) if single else F.col("bucket")
    return counted.select("feature", number.alias("bin"), "entries", F.lit(side).alias("side"))


def psi_table(
    reference: DataFrame,
    current: DataFrame,
    features: list[str] | None = None,
    bins: int = DEFAULT_BINS,
    approximate: bool = False,
) -> DataFrame:
    """``feature, psi, n_bins`` for every numeric feature.

    Exact edges, the default, read the reference three times and count its bins on the way (once more if a feature
    has few distinct values); ``approximate`` edges read it twice. ``psi`` is null when a side is empty or the
    reference has fewer than two distinct values.  A feature whose quantiles fall together has ``n_bins`` 1 and
    always reports 0.0.
    """
    names = numeric_columns(reference) if features is None else features
    exact = {} if approximate else reference_bins(reference, names, bins)
    edges = bin_edges(reference, names, bins, True) if approximate else {name: own for name, (own, _) in exact.items()}
    spark = reference.sparkSession
    spine = spark.createDataFrame(
        [(name, len(edges[name]) + 1 if name in edges else None) for name in names],
        "feature string, n_bins int",
    )
    if not edges:
        return spine.select("feature", F.lit(None).cast("double").alias("psi"), "n_bins")

    # At most bins x features rows from here on.
    if approximate:
        known = _bin_counts(reference, edges, "reference")
    else:
        rows = [(name, at, rows, "reference") for name, (_, counts) in exact.items() for at, rows in enumerate(counts)]
        known = spark.createDataFrame(rows, "feature string, bin int, entries long, side string")
    sides = known.unionByName(_bin_counts(current, edges, "current"))
    by_bin = sides.groupBy("feature", "bin").agg(
        *[
            F.coalesce(F.sum(F.when(F.col("side") == side, F.col("entries"))), F.lit(0)).alias(side)
            for side in ("reference", "current")
        ]
    )
    feature = W.partitionBy("feature")

    def side_share(side: str) -> Column:
        total = F.sum(side).over(feature)
        return F.greatest(F.try_divide(F.col(side).cast("double"), total), F.lit(SMALLEST_SHARE))

    shares = by_bin.select(
        "feature",
        F.when(F.sum("reference").over(feature) > 0, side_share("reference")).alias("r"),
        F.when(F.sum("current").over(feature) > 0, side_share("current")).alias("c"),
    )
    psi = shares.groupBy("feature").agg(F.sum((F.col("c") - F.col("r")) * F.ln(F.col("c") / F.col("r"))).alias("psi"))
    return spine.join(psi, "feature", "left").select("feature", "psi", "n_bins")


def population_stability_index(
    reference: DataFrame, current: DataFrame, feature: str, bins: int = DEFAULT_BINS
) -> float | None:
    return psi_table(reference, current, [feature], bins).first()["psi"]


def drift_report(
    reference: DataFrame,
    current: DataFrame,
    features: list[str] | None = None,
    bins: int = DEFAULT_BINS,
    approximate: bool = False,
) -> DataFrame:
    """PSI with its class, largest first and features that cannot be judged last."""
    table = psi_table(reference, current, features, bins, approximate)
    return table.withColumn("status", psi_status(F.col("psi"))).orderBy(
        F.desc_nulls_last("psi"), "feature"
    )
