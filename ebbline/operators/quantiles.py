"""Exact quantiles of many numeric columns without sorting them and without one big hash map.

Three passes, none of which shuffles rows: a sketch for split points; a count per split bucket; and, for the
few buckets that hold a wanted rank, a count per value.  Only split points, bucket counts and the wanted values
reach the driver, and their number depends on columns, buckets and ranks, not on rows.  The sketch decides how
evenly work is spread, never the result.  A value held by a third of all rows is combined before it is
exchanged.  A hit bucket with more rows than ``MOST_SORTED`` is split again in the same way, with a bucket of its own
for every value that is a split point, so that no task sorts more values than that; each such level costs the same
three passes, for all columns together, and shrinks the hit buckets some hundred times.
"""

from __future__ import annotations

import math
import sys
from bisect import bisect_right
from itertools import accumulate

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ebbline.functions.values import as_double

DEFAULT_BUCKETS = 512
SKETCH_GROUPS = 128
MOST_SORTED = 1_000_000  # rows of one bucket whose distinct values are sorted in one task


def clean_double(column: str) -> Column:
    """The column as a number, with one zero; null for text that is no number and for NaN."""
    value = as_double(F.col(f"`{column}`"))
    return F.when(~F.isnan(value), value + F.lit(0.0))


def split_points(df: DataFrame, columns: list[str], buckets: int = DEFAULT_BUCKETS) -> dict[str, list[float]]:
    """Bucket borders that spread each column's rows about evenly; an empty list for a column without values.

    Sketches are merged in two steps, so no task has to take one from every input partition.
    """
    grid = F.expr(f"array({', '.join(f'{step / buckets!r}D' for step in range(1, buckets))})")
    size = F.lit(max(2 * buckets, 64))
    partial = df.groupBy((F.spark_partition_id() % SKETCH_GROUPS).alias("sketch_group")).agg(
        *[F.kll_sketch_agg_double(F.col(f"`{name}`"), size).alias(name) for name in columns]
    )
    merged = partial.agg(*[F.kll_merge_agg_double(F.col(f"`{name}`"), size).alias(name) for name in columns])
    filled = [F.kll_sketch_get_n_double(F.col(f"`{name}`")) > 0 for name in columns]
    row = merged.select(
        [
            F.when(is_filled, F.kll_sketch_get_quantile_double(F.col(f"`{name}`"), grid)).alias(name)
            for name, is_filled in zip(columns, filled)
        ]
    ).first()
    splits: dict[str, list[float]] = {}
    for name, found in zip(columns, row):
        inner = sorted({value for value in found or [] if math.isfinite(value)})
        splits[name] = [-math.inf, *(inner or [0.0]), math.inf] if found is not None else []
    return splits


def with_buckets(df: DataFrame, splits: dict[str, list[float]], outputs: dict[str, str]) -> DataFrame:
    """Add per column the number of its bucket, found by binary search; null for null."""
    bucketizer = Bucketizer(
        splitsArray=[splits[name] for name in outputs],
        inputCols=list(outputs),
        outputCols=list(outputs.values()),
        handleInvalid="keep",
    )
    return bucketizer.transform(df)


def count_buckets(bucketed: DataFrame, outputs: dict[str, str]) -> DataFrame:
    """``feature, bucket, entries`` of all bucket columns.  The key is one integer until the final rows."""
    stride = 1 << 20
    keys = [F.lit(at * stride) + F.col(f"`{name}`").cast("int") for at, name in enumerate(outputs.values())]
    counted = (
        bucketed.select(F.explode(F.array(*keys)).alias("key"))
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("entries"))
        .where("key IS NOT NULL")
    )
    names = F.array(*[F.lit(name) for name in outputs])
    feature = F.get(names, F.floor(F.col("key") / stride).cast("int"))
    return counted.select(feature.alias("feature"), (F.col("key") % stride).alias("bucket"), "entries")


class ValueHistogram:
    """Bucket counts of numeric columns, from which exact order statistics are looked up.

    The frame is read once per pass, so pass a stored table rather than a long plan.  With ``own_buckets`` every split
    point has a bucket that holds no other value.
    """

    def __init__(
        self,
        df: DataFrame,
        columns: list[str],
        buckets: int = DEFAULT_BUCKETS,
        most_sorted: int = MOST_SORTED,
        own_buckets: bool = False,
    ) -> None:
        self._buckets, self._most_sorted = buckets, most_sorted
        self.columns = list(columns)
        self._values = df.select([clean_double(column).alias(column) for column in self.columns])
        splits = split_points(self._values, self.columns, buckets)
        if own_buckets:
            splits = {column: _with_own_buckets(points) for column, points in splits.items()}
        self._splits = splits
        self._filled = [column for column in self.columns if splits[column]]
        self._counts: dict[str, dict[int, int]] = {column: {} for column in self.columns}
        if not self._filled:
            return
        self._bucket_of = {column: f"bucket of {column}" for column in self._filled}
        self._bucketed = with_buckets(self._values, splits, self._bucket_of)
        for row in count_buckets(self._bucketed, self._bucket_of).collect():
            self._counts[row["feature"]][row["bucket"]] = row["entries"]

    def count(self, column: str) -> int:
        return sum(self._counts[column].values())

    def distinct_up_to(self, limit: int) -> dict[str, int]:
        """``min(limit, number of distinct values)`` per column.

        Every filled bucket proves one distinct value, so only columns with few filled buckets are counted.
        """
        known = {column: min(limit, len(self._counts[column])) for column in self.columns}
        open_columns = [column for column in self._filled if known[column] < limit]
        if open_columns:
            exact = (
                self._values.unpivot([], open_columns, "feature", "value")
                .where("value IS NOT NULL")
                .groupBy("feature", "value")
                .agg(F.count(F.lit(1)).alias("copies"))
                .groupBy("feature")
                .agg(F.count(F.lit(1)).alias("distinct_values"))
            )
            for row in exact.collect():
                known[row["feature"]] = min(limit, row["distinct_values"])
        return known

    def quantiles(self, probabilities: dict[str, list[float]]) -> dict[str, list[float | None]]:
        """Quantiles with linear interpolation between neighbouring values, None for an empty column."""
        return {column: [value for value, _ in pairs] for column, pairs in self.ranked(probabilities).items()}

    def ranked(self, probabilities: dict[str, list[float]]) -> dict[str, list[tuple[float | None, int]]]:
        """Quantiles, each with the number of values that do not exceed it."""
        wanted = {column: self._positions(column, probabilities[column]) for column in probabilities}
        ranks = {
            column: sorted({rank for low, high, _ in positions for rank in (low, high)})
            for column, positions in wanted.items()
        }
        found = self._order_statistics({column: places for column, places in ranks.items() if places})
        result: dict[str, list[tuple[float | None, int]]] = {}
        for column, positions in wanted.items():
            pairs: list[tuple[float | None, int]] = []
            for low, high, weight in positions:
                (below, upto_below), (above, upto_above) = found[column, low], found[column, high]
                value = below if below == above else below + (above - below) * weight
                pairs.append((value, upto_above if value >= above else upto_below))
            result[column] = pairs or [(None, 0)] * len(probabilities[column])
        return result

    def _positions(self, column: str, probabilities: list[float]) -> list[tuple[int, int, float]]:
        last = self.count(column) - 1
        if last < 0:
            return []
        exact = [probability * last for probability in probabilities]
        return [(math.floor(place), math.ceil(place), place - math.floor(place)) for place in exact]

    def _order_statistics(self, ranks: dict[str, list[int]]) -> dict[tuple[str, int], tuple[float, int]]:
        """The value at each rank and the number of values up to it."""
        targets = []
        for column, places in ranks.items():
            buckets = sorted(self._counts[column])
            upto = list(accumulate(self._counts[column][bucket] for bucket in buckets))
            for rank in places:
                at = bisect_right(upto, rank)
                before = upto[at - 1] if at else 0
                targets.append((column, buckets[at], rank, rank - before, before))
        crowded = sorted({target[:2] for target in targets if self._is_crowded(*target[:2])})
        found = self._split_again(crowded, [target for target in targets if target[:2] in crowded])
        targets = [target for target in targets if target[:2] not in crowded]
        if not targets:
            return found
        spark = self._values.sparkSession
        target_rows = spark.createDataFrame(targets, "feature string, bucket int, rank long, place long, before long")
        entries = []
        for column in sorted({target[0] for target in targets}):
            bucket = F.col(f"`{self._bucket_of[column]}`").cast("int")
            hit = bucket.isin(sorted({at for feature, at, *_ in targets if feature == column}))
            entry = F.struct(
                F.lit(column).alias("feature"), bucket.alias("bucket"), F.col(f"`{column}`").alias("value")
            )
            entries.append(F.when(hit, entry))
        copies = (
            self._bucketed.select(F.explode(F.array(*entries)).alias("entry"))
            .where("entry IS NOT NULL")
            .groupBy("entry.feature", "entry.bucket", "entry.value")
            .agg(F.count(F.lit(1)).alias("copies"))
        )
        upto = F.sum("copies").over(W.partitionBy("feature", "bucket").orderBy("value"))
        spans = copies.withColumn("upto", upto)
        matched = spans.join(F.broadcast(target_rows), ["feature", "bucket"]).where(
            "place < upto AND place >= upto - copies"
        )
        return found | {
            (row["feature"], row["rank"]): (row["value"], row["before"] + row["upto"]) for row in matched.collect()
        }

    def _is_crowded(self, column: str, bucket: int) -> bool:
        """Whether a bucket has too many rows and could hold more than one value."""
        low, high = self._splits[column][bucket : bucket + 2]
        return self._counts[column][bucket] > self._most_sorted and math.nextafter(low, math.inf) < high

    def _split_again(self, crowded: list[tuple[str, int]], targets: list[tuple]) -> dict[tuple[str, int], tuple]:
        """Values and counts for the targets, found in a histogram with a column per crowded bucket."""
        if not crowded:
            return {}
        names = {hit: f"part {at}" for at, hit in enumerate(crowded)}
        parts = [
            F.when(F.col(f"`{self._bucket_of[column]}`") == bucket, F.col(f"`{column}`")).alias(name)
            for (column, bucket), name in names.items()
        ]
        inner = ValueHistogram(
            self._bucketed.select(parts), list(names.values()), self._buckets, self._most_sorted, own_buckets=True
        )
        places: dict[str, list[int]] = {}
        for column, bucket, _, place, _ in targets:
            places.setdefault(names[column, bucket], []).append(place)
        found = inner._order_statistics(places)
        return {
            (column, rank): (value, before + upto)
            for column, bucket, rank, place, before in targets
            for value, upto in [found[names[column, bucket], place]]
        }


def _with_own_buckets(points: list[float]) -> list[float]:
    """Split points, each of them followed by the next larger number, and the ends of the finite numbers."""
    inner = {bound for point in points[1:-1] for bound in (point, math.nextafter(point, math.inf))}
    inner |= {-sys.float_info.max, sys.float_info.max}
    return [points[0], *sorted(bound for bound in inner if math.isfinite(bound)), points[-1]] if points else []


def exact_quantiles(
    df: DataFrame,
    columns: list[str],
    probabilities: list[float],
    buckets: int = DEFAULT_BUCKETS,
    most_sorted: int = MOST_SORTED,
) -> dict[str, list[float | None]]:
    histogram = ValueHistogram(df, columns, buckets, most_sorted)
    return histogram.quantiles({column: probabilities for column in columns})
