"""Reproducible stratified split and folds.

Rows of a class are ordered by ``md5(seed:id)``.  A split needs only the key at a few ranks of that order, so
no class is ever sorted: counts per hash prefix find the prefix that holds each wanted rank; as long as that
prefix holds many rows, it is counted again by more digits; the few ids that are left are ranked, and every row is
then compared with the cut keys in a narrow projection.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

PREFIX_DIGITS = 3  # 4,096 prefixes: the counts that reach the driver are bounded by twice that, or that for each cut
HASH_DIGITS = 32
MOST_RANKED = 100_000  # rows of one prefix that are ranked at once
CLASSES = (0, 1)


def hash_key(id_column: str, seed: int) -> Column:
    """The hash of an id; an id that is null has no place in the order and is refused."""
    refused = F.raise_error(F.lit(f"{id_column} must not be null")).cast("string")
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_column).cast("string"), refused)))


def _checked_label(label_column: str) -> Column:
    label = F.col(label_column)
    return F.when(label.isin(*CLASSES), label.cast("int")).otherwise(
        F.raise_error(F.lit(f"{label_column} must be 0 or 1")).cast("int")
    )


@dataclass(frozen=True)
class PrefixGroup:
    """The rows of a class whose hash starts with a prefix, and the wanted places among them with their ranks."""

    label: int
    prefix: str
    rows: int
    places: dict[int, int]


def _narrowed(label: int, counts: dict[str, int], places: dict[int, int]) -> list[PrefixGroup]:
    """The prefixes that hold the wanted places, counted from 1, with the places inside them."""
    prefixes = sorted(counts)
    upto = list(accumulate(counts[prefix] for prefix in prefixes))
    inside: dict[int, dict[int, int]] = {}
    for place, rank in places.items():
        at = bisect_left(upto, place)
        inside.setdefault(at, {})[place - (upto[at - 1] if at else 0)] = rank
    return [PrefixGroup(label, prefixes[at], counts[prefixes[at]], found) for at, found in inside.items()]


class HashOrder:
    """Class sizes and cut keys of the hash order of a frame.

    No task ranks more than ``most_ranked`` ids.  Rows that repeat an id are one row with a count there, and they lie
    on the same side of every cut.
    """

    def __init__(
        self, df: DataFrame, label_column: str, id_column: str, seed: int, most_ranked: int = MOST_RANKED
    ) -> None:
        self.id_column, self.label_column, self.seed = id_column, label_column, seed
        self._most_ranked = most_ranked
        key = hash_key(id_column, seed)
        self._rows = df.select(
            _checked_label(label_column).alias("label"),
            key.alias("hash"),
            F.substring(key, 1, PREFIX_DIGITS).alias("prefix"),
            F.col(id_column).alias("id"),
        )
        self._counts: dict[int, dict[str, int]] = {label: {} for label in CLASSES}
        for row in self._rows.groupBy("label", "prefix").count().collect():
            self._counts[row["label"]][row["prefix"]] = row["count"]

    def class_sizes(self) -> dict[int, int]:
        return {label: sum(counts.values()) for label, counts in self._counts.items()}

    def with_cuts_passed(self, df: DataFrame, cuts: dict[int, list[int]], name: str) -> DataFrame:
        """Add how many of its class's cuts each row lies behind.  A cut at ``k`` lies behind the k-th row."""
        keys = self._cut_keys(cuts)
        key, row_id = F.col("hash of the id"), F.col(self.id_column)
        passed = F.lit(None).cast("int")
        for label, ranks in cuts.items():
            behind = F.lit(0)
            for rank in ranks:
                if rank <= 0:
                    behind = behind + F.lit(1)
                elif (label, rank) in keys:
                    cut_hash, cut_id = keys[label, rank]
                    later = (key > cut_hash) | ((key == cut_hash) & (row_id > F.lit(cut_id)))
                    behind = behind + later.cast("int")
            passed = F.when(F.col(self.label_column) == label, behind).otherwise(passed)
        # A column of its own, so each row is hashed once.
        hashed = df.withColumn("hash of the id", hash_key(self.id_column, self.seed))
        return hashed.withColumn(name, passed).drop("hash of the id")

    def _cut_keys(self, cuts: dict[int, list[int]]) -> dict[tuple[int, int], tuple]:
        """The hash and id at each rank that lies inside its class."""
        sizes = self.class_sizes()
        groups: list[PrefixGroup] = []
        for label, ranks in cuts.items():
            inside = {rank: rank for rank in ranks if 0 < rank < sizes[label]}
            groups += _narrowed(label, self._counts[label], inside)
        done: list[PrefixGroup] = []
        for digits in range(2 * PREFIX_DIGITS, HASH_DIGITS + PREFIX_DIGITS, PREFIX_DIGITS):
            done += [group for group in groups if group.rows <= self._most_ranked]
            crowded = [group for group in groups if group.rows > self._most_ranked]
            if not crowded:
                groups = []
                break
            groups = self._split(crowded, digits)
        return self._ranked(done + groups)

    def _numbered(self, groups: list[PrefixGroup]) -> DataFrame:
        """The rows of the groups, with the number of their group."""
        number = F.lit(None).cast("int")
        for at, group in enumerate(groups):
            belongs = (F.col("label") == group.label) & F.col("hash").startswith(group.prefix)
            number = F.when(belongs, at).otherwise(number)
        return self._rows.withColumn("group", number).where("group IS NOT NULL")

    def _split(self, groups: list[PrefixGroup], digits: int) -> list[PrefixGroup]:
        """The parts of the groups, by more digits, that hold a wanted place."""
        counts: list[dict[str, int]] = [{} for _ in groups]
        longer = F.substring("hash", 1, digits).alias("longer")
        for row in self._numbered(groups).groupBy("group", longer).agg(F.count(F.lit(1)).alias("rows")).collect():
            counts[row["group"]][row["longer"]] = row["rows"]
        return [
            part for group, counted in zip(groups, counts) for part in _narrowed(group.label, counted, group.places)
        ]

    def _ranked(self, groups: list[PrefixGroup]) -> dict[tuple[int, int], tuple]:
        if not groups:
            return {}
        spark = self._rows.sparkSession
        places = [(at, place, rank) for at, group in enumerate(groups) for place, rank in group.places.items()]
        wanted = spark.createDataFrame(places, "group int, place long, rank long")  # a row per cut
        copies = self._numbered(groups).groupBy("group", "label", "hash", "id").agg(F.count(F.lit(1)).alias("copies"))
        upto = F.sum("copies").over(W.partitionBy("group").orderBy("hash", "id"))
        hits = copies.withColumn("upto", upto).join(F.broadcast(wanted), "group")
        found = hits.where("place <= upto AND place > upto - copies").collect()
        return {(row["label"], row["rank"]): (row["hash"], row["id"]) for row in found}


def split_sizes(class_sizes: dict[int, int], test_size: float) -> dict[int, int]:
    """Test rows per class: ``ceil(test_size * n)`` in total, shared by largest remainder of the train part."""
    total = sum(class_sizes.values())
    if not total:
        return dict.fromkeys(class_sizes, 0)
    train_total = total - math.ceil(test_size * total)
    ideal = {label: size / total * train_total for label, size in class_sizes.items()}
    train = {label: math.floor(value) for label, value in ideal.items()}
    by_remainder = sorted(class_sizes, key=lambda label: (train[label] - ideal[label], label))
    for label in by_remainder[: train_total - sum(train.values())]:
        train[label] += 1
    return {label: size - train[label] for label, size in class_sizes.items()}


def stratified_split(
    df: DataFrame,
    label_column: str,
    id_column: str,
    test_size: float = 0.2,
    seed: int = 42,
    most_ranked: int = MOST_RANKED,
) -> DataFrame:
    """Add ``is_test``.  The same seed gives the same rows; class shares are kept."""
    order = HashOrder(df, label_column, id_column, seed, most_ranked)
    cuts = {label: [size] for label, size in split_sizes(order.class_sizes(), test_size).items()}
    return order.with_cuts_passed(df, cuts, "is_test").withColumn("is_test", F.col("is_test") == 0)


def stratified_folds(
    df: DataFrame,
    label_column: str,
    id_column: str,
    folds: int = 3,
    seed: int = 42,
    most_ranked: int = MOST_RANKED,
) -> DataFrame:
    """Add ``fold``, 0 to ``folds - 1``: equal consecutive parts of each class's hash order."""
    order = HashOrder(df, label_column, id_column, seed, most_ranked)
    cuts = {}
    for label, size in order.class_sizes().items():
        sizes = [size // folds + (fold < size % folds) for fold in range(folds)]
        cuts[label] = list(accumulate(sizes))[:-1]
    return order.with_cuts_passed(df, cuts, "fold")
