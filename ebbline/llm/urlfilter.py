"""URL filters: path rules, then a Bloom filter cascade over hosts.

A cascade answers membership exactly for every key of a known universe.  Level 1 encodes the listed keys; the other
keys of the universe that pass it are its false positives, which level 2 encodes; the listed keys that pass level 2
are encoded by level 3, and so on until a level passes nothing wrong.  A key belongs to the list if the first level
that it fails is an even one, or if it fails none and their number is odd.  No join is needed to ask, only the
filters.

Levels hash with seeds of their own, so that keys which collide in one level part in the next.  Keys are dealt into
shards of about ``SHARD_KEYS`` listed keys; filters are built by ``bit_or`` per 64-bit word and come to the driver
shard group by shard group, at most ``GROUP_KEYS`` listed keys or about ``GROUP_KEYS * BITS_PER_KEY / 8`` bytes at
once; a group's filters leave the driver's memory as they are broadcast.  With several groups the asked rows are
written apart by group, and each group is asked by tasks of its own: no task holds the filters of two groups.

Defined results: a null key or one outside the universe may be answered either way, as a Bloom filter does; no
listed keys block nothing; repeated keys count once; an empty table gives no rows; a very long key or url is hashed
whole; further columns are not read.  A null url, or one without ``://``, has an empty host and path.
"""

from __future__ import annotations

import functools
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbline.llm.common import collected, row_struct, stored
from ebbline.sources import scratch_path

SHARD_KEYS = 1_000_000
GROUP_KEYS = 32_000_000
BITS_PER_KEY = 10
HASHES = 7
LEAST_BITS = 64

#: Verdict, host and path of each rule.
RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)\A.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column | str) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, _PARTS, 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column | str) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def rule_for(host: Column, path: Column, rules: list[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as host and path in one, and its verdict; null without."""
    ranked = sorted(rules, key=lambda rule: (-len(rule[1] + rule[2]), rule[1] + rule[2]))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, of, start in reversed(ranked):
        fits = ((host == of) | host.endswith("." + of)) & path.startswith(start)
        rule, verdict = F.when(fits, F.lit(of + start)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def _hashes(key: Column, level: int) -> Column:
    """The hashes of a key on a level, without their sign."""
    return F.array(*[F.xxhash64(key, F.lit(level), F.lit(number)).bitwiseAND(F.lit((1 << 63) - 1)) for number in range(HASHES)])


class Level:
    """The filters of one level, by shard."""

    def __init__(self, sizes: dict[int, int]):
        self.bits = {shard: max(LEAST_BITS, 64 * math.ceil(keys * BITS_PER_KEY / 64)) for shard, keys in sizes.items()}
        self.words = {shard: np.zeros(bits // 64, np.uint64) for shard, bits in self.bits.items()}

    def passes(self, shards: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(shards), bool)
        for shard in np.unique(shards):
            if (bits := self.bits.get(int(shard))) is None:
                continue
            own = shards == shard
            at = hashes[own] % bits
            set_in = (self.words[int(shard)][at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
            out[own] = set_in.all(axis=1)
        return out


def build_level(keys: DataFrame, level: int) -> Level:
    """Filters of ``level`` over the columns ``key`` and ``shard``, built in Spark; the driver gets their words."""
    sizes = {row["shard"]: row["n"] for row in keys.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    out = Level(sizes)
    if not sizes:
        return out
    bits = F.element_at(F.create_map(*[F.lit(x) for pair in out.bits.items() for x in pair]), F.col("shard"))
    at = keys.select("shard", F.explode(_hashes(F.col("key"), level)).alias("hash"))
    at = at.select("shard", F.pmod("hash", bits.cast("long")).alias("at"))
    words = at.groupBy("shard", F.shiftright("at", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, int(at & 63))")).alias("value")
    )
    got = collected(words)
    for shard in out.words:
        own = got["shard"] == shard
        out.words[shard][got["word"][own]] = got["value"][own].view(np.uint64)
    return out


def _asked(shared: Broadcast, levels: int, key: Column, shard: Column, first: int = 1) -> Column:
    """On how many of the broadcast ``levels`` in a row a key passes."""

    def ask(shards: pa.Array, *hashes: pa.Array) -> pa.Array:
        at = shards.to_numpy(zero_copy_only=False)
        going, passed = np.ones(len(at), bool), np.zeros(len(at), np.int32)
        for level, own in zip(shared.value, hashes):
            going &= level.passes(at, own.flatten().to_numpy().reshape(-1, HASHES))
            passed += going
        return pa.array(passed)

    ask.__annotations__ = {"shards": pa.Array, "hashes": pa.Array, "return": pa.Array}
    return F.arrow_udf(ask, "int").asNondeterministic()(shard, *[_hashes(key, first + at) for at in range(levels)])


@dataclass
class Group:
    """A run of shards with the broadcast filters of its levels."""

    shards: range
    levels: int
    filters: Broadcast

    def contains(self, key: Column, shard: Column) -> Column:
        passed = _asked(self.filters, self.levels, key, shard)
        return F.when(passed == self.levels, F.lit(self.levels % 2 == 1)).otherwise(passed % 2 == 1)


class Cascade:
    """Exact membership in the listed keys of a universe (columns ``key`` and ``listed``, each key once)."""

    def __init__(self, universe: DataFrame, shard_keys: int = SHARD_KEYS, group_keys: int = GROUP_KEYS):
        listed = universe.where("listed").count()
        self.shards = max(1, math.ceil(listed / shard_keys))
        self.groups: list[Group] = []
        self.per_group = max(1, group_keys // shard_keys)
        dealt = universe.select("key", "listed", self.shard(F.col("key")).alias("shard"))
        context = universe.sparkSession.sparkContext
        for first in range(0, self.shards, self.per_group):
            shards = range(first, min(first + self.per_group, self.shards))
            mine = dealt.where(F.col("shard").between(shards.start, shards.stop - 1))
            levels = self._levels(mine.where("listed"), mine.where("NOT listed"))
            self.groups.append(Group(shards, len(levels), context.broadcast(levels)))

    def shard(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key, F.lit(-1)), F.lit(self.shards)).cast("int")

    @staticmethod
    def _levels(encode: DataFrame, exclude: DataFrame) -> list[Level]:
        levels: list[Level] = []
        while True:
            levels.append(build_level(encode, len(levels) + 1))
            shared = encode.sparkSession.sparkContext.broadcast(levels[-1:])
            wrong = _asked(shared, 1, F.col("key"), F.col("shard"), len(levels)) == 1
            left = stored(exclude.where(wrong), "passed")
            shared.destroy()
            if left.isEmpty():
                return levels
            encode, exclude = left, encode

    def ask(self, rows: DataFrame, key: Column, name: str) -> DataFrame:
        """``rows`` with a boolean column ``name``: whether ``key`` is listed."""
        if len(self.groups) == 1:
            return rows.select("*", self.groups[0].contains(key, self.shard(key)).alias(name))
        path = scratch_path(rows.sparkSession, "asked")
        asked = row_struct(rows, key.alias("key"), self.shard(key).alias("shard"))
        group = F.floor(F.col("shard") / self.per_group).cast("int")
        asked.withColumn("group", group).write.partitionBy("group").parquet(path)
        parted = rows.sparkSession.read.schema(T.StructType([*asked.schema, T.StructField("group", T.IntegerType())])).parquet(path)
        parts = [
            parted.where(F.col("group") == at).select("row.*", one.contains(F.col("key"), F.col("shard")).alias(name))
            for at, one in enumerate(self.groups)
        ]
        return functools.reduce(DataFrame.unionAll, parts)


def tracking_hosts(pages: DataFrame) -> DataFrame:
    """The key universe, every host of ``pages``, with ``listed`` where at least half of a host's urls carry a query."""
    asks = F.coalesce(F.col("url").contains("?"), F.lit(False)).cast("long")
    hosts = pages.groupBy(host_of("url").alias("key")).agg(F.sum(asks).alias("asking"), F.count(F.lit(1)).alias("n"))
    return hosts.select("key", (F.col("asking") * 2 >= F.col("n")).alias("listed"))


def judge_urls(
    pages: DataFrame, universe: DataFrame, rules: list[tuple[str, str, str]] = RULES, **cascade_sizes: int
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` and ``listed`` of every row: the rule's verdict, else
    block for listed hosts and allow for others."""
    cascade = Cascade(stored(universe, "universe"), **cascade_sizes)
    parts = pages.select("page_id", host_of("url").alias("host"), path_of("url").alias("path"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    said = parts.select("*", rule.alias("rule"), verdict.alias("said"))
    rows = cascade.ask(said, F.col("host"), "listed")
    method = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    return rows.select("page_id", "host", "path", "rule", F.coalesce("said", method).alias("verdict"), "listed")
