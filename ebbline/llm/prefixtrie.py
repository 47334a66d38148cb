"""Prefix trie of conversations by burst tries.

A conversation is a string of turn ids, a turn id being a SHA-256 of role and text.  Equal strings count as one with a
number of conversations.  All strings start in one container under the root.  A container of more than ``LIMIT``
strings bursts: its head becomes a node, and its strings go to containers by their next turn id; strings that end
there stay with the head.  This repeats, a Spark job per level, until every container is small.  The remaining
containers are shards of equal work whatever turns are frequent: each is sorted by its suffixes and swept once, with
the open nodes of the current path as only state, into the nodes below its head.  The heads then get their totals from
what lies below them, deepest level first.

A node is written with the smallest conversation that passes it, its depth, its parent's smallest conversation, the
number of conversations, of children and of leaves below it, the words that sharing it and all below saves, and the
digest of the conversations that end there.

Digests of ending conversations are taken from rows sorted by string and id, which stream through a task with constant
state; only whole strings travel to the containers.  A string's turn ids are one row (16 bytes a turn).

Defined results: turns are ordered by turn (nulls first), role and text; a null role or text is empty; rows that repeat
a turn are turns of their own; rows without ``conv_id`` belong to no conversation and are left out; a conversation of
no turns is a member of the root; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbline.llm.common import stored

#: Strings that a container holds before it bursts.
LIMIT = 4096
NO_ENDS = hashlib.sha256(b"").hexdigest()


def words_in(text: Column) -> Column:
    """The number of words ``[^\\x20\\x09-\\x0D]+``."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def turn_rows(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``place`` (from 1), ``turn_id`` and ``n_words`` of every turn; the texts go no further."""
    blank = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    rows = turns.where("conv_id IS NOT NULL").select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    # The role's length sets role and text apart.
    whole = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return rows.select("conv_id", F.row_number().over(order).cast("long").alias("place"), short_digest(whole).alias("turn_id"), words_in(F.col("text")).alias("n_words"))


def short_digest(of: Column) -> Column:
    return F.substring(F.unhex(F.sha2(of, 256)), 1, 16)


def rebuilt(rows: DataFrame, block: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Turn rows of the conversations in which conversation ``c`` starts with the first ``h = crc32(c) % most`` turns of
    ``c - c % block``, where that has them, and goes on with its own turns behind its first ``h``; and one row per
    conversation with its number of turns."""
    known = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own_turns"))
    skipped = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("long")
    convs = known.select("*", (F.col("conv_id") - F.col("conv_id") % block).alias("base"), skipped.alias("skipped"))
    lenders = known.select(F.col("conv_id").alias("base"), F.col("own_turns").alias("base_turns"))
    lent = F.least("skipped", F.coalesce("base_turns", F.lit(0)))
    convs = convs.join(lenders, "base", "left").select("conv_id", "base", "skipped", "own_turns", lent.alias("lent"))
    own = rows.join(convs, "conv_id").where("place > skipped")
    own = own.select("conv_id", (F.col("place") - F.col("skipped") + F.col("lent")).alias("place"), "turn_id", "n_words")
    first = rows.where(F.col("place") < most).withColumnRenamed("conv_id", "base")
    borrowed = first.join(convs, "base").where("place <= lent").select("conv_id", "place", "turn_id", "n_words")
    turns = F.col("lent") + F.greatest(F.col("own_turns") - F.col("skipped"), F.lit(0))
    return borrowed.unionByName(own), convs.select("conv_id", turns.alias("n_turns"))


_STRING = ["hash_1", "hash_2", "n_turns"]


def distinct_strings(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per distinct string: ``conv_id`` (the smallest), ``n_turns``, ``weight`` (conversations) and
    ``ends_sha256``.  Strings are told apart by 128 bits over places and turn ids, which combine before the shuffle."""
    part = lambda salt: F.bit_xor(F.xxhash64(F.lit(salt), "place", "turn_id"))
    hashes = rows.groupBy("conv_id").agg(part(1).alias("hash_1"), part(2).alias("hash_2"))
    members = stored(convs.join(hashes, "conv_id", "left"), "members")
    zero = lambda name: F.coalesce(F.col(name), F.lit(0)).alias(name)
    members = members.select("conv_id", *map(zero, _STRING))
    groups = members.groupBy(*_STRING).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("weight"))
    ordered = members.repartition(*_STRING).sortWithinPartitions(*_STRING, "conv_id")
    ends = ordered.select(*_STRING, F.col("conv_id").cast("string").alias("name"))
    digests = ends.mapInArrow(_digests, ", ".join(f"{name} long" for name in _STRING) + ", ends_sha256 string")
    return groups.join(digests, _STRING).select("conv_id", "n_turns", "weight", "ends_sha256")


def _digests(batches):
    """SHA-256 of the comma-joined names of each string; only one digest is open."""
    key, state, done = None, None, []
    kinds = [(name, pa.int64()) for name in _STRING] + [("ends_sha256", pa.string())]

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(own, kind) for own, (_, kind) in zip(zip(*done), kinds)], [name for name, _ in kinds])

    for rows in batches:
        for *own, name in zip(*(column.to_pylist() for column in rows.columns)):
            if own != key:
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = own, hashlib.sha256(name.encode())
            else:
                state.update(f",{name}".encode())
        if len(done) >= 10_000:
            yield batch()
            done.clear()
    if key is not None:
        done.append((*key, state.hexdigest()))
        yield batch()


class _Node:
    """An open node of the sweep; ``rows`` are the finished children, which wait for its smallest conversation."""

    __slots__ = ("words", "convs", "least", "children", "leaves", "saved", "ends", "rows")

    def __init__(self, words: int):
        self.words, self.convs, self.least, self.children, self.leaves, self.saved = words, 0, None, 0, 0, 0
        self.ends, self.rows = NO_ENDS, []

    def take(self, convs: int, least):
        self.convs += convs
        if self.least is None or least < self.least:
            self.least = least

    def close(self):
        self.leaves = self.leaves or 1
        self.saved += (self.convs - 1) * self.words

    def adopt(self, child: _Node, row: tuple):
        self.take(child.convs, child.least)
        self.children += 1
        self.leaves += child.leaves
        self.saved += child.saved
        self.rows.append(row)


def swept(strings: Iterator[tuple]) -> Iterator[tuple]:
    """The nodes of containers, whose strings come in order of head and suffix: (conv_id, depth, parent's conv_id, convs,
    children, leaves, saved, ends, head above).  The last is set for the heads alone, which do not know their parent's
    conversation."""
    head, last, path, where = None, [], [], None

    def close_to(size: int):
        while len(path) > size:
            node = path.pop()
            node.close()
            yield from ((*row[:2], node.least, *row[3:]) for row in node.rows)
            row = (node.least, where[0] + len(path), None, node.convs, node.children, node.leaves, node.saved, node.ends)
            if path:
                path[-1].adopt(node, (*row, None))
            else:
                yield (*row, where[1])

    for own, depth, above, head_words, suffix, words, conv_id, weight, ends in strings:
        if own != head:
            yield from close_to(0)
            head, last, where = own, [], (depth, above)
            path.append(_Node(head_words))
        same = 0
        for a, b in zip(last, suffix):
            if a != b:
                break
            same += 1
        yield from close_to(same + 1)
        path += [_Node(count) for count in words[same:]]
        path[-1].take(weight, conv_id)
        path[-1].ends = ends
        last = suffix
    yield from close_to(0)


_COUNTS = ["n_convs", "n_children", "n_leaves", "saved_tokens"]


def _sweep(batches):
    kinds = [pa.int64()] * 7 + [pa.string(), pa.binary()]
    names = ["conv_id", "depth", "parent_conv_id", *_COUNTS, "ends_sha256", "above"]
    strings = (row for batch in batches for row in zip(*(column.to_pylist() for column in batch.columns)))
    held = []

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(own, kind) for own, kind in zip(zip(*held), kinds)], names)

    for node in swept(strings):
        held.append(node)
        if len(held) >= 10_000:
            yield batch()
            held.clear()
    if held:
        yield batch()


_NODE_FIELDS = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, above binary"


def prefix_trie(rows: DataFrame, convs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The nodes of the trie of conversations, given their turn rows and a row (``conv_id``, ``n_turns``) for each, with
    ``conv_id`` long."""
    rows, convs = stored(rows, "turns"), stored(convs, "conversations")
    strings = stored(distinct_strings(rows, convs), "strings")
    rows = stored(rows.join(strings.select("conv_id"), "conv_id", "left_semi"), "string_turns")
    active = strings.select("*", F.lit(b"").alias("head"), F.lit(None).cast("binary").alias("above"), F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("head_words"))
    small: list[DataFrame] = []
    levels: list[DataFrame] = []
    while True:
        sizes = active.where("n_turns > depth").groupBy("head").count()
        crowded = stored(sizes.where(F.col("count") > limit).select("head"), "crowded")
        small.append(active.join(crowded, "head", "left_anti"))
        if crowded.isEmpty():
            break
        bursting = active.join(crowded, "head")
        ended = F.col("n_turns") == F.col("depth")
        when = lambda column: F.when(ended, F.col(column))
        totals = (F.max(when("conv_id")).alias("own_conv"), F.max(when("weight")).alias("own_weight"), F.max(when("ends_sha256")).alias("own_ends"))
        levels.append(bursting.groupBy("head", "above", "depth", "head_words").agg(*totals))
        following = rows.select("conv_id", (F.col("place") - 1).alias("depth"), "turn_id", F.col("n_words").alias("next_words"))
        moved = bursting.where(~ended).join(following, ["conv_id", "depth"])
        next_head = short_digest(F.concat("head", "turn_id")).alias("head")
        moved = moved.select("conv_id", "n_turns", "weight", "ends_sha256", next_head, F.col("head").alias("above"), (F.col("depth") + 1).alias("depth"), F.col("next_words").alias("head_words"))
        active = stored(moved, "burst")
    swept_nodes = stored(containers(small, rows).mapInArrow(_sweep, _NODE_FIELDS), "swept")
    if not levels:
        return swept_nodes.drop("above")
    inner, tops = swept_nodes.where("above IS NULL"), swept_nodes.where("above IS NOT NULL")
    heads: list[DataFrame] = []
    below = None
    for depth in reversed(range(len(levels))):
        children = tops.where(F.col("depth") == depth + 1).drop("ends_sha256", "parent_conv_id")
        if below is not None:
            children = children.unionByName(below.drop("ends_sha256", "head"))
        below = stored(head_nodes(levels[depth], children), "heads")
        heads.append(below)
    known = heads[0]
    for more in heads[1:]:
        known = known.unionByName(more)
    parents = known.select(F.col("head").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    outer = tops.drop("parent_conv_id").unionByName(known.drop("head")).join(parents, "above", "left")
    return inner.drop("above").unionByName(outer.drop("above"))


def containers(small: list[DataFrame], rows: DataFrame) -> DataFrame:
    """The strings of all containers with their suffixes, in order of head and suffix."""
    strings = small[0]
    for more in small[1:]:
        strings = strings.unionByName(more)
    left = rows.join(strings.select("conv_id", "depth"), "conv_id").where("place > depth")
    turn = F.struct("place", "turn_id", "n_words")
    suffixes = left.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    strings = strings.join(suffixes, "conv_id", "left")
    column = lambda name, kind: F.coalesce(F.col(f"turns.{name}"), F.array().cast(f"array<{kind}>")).alias(name)
    strings = strings.select("head", "depth", "above", "head_words", column("turn_id", "binary"), column("n_words", "bigint"), "conv_id", "weight", "ends_sha256")
    return strings.repartition("head").sortWithinPartitions("head", "turn_id")


def head_nodes(level: DataFrame, children: DataFrame) -> DataFrame:
    """The nodes of burst heads from what lies below them."""
    total = lambda name: F.sum(name).alias(name)
    below = children.groupBy(F.col("above").alias("head")).agg(
        F.min("conv_id").alias("conv_id"), total("n_convs"), F.count(F.lit(1)).alias("n_children"), total("n_leaves"), total("saved_tokens")
    )
    n_convs = F.col("n_convs") + F.coalesce("own_weight", F.lit(0))
    return level.join(below, "head").select(
        "head",
        F.least("conv_id", "own_conv").alias("conv_id"),
        "depth",
        n_convs.alias("n_convs"),
        "n_children",
        "n_leaves",
        (F.col("saved_tokens") + (n_convs - 1) * F.col("head_words")).alias("saved_tokens"),
        F.coalesce("own_ends", F.lit(NO_ENDS)).alias("ends_sha256"),
        "above",
    )
