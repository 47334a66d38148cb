import hashlib
import random
import re
import zlib

import pytest

from conftest import SMALL
from ebbline.llm import prefixtrie
from ebbline.llm.common import stored
from ebbline.llm.queries import QUERIES

FIELDS = "conv_id long, turn long, role string, text string, head string, place int, n_turns int, weight string"


def frame(spark, rows):
    return spark.createDataFrame([(*row, "x", 7, 8, "y") for row in rows], FIELDS)


def brute(rows):
    """Nodes of rebuilt conversations by dictionaries of prefixes."""
    by = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            by.setdefault(conv_id, []).append((turn is not None, turn or 0, role or "", text or ""))
    plain = {conv_id: [(role, text) for *_, role, text in sorted(own)] for conv_id, own in by.items()}
    whole = {}
    for conv_id, own in plain.items():
        h = zlib.crc32(str(conv_id).encode()) % 4
        whole[conv_id] = tuple(plain.get(conv_id - conv_id % 20, [])[:h] + own[h:])
    members = {}
    for conv_id, turns in whole.items():
        for depth in range(len(turns) + 1):
            members.setdefault(turns[:depth], []).append(conv_id)
    rows = []
    for key, own in members.items():
        below = [k for k in members if k[: len(key)] == key]
        leaves = [k for k in below if not any(o[:-1] == k for o in members if o)]
        words = lambda k: len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        ends = ",".join(str(c) for c in sorted(c for c in own if whole[c] == key))
        saved = sum((len(members[k]) - 1) * words(k) for k in below)
        parent = min(members[key[:-1]]) if key else None
        children = sum(1 for k in below if len(k) == len(key) + 1)
        rows.append((min(own), len(key), parent, len(own), children, len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=str)


def found(spark, rows, limit):
    own = stored(prefixtrie.turn_rows(frame(spark, rows)), "turns")
    nodes = prefixtrie.prefix_trie(*prefixtrie.rebuilt(own), limit=limit)
    return sorted(map(tuple, nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()), key=str)


ODD = [
    (0, None, "user", "first by null"), (0, 1, None, None), (0, 1, None, None), (0, 2, "user", " \t\n"),
    (1, 0, "user", "first by null"), (None, 0, "user", "nowhere"), (20, 0, "user", ""), (21, 5, "", "x"),
    (40, 0, "ab", "c"), (60, 0, "a", "bc"), (80, 0, "a:", "bc"), (9, 0, "user", "word " * 20_000), (10**12, 3, "user", "far"),
]


@pytest.mark.parametrize("limit", [1, 4096])
def test_odd_conversations(spark, limit):
    assert found(spark, ODD, limit) == brute(ODD)


@pytest.mark.parametrize("limit", [5])
def test_bursting_equals_brute_force(spark, limit):
    rng = random.Random(limit)
    rows = []
    for conv_id in range(0, 130):
        for turn in range(rng.choice([1, 2, 3, 4, 6])):
            rows.append((conv_id, turn, rng.choice(["user", "assistant"]) if turn > 3 else "user", rng.choice(["a", "b c", "a"])))
    rows += [(conv_id, turn, "user", "copy") for conv_id in range(200, 240) for turn in range(5)]
    assert found(spark, rows, limit) == brute(rows)


def test_empty_table(spark):
    assert found(spark, [], 4) == []


def test_limit_changes_nothing(spark):
    rows = stored(prefixtrie.turn_rows(spark.read.parquet(f"{SMALL}/conversations.parquet")), "turns")
    whole = sorted(map(str, QUERIES["op13_prefixtrie"](spark, SMALL).collect()))
    parts = prefixtrie.prefix_trie(*prefixtrie.rebuilt(rows), limit=3)
    assert sorted(map(str, parts.select(*QUERIES["op13_prefixtrie"](spark, SMALL).columns).collect())) == whole


def test_a_long_conversation_and_its_copy(spark):
    rows = [(conv_id, turn, "user", f"t{turn}") for conv_id in (100, 120) for turn in range(3000)]
    rows += [(140, turn, "user", f"t{turn}") for turn in range(2500)]
    nodes = {row[1]: row for row in found(spark, rows, 4096)}
    assert len(nodes) == 3001 and nodes[0][3] == 3 and nodes[2500][3] == 3 and nodes[2501][3] == 2 and nodes[3000][4] == 0
