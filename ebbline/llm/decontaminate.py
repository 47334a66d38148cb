"""Benchmark decontamination: items found in documents within an edit budget.

Texts are compared in lower case with white space runs as one space.  An item of ``m`` characters may differ from a
passage by ``m // chars_per_edit`` insertions, deletions or replacements.  Cut into one piece more than that, it has a
piece that every such passage holds unchanged (pigeonhole).  One Aho-Corasick automaton finds all pieces of all items
in one reading of a text; each hit fixes where the item would lie, and there Myers' bit-parallel distance decides.

The items are the stated query set: they come to the driver in blocks of at most ``BLOCK_CHARS`` characters, and each
block is broadcast and matched against every document.  Documents are never shuffled.

Defined results: a null or empty text has no match; a null, empty or blank item matches nothing; equal items match
alike, each under its own id (null ids included); repeated rows are judged alike; an item found in several places of a
text is reported once, at its best place (fewest edits, then the first); an empty table on either side gives no rows;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.llm.common import per_text, row_struct, stored

CHARS_PER_EDIT = 12
BLOCK_CHARS = 1_000_000
_MATCH = "array<struct<item:int,edits:int,start:int,end:int>>"
_ARROW = pa.list_(pa.struct([(name, pa.int32()) for name in ("item", "edits", "start", "end")]))


def plain(text: str) -> str:
    return " ".join(text.lower().split())


def pieces(item: str, budget: int) -> Iterator[tuple[int, str]]:
    """``budget + 1`` pieces of nearly equal length, with their places."""
    parts = budget + 1
    cuts = [len(item) * at // parts for at in range(parts + 1)]
    return ((a, item[a:b]) for a, b in zip(cuts, cuts[1:]))


def peq(item: str) -> dict[str, int]:
    """For each character the places, as bits, where the item has it."""
    bits: dict[str, int] = {}
    for at, char in enumerate(item):
        bits[char] = bits.get(char, 0) | 1 << at
    return bits


def best_end(bits: dict[str, int], m: int, text: str, free_start: bool = True) -> tuple[int, int]:
    """Fewest edits between an item and a part of ``text``, and where the first such part ends (Myers 1999).

    Without ``free_start`` the part begins where ``text`` does.
    """
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, end = full, 0, m, m, 0
    for at, char in enumerate(text):
        eq = bits.get(char, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (full & ~(xh | pv))
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        if score < best:
            best, end = score, at + 1
        ph = (ph << 1) & full
        if not free_start:
            ph |= 1
        mh = (mh << 1) & full
        pv = mh | (full & ~(xv | ph))
        mv = ph & xv
    return best, end


class Matcher:
    """The automaton over the pieces of a block of items, and the check of what it finds."""

    def __init__(self, items: list[str], chars_per_edit: int):
        self.items = items
        self.budgets = [len(item) // chars_per_edit for item in items]
        self.bits = [peq(item) for item in items]
        found: dict[str, list[tuple[int, int]]] = {}
        for number, (item, budget) in enumerate(zip(items, self.budgets)):
            if item:
                for place, piece in pieces(item, budget):
                    found.setdefault(piece, []).append((number, place + len(piece) - 1))
        self.automaton = ahocorasick.Automaton()
        for piece, at in found.items():
            self.automaton.add_word(piece, at)
        if found:
            self.automaton.make_automaton()
        self.none = not found

    def matches(self, raw: bytes) -> list[dict]:
        if self.none or not raw:
            return []
        text = plain(raw.decode())
        starts: dict[int, list[int]] = {}
        for end, hits in self.automaton.iter(text):
            for number, back in hits:
                starts.setdefault(number, []).append(end - back)
        found = (self.match(number, text, sorted(set(own))) for number, own in starts.items())
        return sorted((match for match in found if match), key=lambda match: match["item"])

    def match(self, number: int, text: str, starts: list[int]) -> dict | None:
        """The best place among the windows that the hits allow; windows that touch are searched as one."""
        item, budget = self.items[number], self.budgets[number]
        m = len(item)
        best: tuple[int, int] | None = None
        at = 0
        while at < len(starts):
            low = max(0, starts[at] - budget)
            high = starts[at] + m + budget
            while at + 1 < len(starts) and starts[at + 1] - budget <= high:
                at += 1
                high = starts[at] + m + budget
            at += 1
            window = text[low:high]
            exact = window.find(item)
            edits, end = (0, exact + m) if exact >= 0 else best_end(self.bits[number], m, window)
            if edits <= budget and (best is None or edits < best[0]):
                best = edits, low + end
            if edits == 0:
                break
        if best is None:
            return None
        edits, end = best
        back = text[max(0, end - m - budget) : end][::-1]
        length = m if edits == 0 else best_end(peq(item[::-1]), m, back, free_start=False)[1]
        return {"item": number, "edits": edits, "start": end - length, "end": end}


_matchers: dict[int, Matcher] = {}


def _matcher(shared: Broadcast, key: int) -> Matcher:
    """The matcher of a block, built once in a Python worker, which holds one at a time."""
    if key not in _matchers:
        _matchers.clear()
        _matchers[key] = Matcher(*shared.value)
    return _matchers[key]


def item_blocks(benchmark: DataFrame, limit: int = BLOCK_CHARS) -> Iterator[tuple[list, list[str]]]:
    """Ids and plain texts of the items, in blocks of at most ``limit`` characters (one item at least)."""
    ids, texts, size = [], [], 0
    for item_id, text in benchmark.select("item_id", "text").toLocalIterator():
        text = plain(text or "")
        if texts and size + len(text) > limit:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(item_id)
        texts.append(text)
        size += len(text)
    yield ids, texts


def leak_columns(benchmark: DataFrame, text: Column | str, chars_per_edit: int = CHARS_PER_EDIT) -> Iterator[tuple[list, Column]]:
    """For each block of items its ids and a column of the matches of a text, ``item`` being a place in the ids."""
    for ids, texts in item_blocks(benchmark):
        shared = benchmark.sparkSession.sparkContext.broadcast((texts, chars_per_edit))
        key = hash((tuple(texts), chars_per_edit))

        def judge(raw: list[bytes], shared=shared, key=key) -> pa.Array:
            matcher = _matcher(shared, key)
            return pa.array([matcher.matches(text) for text in raw], _ARROW)

        yield ids, per_text(judge, _MATCH)(text)


def leaks(docs: DataFrame, benchmark: DataFrame, chars_per_edit: int = CHARS_PER_EDIT) -> DataFrame:
    """One row per row of ``docs`` and item found in it: ``doc_id``, ``item_id``, ``edits``, and where the passage
    starts and ends in the plain text (characters, end exclusive)."""
    kind = f"array<{benchmark.schema['item_id'].dataType.simpleString()}>"
    places = (F.col("m.start").alias("start_char"), F.col("m.end").alias("end_char"))
    parts = []
    for ids, column in leak_columns(benchmark, "text", chars_per_edit):
        named = F.array(*[F.lit(item_id) for item_id in ids]).cast(kind)
        found = docs.select("doc_id", F.explode(column).alias("m"))
        parts.append(found.select("doc_id", F.get(named, F.col("m.item")).alias("item_id"), "m.edits", *places))
    return reduce(DataFrame.unionByName, parts)


def without_leaks(docs: DataFrame, benchmark: DataFrame, chars_per_edit: int = CHARS_PER_EDIT) -> DataFrame:
    """The rows of ``docs`` in which no item is found, in the columns of ``docs``.

    Each block of items is a pass of its own over what the pass before kept.
    """
    for number, (_, column) in enumerate(leak_columns(benchmark, F.col("text"), chars_per_edit)):
        docs = stored(docs, "clean") if number else docs
        docs = row_struct(docs, column.alias("found")).where("size(found) = 0").select("row.*")
    return docs
