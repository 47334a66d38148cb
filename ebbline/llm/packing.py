"""Order-preserving packing by dynamic programming.

Documents become token ids, each followed by an end id, and form one stream in the order in which a partition holds
them.  The stream is cut into sequences of at most ``length`` ids.  Cuts are allowed at document ends, at sentence
ends, ``length`` ids behind either of these, and every ``length`` ids inside a run without any.  A cut costs nothing at
a document end, ``SENTENCE`` at a sentence end and ``INSIDE`` elsewhere; a sequence costs its padding, none where its
size is a power of two, and ``EACH`` so that short sequences do not pay off by themselves.  The cheapest cuts follow
from

    f(j) = cut(j) + EACH + min( min over j - length <= i < j of f(i) + length - (j - i),  min over powers p of f(j - p) )

whose inner minimum is a sliding one over f(i) + i, kept by a monotone queue: linear time.

The stream is solved in runs of documents of about ``BLOCK_BYTES`` of text, which bounds a task's memory; the run's
end is a document's end, so only its last sequence can be short.  Nothing is shuffled.

Defined results: a null or empty text is the end id alone; repeated rows are packed again; null ids stay null; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.llm.common import blocks
from ebbline.llm.token_ids import Encoder, encoder_of

__all__ = ["Encoder", "best_cuts", "cut_places", "pack"]

LENGTH = 1024
END_ID = 0
SENTENCE = 1
INSIDE = 6
EACH = 8
#: A full sequence's length divided by the smallest power of two that is sought as a sequence's size; beyond any length,
#: so that every power is.
FEWEST = 1 << 62


def cut_places(doc_ends: np.ndarray, sentence_ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Allowed cuts in order, the start included, and what each costs."""
    total = int(doc_ends[-1])
    price = np.full(total + 1, INSIDE, np.int64)
    price[sentence_ends] = SENTENCE
    price[doc_ends] = 0
    allowed = price < INSIDE
    allowed[0] = True
    natural = np.flatnonzero(allowed)
    gaps = np.diff(natural)
    wide = np.flatnonzero(gaps > length)
    forced = [natural[at] + length * np.arange(1, gaps[at] // length + 1) for at in wide]
    behind = np.concatenate([natural + length, *forced])
    allowed[behind[behind <= total]] = True
    places = np.flatnonzero(allowed)
    return places, price[places]


def exact_steps(places: np.ndarray, powers: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of places whose distance is one of the powers, as numbers of the later and the earlier place, in order
    of the later one."""
    known = np.full(int(places[-1]) + 1, -1, np.int32)
    known[places] = np.arange(len(places), dtype=np.int32)
    later, earlier = [], []
    for power in powers:
        skipped = int(np.searchsorted(places, power))
        before = known[places[skipped:] - power]
        hit = np.flatnonzero(before >= 0)
        later.append(hit + skipped)
        earlier.append(before[hit])
    order = np.argsort(both := np.concatenate(later), kind="stable")
    return both[order], np.concatenate(earlier)[order]


def best_cuts(places: np.ndarray, cost: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """The cuts of least total cost, the last place included."""
    n = len(places)
    powers = [1 << bit for bit in range(length.bit_length()) if length // FEWEST <= 1 << bit <= length]
    later, earlier = exact_steps(places, powers)
    later, earlier = [*later.tolist(), n], earlier.tolist()
    at = places.tolist()
    best, key, came = [0] * n, [0] * n, [0] * n
    queue, head, step = [0], 0, 0
    following, reach = later[0], at[0] + length
    for j, (place, price) in enumerate(zip(at, (cost + EACH).tolist())):
        if not j:
            continue
        while reach < place:
            head += 1
            reach = at[queue[head]] + length
        i = queue[head]
        least = key[i] + length - place
        while following == j:
            other = earlier[step]
            if best[other] < least:
                i = other
                least = best[i]
            step += 1
            following = later[step]
        least += price
        best[j] = least
        came[j] = i
        key[j] = own = least + place
        while key[queue[-1]] >= own:
            queue.pop()
            if len(queue) == head:
                reach = place + length
                break
        queue.append(j)
    cuts = []
    j = n - 1
    while j:
        cuts.append(at[j])
        j = came[j]
    return np.array(cuts[::-1], np.int64)


PIECES = "doc_row long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, tokenizer_path: str, pattern: str, length: int = LENGTH) -> DataFrame:
    """One row per piece of a document in a sequence: ``doc_id``, ``start`` and ``length`` among the document's ids,
    their CRC-32, ``doc_tokens``, ``sequence_id``, ``offset`` in the sequence, and the ids themselves as ``ids``."""

    def solve(batches):
        encoder = encoder_of(tokenizer_path, pattern)
        sequence = TaskContext.get().partitionId() << 33
        for batch, raw in blocks(batches, "text"):
            ids, totals, stops = encoder.encode_utf8(raw, END_ID)
            doc_ends = np.cumsum(totals)
            cuts = best_cuts(*cut_places(doc_ends, stops, length), length)
            ends = np.union1d(doc_ends, cuts)
            begins = np.concatenate([[0], ends[:-1]])
            doc = np.searchsorted(doc_ends, begins, side="right")
            window = np.searchsorted(cuts, begins, side="right")
            first = np.concatenate([[0], cuts])[window]
            little = ids.astype("<u4", copy=False)
            view = memoryview(little).cast("B")
            crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(doc)),
                    pa.array(begins - (doc_ends - totals)[doc]),
                    pa.array(ends - begins),
                    pa.array(crc, pa.int64()),
                    pa.array(totals[doc]),
                    pa.array(sequence + window),
                    pa.array(begins - first),
                    pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids.astype(np.int32))),
                ],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"],
            )
            sequence += len(cuts)
        encoder.trim()

    kind = docs.schema["doc_id"].dataType.simpleString()
    fields = PIECES.replace("doc_row long", f"doc_id {kind}") + ", ids array<int>"
    return docs.select(F.col("doc_id"), F.col("text")).mapInArrow(solve, fields)
