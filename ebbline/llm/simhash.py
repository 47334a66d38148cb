"""SimHash near-duplicates by segment popcounts.

A text is lower-cased (A-Z) and cut into words (runs other than space and 0x09-0x0D); its shingles are the runs of
``words`` consecutive words, repeats included, joined by a space; a shorter text is one shingle, a text without
words has fingerprint zero.  A bit of the fingerprint is set if it is set in over half of the shingles' XXH64 (seed
42).

Fingerprints that differ in at most ``bits`` bits are linked.  Each distinct fingerprint is mapped to the popcounts
of its 32 segments of two bits.  A flipped bit changes one popcount by one, so the Manhattan distance of popcounts
never exceeds the Hamming distance.  Of the two halves of a linked pair one differs in at most ``bits // 2`` bits;
in the grid of that half's popcounts the two lie within that Manhattan distance, and some grid cell lies within half
of it from both.  Every fingerprint therefore enters the cells around it, cells with two or more are the candidates,
and those are verified exactly.

Only distinct fingerprints enter the grid, so exact copies cost one row.  A cell returns links that connect what is
connected in it, never all its pairs; a crowded cell is cut into chunks and each pair of chunks is a group of its
own.

Defined results: null and empty texts have fingerprint zero and are linked to each other like any others; an id that
occurs in several rows takes part once per row; null ids never become a ``component_id`` unless a component has no
other, then it is null; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.llm.common import per_text, row_struct, stored
from ebbline.llm.graph import components

SEED = 42
WORDS = 4
BITS = 4
#: Fingerprints of a cell that are compared in one group.
CHUNK = 4096
_EVEN = np.uint64(0x55555555)
_HALF = np.uint64(0xFFFFFFFF)


def fingerprints(texts: list[bytes], words: int = WORDS) -> pa.Array:
    """The fingerprints of texts, as signed numbers."""
    out = np.zeros(len(texts), np.uint64)
    hashes: list[np.ndarray] = []
    owners: list[int] = []
    digest = xxhash.xxh64_intdigest
    for at, text in enumerate(texts):
        own = text.lower().split()
        if not own:
            continue
        joined = b" ".join(own)
        ends = np.cumsum([len(word) + 1 for word in own])
        last = (ends - 1)[min(words, len(own)) - 1 :].tolist()
        first = [0, *ends.tolist()][: len(last)]
        hashes.append(np.array([digest(joined[a:b], SEED) for a, b in zip(first, last)], np.uint64))
        owners.append(at)
    if hashes:
        sizes = np.array([len(own) for own in hashes])
        planes = np.unpackbits(np.concatenate(hashes).view(np.uint8), bitorder="little").reshape(-1, 64)
        set_in = np.add.reduceat(planes, np.cumsum(sizes) - sizes, axis=0, dtype=np.int32)
        out[owners] = np.packbits(set_in * 2 > sizes[:, None], axis=1, bitorder="little").view(np.uint64)[:, 0]
    return pa.array(out.view(np.int64))


def fingerprint(text: Column | str, words: int = WORDS) -> Column:
    return per_text(lambda texts: fingerprints(texts, words), "long")(text)


def hex_digits(value: Column | str) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def popcounts(half: np.ndarray) -> np.ndarray:
    """Popcounts of the 16 two-bit segments of a 32-bit half, one in each two-bit field of the result."""
    return (half & _EVEN) + ((half >> np.uint64(1)) & _EVEN)


def cells_around(values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``values`` and the grid cells within Manhattan distance ``radius`` of their popcounts, each once."""
    at, cell = np.arange(len(values)), popcounts(values)
    for _ in range(radius):
        ats, cells = [at], [cell]
        for segment in range(16):
            one = np.uint64(1 << 2 * segment)
            count = (cell >> np.uint64(2 * segment)) & np.uint64(3)
            up, down = count < 2, count > 0
            ats += [at[up], at[down]]
            cells += [cell[up] + one, cell[down] - one]
        at, cell = np.concatenate(ats), np.concatenate(cells)
        both = np.unique((at.astype(np.uint64) << np.uint64(32)) | cell)
        at, cell = (both >> np.uint64(32)).astype(np.int64), both & _HALF
    return at, cell


def spanning_links(values: np.ndarray, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs within ``bits`` bits that connect whatever such pairs connect, fewer than there are values."""
    links = []
    free = np.unique(values)
    while len(free) > 1:
        reach, free = [free[0]], free[1:]
        while reach and len(free):
            centre = reach.pop()
            near = np.bitwise_count(free ^ centre) <= bits
            if near.any():
                hits, free = free[near], free[~near]
                links.append((np.full(len(hits), centre), hits))
                reach += list(hits)
    return links


def link_lists(lists: pa.ListArray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside each list: small lists pairwise, all at once; others by ``spanning_links``."""
    offsets = lists.offsets.to_numpy()
    values = lists.values.to_numpy()[: offsets[-1]].view(np.uint64) if len(lists) else np.zeros(0, np.uint64)
    sizes = np.diff(offsets)
    found = [(np.zeros(0, np.uint64), np.zeros(0, np.uint64))]
    small = sizes <= 16
    owner = np.repeat(np.where(small, np.arange(len(sizes)), -1 - np.arange(len(sizes))), sizes)
    flat = values[offsets[0] :] if len(lists) else values
    for step in range(1, int(sizes[small].max(initial=0))):
        near = (owner[step:] == owner[:-step]) & (owner[step:] >= 0) & (np.bitwise_count(flat[step:] ^ flat[:-step]) <= bits)
        found.append((flat[:-step][near], flat[step:][near]))
    for at in np.flatnonzero(~small):
        found += spanning_links(values[offsets[at] : offsets[at + 1]], bits)
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def links(distinct: DataFrame, bits: int = BITS, chunk: int = CHUNK) -> DataFrame:
    """Links ``a``, ``b`` between the distinct fingerprints in column ``fp`` that connect all near ones."""
    radius = (bits // 2 + 1) // 2

    def enter(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 20_000):
                values = batch.column(0).slice(start, 20_000).to_numpy().view(np.uint64)
                for side, half in enumerate((values & _HALF, values >> np.uint64(32))):
                    at, cell = cells_around(half, radius)
                    key = (cell | np.uint64(side << 32)).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(values[at].view(np.int64))], ["cell", "fp"])

    def verify(batches):
        for batch in batches:
            a, b = link_lists(batch.column(0), bits)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    entered = distinct.select("fp").mapInArrow(enter, "cell long, fp long")
    crowd = entered.groupBy("cell").count().where(F.col("count") > chunk)
    chunks = crowd.select("cell", F.ceil(F.col("count") / chunk).alias("chunks"))
    mine = F.coalesce(F.pmod(F.xxhash64("fp"), F.col("chunks")), F.lit(0))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("chunks", F.lit(1)) - 1))
    grouped = (
        entered.join(chunks, "cell", "left")
        .select("cell", "fp", mine.alias("mine"), other.alias("other"))
        .groupBy("cell", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))
        .agg(F.collect_list("fp").alias("fps"))
    )
    return grouped.where("size(fps) > 1").select("fps").mapInArrow(verify, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = WORDS, bits: int = BITS) -> DataFrame:
    """``doc_id``, ``fp`` (long), ``fp_root`` and ``component_id`` of every row of ``docs``."""
    rows = stored(docs.select(F.col("doc_id"), fingerprint(F.col("text"), words).alias("fp")), "fingerprints")
    classes = component_of_fingerprints(rows, bits)
    return rows.join(classes, "fp").select("doc_id", "fp", "fp_root", "component_id")


def component_of_fingerprints(rows: DataFrame, bits: int = BITS) -> DataFrame:
    """``fp``, ``fp_root`` (equal within a component) and ``component_id`` of each distinct fingerprint."""
    distinct = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct")
    found = components(links(distinct, bits))
    known = distinct.join(found.withColumnRenamed("node", "fp"), "fp")
    lowest = known.groupBy("root").agg(F.min("low").alias("component_id"))
    inside = known.join(lowest, "root").select("fp", F.col("root").alias("fp_root"), "component_id")
    return stored(
        distinct.join(inside, "fp", "left").select(
            "fp",
            F.coalesce("fp_root", "fp").alias("fp_root"),
            F.when(F.col("fp_root").isNull(), F.col("low")).otherwise(F.col("component_id")).alias("component_id"),
        ),
        "components",
    )


def one_of_each(docs: DataFrame, words: int = WORDS, bits: int = BITS) -> DataFrame:
    """The documents with the smallest id of each component, in the columns of ``docs``.

    Of rows that repeat an id, one of each component that the id stands for stays, whatever texts the id names.  Rows
    without an id stay only where their component has no id at all, one of each such component.
    """
    rows = stored(docs.select(F.col("doc_id"), fingerprint(F.col("text"), words).alias("fp")), "fingerprints")
    classes = component_of_fingerprints(rows, bits)
    first = classes.where("component_id IS NOT NULL").select(F.col("component_id").alias("kept_id")).distinct()
    counts = rows.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("again_id")).count()
    again = stored(counts.where("count > 1").select("again_id"), "repeated")
    kept = docs.join(first, docs["doc_id"] == first["kept_id"], "left_semi")
    single = kept.join(again, kept["doc_id"] == again["again_id"], "left_anti")
    # An id on several rows: each row counts for the component of its own text.
    several = kept.join(again, kept["doc_id"] == again["again_id"], "left_semi")
    several = row_struct(several, F.col("doc_id").alias("own_id"), fingerprint(F.col("text"), words).alias("fp"))
    own = several.join(classes, "fp").where("component_id = own_id").dropDuplicates(["own_id", "fp_root"])
    named = single.unionByName(own.select("row.*"))
    bare = row_struct(docs.where("doc_id IS NULL"), fingerprint(F.col("text"), words).alias("fp"))
    alone = bare.join(classes.where("component_id IS NULL"), "fp").dropDuplicates(["fp_root"]).select("row.*")
    return named.unionByName(alone)
