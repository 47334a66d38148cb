"""Phrase collocations by SETM relational mining.

A text is cut into pieces at ``. , ; : ! ?`` and line ends, a piece into words at blanks and tabs.  The relation of
length k holds the places of phrases of k words: piece, position and the words, sorted by piece and position.  That of
length k + 1 is its merge-join with itself on equal piece and adjacent position: the rows of a piece lie together and
in order, so the join neither shuffles nor sorts.  Every relation is group-counted, and only phrases that are frequent
stay in it (a semi-join) before the next length is made.  A task makes the relations anew from the texts it reads, a
block at a time: they are larger than the texts, and writing them costs more than making them.

Words are known by a 64-bit hash that depends on the language; the table of words is checked for two words with one
hash, and another seed is taken where that happens, so nothing rests on chance.  Groups are counted by all their words,
in each task first; the counts of phrases are then shuffled as arrays, one for each bucket of hashes, and added bucket
by bucket.  The frequent ones are marked in a bit map of bounded size (``FILTER_BITS``), which is broadcast for the
semi-join, so that places are not shuffled.  It may let rare phrases pass, more of them if the bounded map gets crowded;
that costs time, but no count depends on it.

Counts and scores are exact: products are decimals of 38 digits.

Defined results: a null text has no words, a null ``lang`` is ``und``; a very long piece is cut into overlapping
stretches that lose no phrase; rows that repeat count again; ties in score and frequency go by the bytes of the phrase;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbline.llm.common import blocks, collected, give_back

MIN_COUNT = 10
MAX_WORDS = 3
#: A phrase goes where a longer one that holds it has this share of its places, in hundredths.
ABSORBED = 50
TOP = 2000
#: The bit map of a semi-join has 16 bits a frequent phrase, and at most 2**FILTER_BITS (16 MB).
FILTER_BITS = 27
#: Texts are cut into words in blocks of about this many bytes.
BLOCK_BYTES = 2 << 20
#: Words of a piece that lie in one row.
STRETCH = 512
#: Rows that are joined together.
ROWS_JOINED = 2048
#: Places that a task counts together.
HELD = 500_000
#: Places whose phrases share a bucket, and the bits of the fewest buckets.
BUCKET, LEAST_BITS = 1 << 18, 10
#: Rows that a task hands on together.
ROWS_OUT = 50_000
#: Buckets that a task hands on together.
BUCKETS_OUT = 256

# Classes of bytes: what parts words, what ends a piece, and the rest.
_BLANK, _END, _WORD = range(3)
_CLASS = np.full(256, _WORD, np.uint8)
_CLASS[[0x20, 0x09]] = _BLANK
_CLASS[[*b".,;:!?", *range(0x0A, 0x0E)]] = _END
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Occurrences:
    """The words of texts in order: ``codes`` into ``distinct``, the number of the ``piece`` and the ``position`` in
    it."""

    def __init__(self, texts: list[bytes]):
        data = _LOWER[np.frombuffer(b"\n".join(texts), np.uint8)]
        kind = _CLASS[data]
        inside = np.concatenate([[False], kind == _WORD, [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        offsets = pa.array(np.concatenate([[0], np.cumsum(ends - starts)]), pa.int64())
        letters = pa.py_buffer(np.ascontiguousarray(data[inside[1:-1]]))
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, offsets.buffers()[1], letters]).dictionary_encode()
        self.codes, self.distinct = words.indices.to_numpy(), words.dictionary
        self.piece = np.cumsum(kind == _END)[starts]
        first = np.flatnonzero(np.diff(self.piece, prepend=-1))
        lengths = np.diff(np.append(first, len(starts)))
        self.position = np.arange(len(starts)) - np.repeat(first, lengths)

    def hashes(self, lang: str, salt: int) -> np.ndarray:
        seed = xxhash.xxh64_intdigest(lang.encode(), salt)
        return np.fromiter((xxhash.xxh64_intdigest(word, seed) for word in self.distinct.to_pylist()), np.uint64, len(self.distinct)).view(np.int64)


def by_language(batches) -> Iterator[tuple[str, Occurrences]]:
    for batch, texts in blocks(batches, "text", BLOCK_BYTES):
        langs = batch.column("lang").to_pylist()
        for lang in dict.fromkeys(langs):
            yield lang, Occurrences([text for text, own in zip(texts, langs) if own == lang])


def word_table(texts: DataFrame, salt: int) -> DataFrame:
    """``lang``, ``word``, ``hash`` and ``f``, its occurrences."""

    def words(batches):
        held, size = [], 0
        for lang, found in by_language(batches):
            n = pa.array(np.bincount(found.codes, minlength=len(found.distinct)))
            langs = pa.repeat(pa.scalar(lang), len(n))
            held.append(pa.table([langs, found.distinct.cast(pa.binary()), pa.array(found.hashes(lang, salt)), n], ["lang", "word", "hash", "n"]))
            size += len(n)
            if size > HELD:
                yield from merged(held)
                held, size = [], 0
        if held:
            yield from merged(held)

    def merged(held):
        sums = pa.concat_tables(held).group_by(["lang", "word", "hash"]).aggregate([("n", "sum")])
        yield from sums.rename_columns(["lang", "word", "hash", "n"]).to_batches(max_chunksize=50_000)

    rows = texts.mapInArrow(words, "lang string, word binary, hash long, n long")
    return rows.groupBy("lang", F.col("word").cast("string").alias("word"), "hash").agg(F.sum("n").alias("f"))


def on_disks(table: DataFrame) -> DataFrame:
    """``table``, made once and kept on the executors' disks; what is lost with an executor is made again."""
    return table.persist(StorageLevel.DISK_ONLY)


def words_without_clash(texts: DataFrame) -> tuple[DataFrame, int]:
    """The table of words, and the salt under which no two of them share a hash."""
    for salt in count():
        words = on_disks(word_table(texts, salt))
        if words.groupBy("hash").count().where("count > 1").isEmpty():
            return words, salt
        words.unpersist()


def mixed(words: list[np.ndarray]) -> np.ndarray:
    """A hash of phrases from those of their words."""
    total = words[0].view(np.uint64)
    for word in words[1:]:
        total = (total ^ (total >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + word.view(np.uint64)
        total = (total ^ (total >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return total


class Marks:
    """A broadcast bit map over the leading bits of hashes."""

    def __init__(self, hashes: DataFrame, most_bits: int):
        spark = hashes.sparkSession
        bits = min(most_bits, max(16, (16 * hashes.count()).bit_length()))
        slot = F.shiftrightunsigned("hash", 64 - bits)
        bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(hash, {64 - bits}) & 63 AS int))")
        cells = collected(hashes.groupBy(F.shiftright(slot, 6).alias("cell")).agg(F.bit_or(bit).alias("bits")))
        table = np.zeros(1 << (bits - 6), np.int64)
        table[cells["cell"]] = cells["bits"]
        self.shift, self.table = 64 - bits, spark.sparkContext.broadcast(table)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        slots = (hashes.view(np.uint64) >> np.uint64(self.shift)).astype(np.int64)
        return (self.table.value[slots >> 6] >> (slots & 63) & 1).astype(bool)


def names_of(size: int) -> list[str]:
    return [f"w{at}" for at in range(1, size + 1)]


def batch_of(piece: np.ndarray, until: np.ndarray, row: np.ndarray, positions: np.ndarray, words: list[np.ndarray]) -> pa.RecordBatch:
    """Rows of a relation from places in order; ``row`` is the row of each, and rows without a place are left out."""
    used, first = np.unique(row, return_index=True)
    offsets = pa.array(np.append(first, len(row)), pa.int32())
    lists = [pa.ListArray.from_arrays(offsets, pa.array(values)) for values in (positions.astype(np.int32), *words)]
    return pa.RecordBatch.from_arrays([pa.array(piece[used]), pa.array(until[used], pa.int32()), *lists], ["piece", "until", "positions", *names_of(len(words))])


def word_places(batches, salt: int, frequent: Marks, max_words: int) -> Iterator[pa.RecordBatch]:
    """The relation of length 1: a row per stretch of a piece.  ``until`` ends the positions at which phrases of the row
    count; the words behind it belong to the next row too."""
    beyond, base = max_words - 1, 0
    for lang, found in by_language(batches):
        words = found.hashes(lang, salt)
        kept = frequent.holds(words)[found.codes]
        piece, position, word = found.piece[kept], found.position[kept], words[found.codes[kept]]
        stretch = position // STRETCH
        if len(more := np.flatnonzero((stretch > 0) & (position % STRETCH < beyond))):
            piece, position, word = (np.append(own, own[more]) for own in (piece, position, word))
            stretch = np.append(stretch, stretch[more] - 1)
            order = np.lexsort((position, stretch, piece))
            piece, position, word, stretch = piece[order], position[order], word[order], stretch[order]
        new = np.diff(piece, prepend=-1) != 0
        new |= np.diff(stretch, prepend=-1) != 0
        row = np.cumsum(new) - 1
        alone = np.bincount(row)[row] < 2
        first = np.flatnonzero(new)
        rows = batch_of(base + piece[first], (stretch[first] + 1) * STRETCH, row[~alone], position[~alone], [word[~alone]])
        for at in range(0, len(rows), ROWS_JOINED):
            yield rows.slice(at, ROWS_JOINED)
        base += int(found.piece[-1]) + 1 if len(found.piece) else 0


def places_in(batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Row, position and words of the places of a batch, in order."""
    positions = batch.column("positions")
    row = np.repeat(np.arange(len(batch)), np.diff(positions.offsets.to_numpy()))
    return row, positions.flatten().to_numpy(), [batch.column(name).flatten().to_numpy() for name in names_of(size)]


def extended(batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """The merge-join of the relation of length ``size`` with itself: phrases one word longer."""
    row, position, words = places_in(batch, size)
    at = np.flatnonzero((row[1:] == row[:-1]) & (position[1:] == position[:-1] + 1))
    return row[at], position[at], [*(word[at] for word in words), words[-1][at + 1]]


def owned(batch: pa.RecordBatch, row: np.ndarray, position: np.ndarray, words: list[np.ndarray]) -> list[np.ndarray]:
    """The words of the phrases that count in their row."""
    counted = position < batch.column("until").to_numpy()[row]
    return [word[counted] for word in words]


def in_portions(parts: Iterator[list[np.ndarray]]) -> Iterator[list[np.ndarray]]:
    held, size = [], 0
    for part in parts:
        held.append(part)
        size += len(part[0])
        if size >= HELD:
            yield [np.concatenate(own) for own in zip(*held)]
            held, size = [], 0
    if size:
        yield [np.concatenate(own) for own in zip(*held)]


def longer_places(batches: Iterator[pa.RecordBatch], size: int, marks: Marks, max_words: int) -> Iterator[pa.RecordBatch]:
    """The relation of one word more, without phrases that cannot be frequent."""
    for batch in batches:
        row, position, words = extended(batch, size)
        until = batch.column("until").to_numpy()
        needed = marks.holds(mixed(words)) & (position < until[row] + (max_words - size - 1))
        yield batch_of(batch.column("piece").to_numpy(), until, row[needed], position[needed], [word[needed] for word in words])


def relation(batches, salt: int, marks: list[Marks], max_words: int) -> Iterator[pa.RecordBatch]:
    """The relation of as many words as there are ``marks``, made in the task from its texts."""
    places = word_places(batches, salt, marks[0], max_words)
    for size, own in enumerate(marks[1:], 1):
        places = longer_places(places, size, own, max_words)
    return places


def counted(words: list[np.ndarray], n: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """The distinct phrases in the order of their hashes: hashes, words and sums of ``n``."""
    keys = mixed(words)
    order = np.argsort(keys)
    new, clash = _runs(keys, words, order)
    if clash:
        order = np.lexsort((*words, keys))
        new, _ = _runs(keys, words, order)
    first = np.flatnonzero(new)
    sums = np.add.reduceat(n[order], first) if len(first) else n
    return keys[order[first]], [word[order[first]] for word in words], sums


def _runs(keys: np.ndarray, words: list[np.ndarray], order: np.ndarray) -> tuple[np.ndarray, bool]:
    """Where another phrase begins, and whether two have one hash."""
    new = np.ones(len(order), bool)
    new[1:] = False
    for word in words:
        word = word[order]
        new[1:] |= word[1:] != word[:-1]
    keys = keys[order]
    return new, bool((new[1:] & (keys[1:] == keys[:-1])).any())


def frequent_phrases(texts: DataFrame, salt: int, marks: list[Marks], min_count: int, max_words: int, places: int) -> DataFrame:
    """``w1``, ``w2``, ... and ``f`` of the phrases one word longer than there are ``marks`` that have at least ``min_count``
    places.  ``places``: those of the relation that is extended; it only sets the number of buckets.

    A task counts the places it holds and deals its phrases out by the leading bits of their hashes, an array for each
    bucket; what all tasks have for a bucket is added together.  So a phrase is no row of its own before it is known to
    be frequent, and no hash table of all phrases stands in an executor's heap."""
    size = len(marks)
    names = names_of(size + 1)
    shift = np.uint64(64 - max(LEAST_BITS, (places // BUCKET).bit_length()))

    def tally(batches):
        for words in in_portions(owned(batch, *extended(batch, size)) for batch in relation(batches, salt, marks, max_words)):
            keys, words, n = counted(words, np.ones(len(words[0]), np.int64))
            bucket, first = np.unique(keys >> shift, return_index=True)
            ends = pa.array(8 * np.append(first, len(keys)), pa.int32()).buffers()[1]
            arrays = [pa.Array.from_buffers(pa.binary(), len(first), [None, ends, pa.py_buffer(values)]) for values in (*words, n)]
            rows = pa.RecordBatch.from_arrays([pa.array(bucket.view(np.int64)), *arrays], ["bucket", *names, "n"])
            del keys, words, n, arrays
            for at in range(0, len(rows), BUCKETS_OUT):
                yield rows.slice(at, BUCKETS_OUT)
        give_back()

    def frequent(parts):
        *words, n = (np.concatenate(own) for own in zip(*parts))
        _, words, f = counted(words, n)
        kept = f >= min_count
        rows = pa.RecordBatch.from_arrays([pa.array(values[kept]) for values in (*words, f)], [*names, "f"])
        for at in range(0, len(rows), ROWS_OUT):
            yield rows.slice(at, ROWS_OUT)

    def summed(batches):
        held, current = [], None
        for batch in batches:
            columns = [batch.column(name) for name in (*names, "n")]
            for at, bucket in enumerate(batch.column("bucket").to_pylist()):
                if held and bucket != current:
                    yield from frequent(held)
                    held = []
                current = bucket
                held.append([np.frombuffer(column[at].as_buffer(), np.int64) for column in columns])
        if held:
            yield from frequent(held)
        give_back()

    rows = texts.mapInArrow(tally, "bucket long, " + ", ".join(f"{name} binary" for name in [*names, "n"]))
    dealt = rows.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(summed, ", ".join(f"{name} long" for name in [*names, "f"]))


def phrase_hashes(table: DataFrame, size: int) -> DataFrame:
    names = names_of(size)

    def hashed(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(mixed([batch.column(name).to_numpy() for name in names]).view(np.int64))], ["hash"])

    return table.select(*names).mapInArrow(hashed, "hash long")


def mine(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, absorbed: int = ABSORBED, filter_bits: int = FILTER_BITS) -> DataFrame:
    """All candidates that no longer one absorbs: ``lang``, ``phrase``, ``size``, ``a``, ``l``, ``r``, ``n``, ``score``."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    texts = docs.select(lang.alias("lang"), "text")
    words, salt = words_without_clash(texts)
    frequent = words.where(F.col("f") >= min_count)
    marks = [Marks(frequent.select("hash"), filter_bits)]
    tables = {1: frequent.select(F.col("hash").alias("w1"), "f")}
    for size in range(1, max_words):
        places = tables[size].agg(F.sum("f")).first()[0] or 0
        tables[size + 1] = on_disks(frequent_phrases(texts, salt, marks, min_count, max_words, places))
        if size + 1 < max_words:
            marks = [*marks, Marks(phrase_hashes(tables[size + 1], size + 1), filter_bits)]
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    found = [scored(tables, size, absorbed, frequent) for size in range(2, max_words + 1)]
    return reduce(DataFrame.unionByName, found).join(totals, "lang")


def part_counts(table: DataFrame, first: int, size: int, name: str) -> DataFrame:
    """The counts of phrases of ``size`` words, to be joined at the words from number ``first`` on."""
    columns = [F.col(own).alias(f"w{first + at}") for at, own in enumerate(names_of(size))]
    return table.select(*columns, F.col("f").alias(name))


def scored(tables: dict[int, DataFrame], size: int, absorbed: int, words: DataFrame) -> DataFrame:
    """Candidates of ``size`` words with their lowest cut, without those that a longer one absorbs."""
    rows = tables[size].withColumnRenamed("f", "a")
    names = names_of(size)
    for longer in range(size + 1, max(tables) + 1):
        for first in range(1, longer - size + 2):
            inner = [F.col(f"w{first + at}").alias(name) for at, name in enumerate(names)]
            holders = tables[longer].groupBy(*inner).agg(F.max("f").alias("longest"))
            rows = rows.join(holders, names, "left").where(F.expr(f"longest IS NULL OR 100 * longest < {absorbed} * a")).drop("longest")
    cuts = []
    for k in range(1, size):
        rows = rows.join(part_counts(tables[k], 1, k, f"l{k}"), names[:k]).join(part_counts(tables[size - k], k + 1, size - k, f"r{k}"), names[k:])
        cuts.append(F.struct(exact_score(f"l{k}", f"r{k}").alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
    rows = rows.withColumn("cut", F.least(*cuts) if len(cuts) > 1 else cuts[0])
    # Language and spelling of the words.
    for at, name in enumerate(names):
        more = ["lang"] if at == 0 else []
        rows = rows.join(words.select(F.col("hash").alias(name), F.col("word").alias(f"word_{at}"), *more), name)
    phrase = F.concat_ws(" ", *(F.col(f"word_{at}") for at in range(size)))
    return rows.select("lang", phrase.alias("phrase"), F.lit(size).alias("size"), "a", "cut.l", "cut.r", "cut.score")


def exact_score(left: str, right: str) -> Column:
    """floor(1000000 * a * a / (l * r)): all factors are below 10**15, their products below 10**38."""
    return F.expr(f"(1000000BD * CAST(a AS decimal(15, 0)) * CAST(a AS decimal(15, 0))) div (CAST({left} AS decimal(19, 0)) * CAST({right} AS decimal(19, 0)))").cast("long")


def best(candidates: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` of every language with their ``rank``; tasks keep no more before the shuffle."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = candidates.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.withColumn("rank", F.col("rank").cast("long"))
