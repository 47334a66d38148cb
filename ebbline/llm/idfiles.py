"""Token ids in compressed binary files: an adaptive context-mixing range coder.

A file is a row of *segments*, each a run of whole documents in ascending order.  A segment has a head (its place, its
documents and their numbers of ids, and its distinct ids by falling frequency, which gives every id a rank) and
*blocks* of ``BLOCK`` ids.  Blocks start from the same state, end their code and carry a CRC-32 of their ids, so each
can be decoded alone.

Three models predict the next id of a block.  Order 2 and order 1 remember which id last followed the two ids or the
one id before (hashed, replaced when it keeps failing) and how often it was right.  Order 0 spreads the rest over
classes of ranks, [4, 8), [8, 16), ... of rank + 4, all ids of a class alike.  The three are mixed with weights that
adapt for each state of confidence: the share given to the order-2 id, the order-1 id and each class of order 0 is an
adaptive cumulative table, chosen by how sure both orders are and whether they agree.  A 64-bit range coder with carries
writes the choice and, for order 0, the place in its class.  All of it is integer arithmetic.

The state of a block depends on the ids before it, but blocks do not depend on each other: the coder steps through all
blocks of a segment at once, an array entry per block.

Files are written by Spark's text sink, one or more per task, so that they can go to any file system and a lost task
leaves nothing half written; ``FILLER`` follows each segment.  Their order is that of the numbers in the heads.

Defined results: rows are ordered by ``doc_id`` (nulls first), then by a hash of the text and the text, which also
spreads rows that share an id; a null or empty text, and a very long one, are documents like any other; repeated rows
are documents each; an empty table writes no segment and gives no rows; other columns are not read.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbline.llm.common import blocks, give_back
from ebbline.llm.token_ids import encoder_of

END_ID = 2
#: Ids of a block.
BLOCK = 4096
#: About the number of ids of a segment, of whole documents.  What is left at the end of a task makes one segment of up to
#: one and a half times as many or two equal ones, as a segment of few blocks takes almost the time of a large one.
SEGMENT_IDS = 1536 * BLOCK
SEGMENTS_PER_FILE = 4
#: Steps of all blocks that are prepared, modelled and coded at a time.
STEPS = 32
TABLE_BITS = 9

# Fixed values of the format.
MAGIC = b"IDS1"
FILLER = "IDS-"
#: Magic, version of the model, part, segment, documents, ids, length of all codes, length and CRC-32 of what follows in
#: the head.
HEAD = struct.Struct("<4sIqqqqqqI")
VERSION = 2
_A, _B = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77)
_HASH_SHIFT = np.uint32(32 - TABLE_BITS)
_STEPS = np.arange(16, dtype=np.int16)
_TOTAL = 1 << 15
_RATE = 5
#: For each choice, what the entries of a cumulative table move to: all but one count for each other choice.
_TARGETS = (np.where(_STEPS[None, :] > _STEPS[:, None], _TOTAL - 16, 0) + _STEPS).astype(np.int16)
#: Entries of the id tables are id << 2 | confidence; this one holds no id and no confidence.
_NONE = -4
_LOW, _TOTAL_BITS = np.uint64(32), np.uint64(15)
_SMALL = np.uint64(1 << 32)


class BadFile(ValueError):
    """A file that does not hold what the format promises."""


class Lanes:
    """The model's state for several blocks, one array entry each.  What order 2 and order 1 hold lies in one table, order
    2 first, so that both are looked up and kept by the same array operations."""

    def __init__(self, lanes: int):
        table = 1 << TABLE_BITS
        self.entries = np.full(2 * lanes * table, _NONE, np.int32)
        self.base = np.arange(2 * lanes).reshape(2, lanes) * table
        self.tables = np.tile(_STEPS * (_TOTAL // 16), (lanes * 32, 1))
        self.whole_rows = self.tables.view("V32").ravel()
        self.contexts = np.arange(lanes) * 32
        self.flat = np.arange(lanes) * 16
        #: The rows in use, one behind another, and a 0 behind the last.
        self.rows = np.zeros(lanes * 16 + 1, np.int16)

    def keep(self, lanes: int):
        """Leave out the lanes from ``lanes`` on, whose blocks have ended."""
        if lanes < len(self.flat):
            self.base, self.contexts, self.flat = self.base[:, :lanes], self.contexts[:lanes], self.flat[:lanes]
            self.rows = np.zeros(lanes * 16 + 1, np.int16)

    def slots(self, last: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Where order 2 and order 1 look, by the last id and the one before, for one step or many."""
        at = np.empty((*last.shape[:-1], 2, last.shape[-1]), np.int64)
        own = last * _A
        at[..., 1, :] = own >> _HASH_SHIFT
        own ^= before * _B
        own >>= _HASH_SHIFT
        at[..., 0, :] = own
        at += self.base
        return at

    def predict(self, at: np.ndarray) -> np.ndarray:
        """The ids that order 2 and order 1 expect; the tables of the choice are in ``rows``."""
        self.at, self.entry = at, self.entries.take(at)
        self.sure = self.entry & 3
        expected = self.entry >> 2
        state = self.sure[0] << 2
        state += self.sure[1]
        state <<= 1
        state += expected[0] == expected[1]
        self.state = self.contexts + state
        self.tables.take(self.state, axis=0, out=self.rows[:-1].reshape(-1, 16), mode="clip")
        return expected

    def bounds(self, choice: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and width of each lane's choice among 32,768.  Every table starts with 0, which modulo 32,768 is also
        the end of the one before."""
        at = self.flat + choice
        start = self.rows.take(at)
        at += 1
        width = self.rows.take(at)
        width -= start
        width &= _TOTAL - 1
        return start, width

    def learn(self, fresh: np.ndarray, choice: np.ndarray, hit: np.ndarray):
        """``fresh`` are the entries of the ids that came."""
        rows = self.rows[:-1].reshape(-1, 16)
        move = _TARGETS.take(choice, axis=0, mode="clip")
        move -= rows
        move >>= _RATE
        move += rows
        self.whole_rows[self.state] = move.view("V32").ravel()
        # A hit adds confidence up to 3; a miss takes one away, or the id's place where there is little.
        missed = np.where(self.sure > 1, self.entry - 1, fresh)
        self.entries[self.at] = np.where(hit, self.entry + (self.sure < 3), missed)


#: Bits of the place in the class of each choice.
_PLACE_BITS = np.array([0, 0, *range(2, 16)], np.uint64)
_PLACES = np.uint64(1) << _PLACE_BITS


def classes_to(rank: int) -> np.ndarray:
    """For ranks up to ``rank``, the number of places in a rank's class, as a power of two, which is also the choice
    that stands for it."""
    return np.frexp(np.arange(4, rank + 5).astype(np.float32))[1].astype(np.int64) - 1


def spans(count: int) -> Iterator[tuple[int, int, int]]:
    """Runs of steps and how many blocks have ids in them; only the last block can be shorter."""
    lanes = -(-count // BLOCK)
    short = count - (lanes - 1) * BLOCK
    for first, last, own in ((0, short, lanes), (short, BLOCK, lanes - 1)):
        for begin in range(first, last if own else first, STEPS):
            yield begin, min(begin + STEPS, last), own


#: Rows of a grid lie so many places apart: a power of two would put a column into few sets of the processor's cache.
_PITCH = BLOCK + 16


def grid_of(lanes: int, ranks: np.ndarray | None = None) -> np.ndarray:
    """A row for each block, with the segment's ids."""
    grid = np.zeros((lanes, _PITCH), np.int32)[:, :BLOCK]
    if ranks is not None:
        full = len(ranks) // BLOCK
        grid[:full] = ranks[: full * BLOCK].reshape(full, BLOCK)
        grid[full:, : len(ranks) - full * BLOCK] = ranks[full * BLOCK :]
    return grid


class Words:
    """The words of 32 bits that each lane's code consists of."""

    def __init__(self, lanes: int, most: int):
        self.most, self.used = most, np.zeros(lanes, np.int64)
        self.flat = np.zeros(lanes * most, np.uint32)
        self.first = np.arange(lanes) * most

    def add(self, lows: np.ndarray, settled: np.ndarray, carried: np.ndarray):
        """For each step and lane: the interval's start, of which the upper half is a word where ``settled``, and
        whether that start had run over 64 bits, which adds one to the lane's word before."""
        steps, lanes = settled.shape
        # Lane by lane, so that a lane's words follow one another.
        words = np.flatnonzero(np.ascontiguousarray(settled.T))
        bounds = np.searchsorted(words, np.arange(lanes + 1) * steps)
        many = np.diff(bounds)
        shift = self.first[:lanes] + self.used[:lanes] - bounds[:-1]
        lane = np.repeat(np.arange(lanes), many)
        self.flat[shift[lane] + np.arange(len(words))] = lows[words - lane * steps, lane] >> _LOW
        step, lane = np.nonzero(carried)
        self.carry(shift[lane] + np.searchsorted(words, lane * steps + step) - 1)
        self.used[:lanes] += many

    def carry(self, at: np.ndarray):
        while len(at):
            np.add.at(self.flat, at, np.uint32(1))
            at = at[self.flat[at] == 0] - 1

    def close(self, low: np.ndarray) -> list[bytes]:
        """Each lane's code, with one last word that lies in the interval if zeros follow it."""
        last = low + (_SMALL - np.uint64(1))
        at = self.first + self.used
        self.carry(at[last < low] - 1)
        self.flat[at] = last >> _LOW
        little = self.flat.astype("<u4", copy=False)
        return [little[begin : end + 1].tobytes() for begin, end in zip(self.first.tolist(), at.tolist())]


def encode_blocks(ranks: np.ndarray, extra: int) -> list[bytes]:
    """The code of each block.  The lowest ``extra`` bits of a rank are written as they are.

    Runs of steps are coded at a time: what follows from the ids alone is found for the whole run, then the model goes
    through it, then the coder."""
    steps, lanes = min(len(ranks), BLOCK), -(-len(ranks) // BLOCK)
    grid = grid_of(lanes, ranks)
    every = 1 + bool(extra)
    low, width = np.zeros(lanes, np.uint64), np.full(lanes, (1 << 64) - 1, np.uint64)
    words = Words(lanes, steps * every + 1)
    state = Lanes(lanes)
    class_of = classes_to(int(ranks.max()) >> extra)
    place_of = (np.arange(4, len(class_of) + 4) - (1 << class_of)).astype(np.uint64)
    ids = np.zeros((2, lanes), np.int32)
    for begin, end, active in spans(len(ranks)):
        state.keep(active)
        size = end - begin
        # The run's ids, with the two before them in front.
        ids = np.concatenate([ids[-2:, :active], grid[:active, begin:end].T])
        high = ids[2:] >> extra
        choices = class_of.take(high)
        fresh = ids[2:] << 2 | 1
        own_low, own_width = low[:active], width[:active]
        slots = state.slots(ids[1:-1].view(np.uint32), ids[:-2].view(np.uint32))
        starts, shares = np.empty((2, size, active), np.uint64)
        for step in range(size):
            hit = state.predict(slots[step]) == ids[step + 2]
            choice = choices[step]
            np.copyto(choice, 1, where=hit[1])
            np.copyto(choice, 0, where=hit[0])
            starts[step], shares[step] = state.bounds(choice)
            state.learn(fresh[step], choice, hit)
        spread = choices > 1
        bits = _PLACE_BITS.take(choices)
        places = place_of.take(high) * spread
        if extra:
            rests = (ids[2:] & ((1 << extra) - 1)).astype(np.uint64) * spread
            rest_bits = spread * np.uint64(extra)
        lows = np.empty((size * every, active), np.uint64)
        settled, carried = np.empty((2, size * every, active), bool)

        def narrow(row, add, part):
            """Move to the chosen part of each lane's interval; a word is settled where that part is small."""
            np.add(own_low, add, out=own_low)
            np.less(own_low, add, out=carried[row])
            np.less(part, _SMALL, out=settled[row])
            lows[row] = own_low
            shift = settled[row] * _LOW
            np.left_shift(own_low, shift, out=own_low)
            np.left_shift(part, shift, out=own_width)

        for step in range(size):
            unit = own_width >> _TOTAL_BITS
            part = unit * shares[step]
            part >>= bits[step]
            unit *= starts[step]
            unit += part * places[step]
            narrow(step * every, unit, part)
            if extra:
                part = own_width >> rest_bits[step]
                narrow(step * every + 1, part * rests[step], part)
        words.add(lows, settled, carried)
    return words.close(low)


def decode_blocks(codes: list[bytes], count: int, extra: int) -> np.ndarray:
    """The ranks that ``encode_blocks`` was given."""
    lanes = len(codes)
    # A lane's decoder reads a word more than was written, which must be 0.
    words = np.frombuffer(b"".join(code + bytes(8) for code in codes), "<u4")
    sizes = np.fromiter(map(len, codes), np.int64, lanes) // 4 + 2
    at = np.cumsum(sizes) - sizes
    inside, width = words[at] << _LOW | words[at + 1], np.full(lanes, (1 << 64) - 1, np.uint64)
    at += 2
    grid = grid_of(lanes)
    found_ids = np.empty((STEPS, lanes), np.int32)
    state = Lanes(lanes)
    last = before = np.zeros(lanes, np.uint32)

    def refill(own, size, part, at):
        """Take the next word where the part is small."""
        small = part < _SMALL
        shift = small * _LOW
        np.left_shift(part, shift, out=size)
        np.left_shift(own, shift, out=own)
        np.bitwise_or(own, words.take(at, mode="clip") * small, out=own)
        np.add(at, small, out=at)

    for begin, end, active in spans(count):
        state.keep(active)
        own, size, own_at = inside[:active], width[:active], at[:active]
        last, before = last[:active], before[:active]
        for step in range(begin, end):
            expected = state.predict(state.slots(last, before))
            unit = size >> _TOTAL_BITS
            found = np.minimum(own // unit, np.uint64(_TOTAL - 1)).astype(np.int16)
            below = np.bitwise_count((state.rows[:-1].reshape(-1, 16) <= found[:, None]).view(np.uint64))
            choice = np.add(below[:, 0], below[:, 1], dtype=np.int64)
            choice -= 1
            start, share = state.bounds(choice)
            many = _PLACES.take(choice)
            part = unit * share.astype(np.uint64)
            part >>= _PLACE_BITS.take(choice)
            unit *= start.astype(np.uint64)
            own -= unit
            place = np.minimum(own // part, many - np.uint64(1))
            own -= part * place
            refill(own, size, part, own_at)
            place += many
            ids = place.astype(np.int32)
            ids -= 4
            if extra:
                rest_bits = (choice > 1) * np.uint64(extra)
                part = size >> rest_bits
                rest = np.minimum(own // part, (np.uint64(1) << rest_bits) - np.uint64(1))
                own -= part * rest
                refill(own, size, part, own_at)
                ids = ids << extra | rest.astype(np.int32)
            ids = np.where(choice == 0, expected[0], np.where(choice == 1, expected[1], ids))
            found_ids[step - begin, :active] = ids
            # An order-2 id that is also the order-1 id counts as a hit of both, as in the encoder.
            state.learn(ids << 2 | 1, choice, expected == ids)
            last, before = ids.view(np.uint32), last
        grid[:active, begin:end] = found_ids[: end - begin, :active].T
    return grid.ravel()[:count]


def segment_bytes(part: int, number: int, doc_ids: list[str | None], totals: np.ndarray, ids: np.ndarray) -> bytes:
    """A segment of whole documents: their ids one after another."""
    counts = sum(np.bincount(own, minlength=int(ids.max()) + 1) for own in np.array_split(ids, len(ids) // SEGMENT_IDS * 8 + 8))
    alphabet = np.flatnonzero(counts)
    alphabet = alphabet[np.argsort(-counts[alphabet], kind="stable")]
    rank_of = np.zeros(len(counts), np.int32)
    rank_of[alphabet] = np.arange(len(alphabet), dtype=np.int32)
    extra = max(0, (len(alphabet) + 3).bit_length() - 16)
    codes = encode_blocks(rank_of[ids], extra)
    little = ids.astype("<u4", copy=False)
    sums = [zlib.crc32(little[at : at + BLOCK]) for at in range(0, len(ids), BLOCK)]
    parts = [json.dumps(doc_ids).encode(), totals.astype("<i8").tobytes(), alphabet.astype("<u4").tobytes()]
    parts += [packed32(map(len, codes)), packed32(sums)]
    body = zlib.compress(b"".join(struct.pack("<q", len(own)) + own for own in parts), 1)
    fields = (MAGIC, VERSION, part, number, len(doc_ids), len(ids), sum(map(len, codes)), len(body))
    check = zlib.crc32(body, zlib.crc32(HEAD.pack(*fields, 0)))
    return b"".join([HEAD.pack(*fields, check), body, *codes])


def packed32(values) -> bytes:
    return np.fromiter(values, "<u4").tobytes()


class Segment:
    """A segment in ``content`` at ``at``; the head is checked at once, and read with the ids by ``ids``."""

    def __init__(self, content: memoryview, at: int):
        if len(content) < at + HEAD.size:
            raise BadFile("a head is cut off")
        magic, version, self.part, self.number, self.documents, self.count, self.coded, self.size, check = fields = HEAD.unpack_from(content, at)
        if magic != MAGIC or version != VERSION:
            raise BadFile("not a segment of this version")
        if min(self.size, self.coded) < 0:
            raise BadFile("a length below 0")
        self.content, self.begin = content, at + HEAD.size
        self.end = self.begin + self.size + self.coded
        if self.end > len(content):
            raise BadFile("a segment is cut off")
        self.body = content[self.begin : self.begin + self.size]
        if zlib.crc32(self.body, zlib.crc32(HEAD.pack(*fields[:-1], 0))) != check:
            raise BadFile("the head does not fit its checksum")

    def read(self):
        raw, parts = memoryview(zlib.decompress(self.body)), []
        while raw:
            (length,) = struct.unpack_from("<q", raw)
            parts.append(raw[8 : 8 + length])
            raw = raw[8 + length :]
        self.doc_ids = json.loads(bytes(parts[0]))
        self.totals = np.frombuffer(parts[1], "<i8")
        self.alphabet = np.frombuffer(parts[2], "<u4")
        sizes, self.sums = np.frombuffer(parts[3], "<u4"), np.frombuffer(parts[4], "<u4")
        ends = self.begin + self.size + np.cumsum(sizes, dtype=np.int64)
        if len(self.totals) != self.documents or len(self.doc_ids) != self.documents or int(self.totals.sum()) != self.count:
            raise BadFile("documents and ids do not agree in number")
        if int(sizes.sum(dtype=np.int64)) != self.coded:
            raise BadFile("the blocks do not fill the segment")
        self.codes = [bytes(self.content[a:b]) for a, b in zip([self.begin + self.size, *ends.tolist()], ends.tolist())]

    def ids(self) -> np.ndarray:
        self.read()
        extra = max(0, (len(self.alphabet) + 3).bit_length() - 16)
        with np.errstate(all="ignore"):
            ranks = decode_blocks(self.codes, self.count, extra)
        if ranks.min() < 0 or ranks.max() >= len(self.alphabet):
            raise BadFile("a block holds an id that the head does not name")
        ids = self.alphabet[ranks]
        if [zlib.crc32(ids[at : at + BLOCK]) for at in range(0, len(ids), BLOCK)] != self.sums.tolist():
            raise BadFile("a block does not fit its checksum")
        return ids


def segments(content: bytes | pa.Buffer) -> Iterator[Segment]:
    view, at, filler = memoryview(content), 0, FILLER.encode()
    while at < len(view):
        segment = Segment(view, at)
        at = segment.end + len(filler)
        if bytes(view[segment.end : at]) != filler:
            raise BadFile("no filler behind a segment")
        yield segment


def write_ids(docs: DataFrame, folder: str, tokenizer_path: str, pattern: str, end_id: int = END_ID):
    """Write the ids of every text, each followed by ``end_id``, to files below ``folder`` in ascending ``doc_id``."""

    def encode(batches):
        encoder = encoder_of(tokenizer_path, pattern)
        part, number = TaskContext.get().partitionId(), 0
        held: list[tuple[list[str | None], np.ndarray, np.ndarray]] = []

        def closed(least):
            """A segment of the first blocks held that have ``least`` ids together."""
            nonlocal number
            many = next((n for n in range(1, len(held)) if ids_of(held[:n]) >= least), len(held))
            doc_ids, totals, ids = zip(*held[:many])
            del held[:many]
            # The parts go as the whole is made, and what is no longer used before it is coded.
            ids = np.concatenate(ids)
            give_back()
            row = segment_bytes(part, number, [*chain(*doc_ids)], np.concatenate(totals), ids)
            number += 1
            return pa.RecordBatch.from_arrays([pa.array([row], pa.binary())], ["value"])

        for batch, texts in blocks(batches, "text"):
            ids, totals, _ = encoder.encode_utf8(texts, end_id, stops=False)
            held.append((batch.column("doc_id").to_pylist(), totals, ids))
            while ids_of(held) >= 2 * SEGMENT_IDS:
                yield closed(SEGMENT_IDS)
        encoder.trim()
        while held:
            left = ids_of(held)
            yield closed(left if left <= SEGMENT_IDS * 3 // 2 else left // 2)

    def ids_of(held):
        return sum(len(ids) for _, _, ids in held)

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("spread"))
    # In a frame's order a null id comes first; the hash lets rows that share an id go to several partitions.
    ordered = rows.repartitionByRange("doc_id", "spread").sortWithinPartitions("doc_id", "spread", "text")
    coded = ordered.select(F.col("doc_id").cast("string"), "text").mapInArrow(encode, "value binary")
    writer = coded.select(F.col("value").cast("string")).write.option("lineSep", FILLER)
    writer.option("maxRecordsPerFile", SEGMENTS_PER_FILE).text(folder)


def read_ids(spark: SparkSession, folder: str, id_type: str = "long", ids: bool = True) -> DataFrame:
    """One row per document of the files below ``folder``: ``doc_id``, ``start`` (ids of all documents before it),
    ``n_tokens``, ``ids_crc32`` of its ids as little-endian unsigned 32-bit integers, and the ids themselves as
    ``ids``.  A file that fails a check ends the job with its name."""

    def each(batches):
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                try:
                    yield from segments(content.as_buffer())
                except (ValueError, KeyError, IndexError, struct.error, zlib.error) as error:
                    raise BadFile(f"{path}: {error}") from error

    def heads(batches):
        for segment in each(batches):
            yield pa.RecordBatch.from_arrays([pa.array([own]) for own in (segment.part, segment.number, segment.count)], ["part", "segment", "n_ids"])

    def decode(batches):
        for segment in each(batches):
            found = segment.ids()
            ends = np.cumsum(segment.totals)
            begins = ends - segment.totals
            view = memoryview(np.ascontiguousarray(found, "<u4")).cast("B")
            sums = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist())]
            place = [pa.array(np.full(len(ends), own)) for own in (segment.part, segment.number)]
            rows = [pa.array(segment.doc_ids, pa.string()), *place, pa.array(begins), pa.array(segment.totals), pa.array(sums, pa.int64())]
            if ids:
                rows.append(pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(found.astype(np.int64))))
            yield pa.RecordBatch.from_arrays(rows, names)
        give_back()

    names = ["doc_id", "part", "segment", "begin", "n_tokens", "ids_crc32", "ids"][: 7 if ids else 6]
    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    found = files.mapInArrow(decode, ", ".join(f"{name} {dict(doc_id='string', ids='array<long>').get(name, 'long')}" for name in names))
    # A row per part, which is a task that wrote, with the sizes of its segments; these rows meet in one task.
    heads_of = files.mapInArrow(heads, "part long, segment long, n_ids long").groupBy("part")
    parts = heads_of.agg(F.sum("n_ids").alias("n_ids"), F.collect_list(F.struct("segment", "n_ids")).alias("own"))
    before = lambda window, name: F.coalesce(F.sum(name).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    places = parts.withColumn("earlier", before(Window.orderBy("part"), "n_ids")).select("part", "earlier", F.inline("own"))
    inner = before(Window.partitionBy("part").orderBy("segment"), "n_ids")
    places = places.select("part", "segment", (F.col("earlier") + inner).alias("offset"))
    columns = [F.col("doc_id").cast(id_type), (F.col("offset") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32"]
    return found.join(places, ["part", "segment"]).select(*columns, *(["ids"] if ids else []))
