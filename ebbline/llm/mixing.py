"""LM scoring by online logistic context mixing.

A lower-cased text is a sequence of bytes and one end symbol.  Each symbol is coded as the path to its leaf in a
Huffman tree of the training symbols, so that a symbol takes about four binary decisions; the probabilities of all
symbols sum to one. For every decision six predictors, one for each context of the last 0 to 5 symbols, look up how
often the training texts went either way, in slots addressed by a 64-bit hash of context and tree node.  A counter
that moves by 1/n at its n-th update holds just that share, whatever the order of updates; this is why its updates
may be summed over a cluster.  The predictions, as log-odds, are combined by weights; a gate chooses the set of
weights by the longest context seen before, how often, and the place in the word. Weights learn online: every task
passes over its share block by block and moves the weights by an online Newton step after each; tasks merge by
precision.  Last, an adaptive probability map corrects the result by node, context length and predicted odds from
what happened in training.  In learning, an occurrence is left out of the counts that predict it.

What is gathered grows with the texts and is exact: a stored table of all distinct runs of six symbols with their
counts in training (Spark combines them in each task, then by a shuffle).  The runs with the same last three symbols
before their own are one row of it.  All runs that touch a slot of order 3 or higher stand in one such row, so these
slots are counted where they are used and never travel; a row holds at most 257 ** 3 runs, whatever the corpus.  The
slots of orders 0 to 2 follow from the counts of three symbols, at most 257 ** 3 of them, and are broadcast.

The bits of every distinct run form another table.  Those of about ``HOT_RUNS`` most frequent runs are broadcast,
others are looked up by a join on the runs of each text, so that no model has to fit anywhere.

The base score is a unigram model with add-one smoothing over words.  Counts of the ``HOT_WORDS`` most frequent
words are broadcast, other words are looked up by a join on the words of each text.

Defined results: a null or empty text is the end alone; a null id counts as the empty text for the choice of
held-out rows; a very long text is a block of its own, scored whole; repeated rows count again and are scored alike;
without training texts every decision has even odds; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.llm.common import WordBlock, blocks, codes_of, collected, stored

ORDERS = 6
#: Orders whose slots are broadcast; runs are kept together by as many symbols before the last.
LOW_ORDERS = 3
SYMBOLS = 257
END = 256
SYMBOL_BITS = 9
LOW_PLACES = np.cumsum([0] + [1 << SYMBOL_BITS * order for order in range(LOW_ORDERS)])
SPACES = (0x20, 0x0A, END)
GATES = ORDERS * ORDERS * 4
ODDS_STEPS = 33
ODDS_LIMIT = 12.0
PRIOR = 0.4
MAP_PRIOR = 30.0
ROUNDS = 2
HOT_WORDS = 200_000
HOT_RUNS = 1_000_000
TEXT_BYTES = 5 << 20
#: Distinct runs a task holds before it passes them on.
HELD_RUNS = 3_000_000
#: Runs that are evaluated at once, besides the rest of the last row.
SLICE_RUNS = 30_000
MODULUS, HELD_OUT = 7, 2


def held_out(doc_id: Column | str) -> Column:
    """Whether a row is kept from learning."""
    text = F.coalesce(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string"), F.lit(""))
    return F.crc32(F.encode(text, "UTF-8")) % MODULUS == HELD_OUT


def runs_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For every symbol of every text the symbol and the five before it in one number, and the number of symbols of
    each text."""
    sizes = np.array([len(text) + 1 for text in texts], np.int64)
    symbols = np.full(int(sizes.sum()) + (ORDERS - 1) * len(texts), END, np.uint16)
    real = np.ones(len(symbols), bool)
    at = 0
    for text in texts:
        real[at : at + ORDERS - 1] = False
        at += ORDERS - 1
        symbols[at : at + len(text)] = np.frombuffer(text, np.uint8)
        at += len(text) + 1
    runs = symbols.astype(np.int64)
    for back in range(1, ORDERS):
        runs[back:] |= np.left_shift(symbols[:-back], SYMBOL_BITS * back, dtype=np.int64)
    return runs[real], sizes


def count_runs(rows: DataFrame) -> DataFrame:
    """``runs`` (``run``, ``n``; sorted) of each context of three symbols in the lower-cased column ``text``; ``n``
    counts the rows that are not ``held_out``."""

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        codes, runs = codes_of(np.concatenate([own for own, _ in parts]))
        return runs, np.bincount(codes, weights=np.concatenate([n for _, n in parts]), minlength=len(runs)).astype(np.int64)

    def count(batches):
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        for batch, raw in blocks(batches, "text", TEXT_BYTES):
            every, sizes = runs_of([text.lower() for text in raw])
            codes, runs = codes_of(every)
            learnt = ~batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
            n = np.bincount(codes, weights=np.repeat(learnt, sizes), minlength=len(runs))
            parts.append((runs, n.astype(np.int64)))
            if sum(len(own) for own, _ in parts) > HELD_RUNS:
                parts = [merged(parts)]
                if len(parts[0][0]) > HELD_RUNS // 2:
                    yield from emit(*parts.pop())
        if parts:
            yield from emit(*merged(parts))

    def emit(runs, n):
        for start in range(0, len(runs), 100_000):
            part = slice(start, start + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(runs[part]), pa.array(n[part])], ["run", "n"])

    context = F.expr(f"shiftright(run, {SYMBOL_BITS}) & {(1 << LOW_ORDERS * SYMBOL_BITS) - 1}").alias("context")
    counted = rows.select("text", "held_out").mapInArrow(count, "run long, n long")
    together = counted.select(context, "run", "n").repartition("context")
    sums = together.groupBy("context", "run").agg(F.sum("n").alias("n"))
    # In a fixed order, so that learning takes the same steps whenever it is repeated.
    runs = F.sort_array(F.collect_list(F.struct("run", "n"))).alias("runs")
    return sums.groupBy("context").agg(runs).sortWithinPartitions(F.xxhash64("context"))


def whole_contexts(batches) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Runs and their counts in slices that hold every run of each of their contexts."""
    for batch in batches:
        lists = batch.column("runs")
        ends = np.cumsum(lists.value_lengths().to_numpy())
        cuts = np.flatnonzero(np.diff(ends // SLICE_RUNS)) + 1
        for start, end in zip([0, *cuts], [*cuts, len(lists)]):
            run, n = lists.slice(start, end - start).flatten().flatten()
            yield run.to_numpy(), n.to_numpy()


class Compressed:
    """Fields that are large arrays are compressed on their way to the executors: tables that are hardly filled cost
    next to nothing."""

    def __getstate__(self) -> dict:
        return {
            name: (zstandard.compress(value.tobytes(), 1), value.dtype.str, value.shape)
            if isinstance(value, np.ndarray) and value.nbytes > 1 << 16
            else value
            for name, value in vars(self).items()
        }

    def __setstate__(self, state: dict):
        for name, value in state.items():
            if isinstance(value, tuple):
                raw, kind, shape = value
                value = np.frombuffer(zstandard.decompress(raw), kind).reshape(shape)
            setattr(self, name, value)


@dataclass
class Code:
    """The tree: for each symbol the nodes on its path, the way taken at each, and the path's length."""

    nodes: np.ndarray
    ways: np.ndarray
    lengths: np.ndarray

    @classmethod
    def of(cls, counts: np.ndarray) -> Code:
        heap = [(int(n) + 1, symbol, symbol) for symbol, n in enumerate(counts)]
        heapq.heapify(heap)
        parent: dict[int, tuple[int, int]] = {}
        for inner in range(SYMBOLS, 2 * SYMBOLS - 1):
            left, right = heapq.heappop(heap), heapq.heappop(heap)
            parent[left[2]], parent[right[2]] = (inner, 0), (inner, 1)
            heapq.heappush(heap, (left[0] + right[0], inner, inner))
        paths = []
        for symbol in range(SYMBOLS):
            path, at = [], symbol
            while at in parent:
                at, way = parent[at]
                path.append((at - SYMBOLS, way))
            paths.append(path[::-1])
        longest = max(map(len, paths))
        pad = [path + [(0, 0)] * (longest - len(path)) for path in paths]
        return cls(
            np.array([[node for node, _ in path] for path in pad], np.int64),
            np.array([[way for _, way in path] for path in pad], np.int8),
            np.array([len(path) for path in paths], np.int64),
        )

    def decisions(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of all decisions of all runs: the run, the node and the way taken."""
        symbols = runs & 511
        lengths = self.lengths[symbols]
        run = np.repeat(np.arange(len(runs)), lengths)
        step = np.arange(len(run)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        return run, self.nodes[symbols[run], step], self.ways[symbols[run], step]


def slots_of(runs: np.ndarray, run: np.ndarray, node: np.ndarray, order: int) -> np.ndarray:
    """The slots of all decisions in the context of ``order`` symbols."""
    context = (runs >> SYMBOL_BITS).view(np.uint64) & np.uint64((1 << SYMBOL_BITS * order) - 1)
    context = (context + np.uint64(order + 1)) * np.uint64(0xD6E8FEB86659FD93)
    context ^= context >> np.uint64(32)
    mixed_node = (node.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return ((context[run] ^ mixed_node) * np.uint64(0xC2B2AE3D27D4EB4F)).view(np.int64)


@dataclass
class Counts(Compressed):
    """The tree, and how often each decision of the low orders went either way: ``rows`` gives the row of a context
    in ``low`` (row 0: never seen), which has two numbers for every node."""

    code: Code
    rows: np.ndarray
    low: np.ndarray

    @classmethod
    def of(cls, code: Code, trigrams: np.ndarray, n: np.ndarray) -> Counts:
        before = trigrams >> SYMBOL_BITS
        places = [LOW_PLACES[order] + (before & ((1 << SYMBOL_BITS * order) - 1)) for order in range(LOW_ORDERS)]
        seen = np.unique(np.concatenate(places))
        rows = np.zeros(LOW_PLACES[-1], np.int32)
        rows[seen] = np.arange(1, len(seen) + 1)
        low = np.zeros((len(seen) + 1) * 512)
        for start in range(0, len(trigrams), 1_000_000):
            own = slice(start, start + 1_000_000)
            run, node, way = code.decisions(trigrams[own])
            for place in places:
                cells = (rows[place[own]][run].astype(np.int64) * 256 + node) * 2 + way
                low += np.bincount(cells, weights=n[own][run], minlength=len(low))
        return cls(code, rows, low.astype(np.float32).reshape(-1, 2))

    def low_counts(self, runs: np.ndarray, run: np.ndarray, node: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
        context = (runs >> SYMBOL_BITS) & ((1 << SYMBOL_BITS * order) - 1)
        pair = self.low[self.rows[LOW_PLACES[order] + context][run].astype(np.int64) * 256 + node]
        return pair[:, 0], pair[:, 1]


def fit_counts(runs: DataFrame) -> Counts:
    """The tree and the low orders from the stored runs."""
    flat = runs.select(F.inline("runs")).where("n > 0")
    last = F.expr(f"run & {(1 << LOW_ORDERS * SYMBOL_BITS) - 1}").alias("trigram")
    got = collected(flat.groupBy(last).agg(F.sum("n").alias("n")))
    trigrams, n = got["trigram"].astype(np.int64), got["n"].astype(np.float64)
    return Counts.of(Code.of(np.bincount(trigrams & 511, weights=n, minlength=SYMBOLS)), trigrams, n)


def log_odds(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    return np.log((n1 + np.float32(PRIOR)) / (n0 + np.float32(PRIOR)))


def seen_class(n: np.ndarray) -> np.ndarray:
    """0 for never, then 1, 2 or 3, 4 to 7, and 8 or more times."""
    return (n >= 1).astype(np.int8) + (n >= 2) + (n >= 4) + (n >= 8)


def word_places(runs: np.ndarray) -> np.ndarray:
    """How many symbols of a word precede the last symbol, at most five."""
    place = np.zeros(len(runs), np.int64)
    inside = np.ones(len(runs), bool)
    for back in range(1, ORDERS):
        symbol = (runs >> (SYMBOL_BITS * back)) & 511
        inside &= ~np.isin(symbol, SPACES)
        place += inside
    return place


def gates_of(seen: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The gate by the longest context seen, how often, and the place in the word; ``seen`` has a row for each order."""
    gate = np.zeros(seen.shape[1], np.int64)
    for order in range(ORDERS):
        gate = np.where(seen[order] > 0, order * 4 + seen[order] - 1, gate)
    return gate + place * (ORDERS * 4)


def logistic(odds: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-odds))


def map_cells(odds: np.ndarray, node: np.ndarray, gate: np.ndarray) -> np.ndarray:
    per_step = 2 * ODDS_LIMIT / (ODDS_STEPS - 1)
    step = np.rint((np.clip(odds, -ODDS_LIMIT, ODDS_LIMIT) + ODDS_LIMIT) / per_step).astype(np.int64)
    return (((gate >> 2) % ORDERS) * 256 + node) * ODDS_STEPS + step


MAP_CELLS = ORDERS * 256 * ODDS_STEPS


class Decisions:
    """All decisions of the runs of whole contexts as the mixer sees them.  In learning, each occurrence is left out
    of its own counts."""

    def __init__(self, counts: Counts, runs: np.ndarray, n: np.ndarray, learning: bool):
        self.run, self.node, way = counts.code.decisions(runs)
        self.way, self.n = way.astype(np.float64), n[self.run].astype(np.float64)
        self.odds = np.empty((ORDERS, len(way)), np.float32)
        seen = np.empty((ORDERS, len(way)), np.int8)
        ones = self.n * way
        for order in range(ORDERS):
            if order < LOW_ORDERS:
                n0, n1 = counts.low_counts(runs, self.run, self.node, order)
            else:
                slots = codes_of(slots_of(runs, self.run, self.node, order))[0]
                one = np.bincount(slots, weights=ones)
                n0, n1 = (np.bincount(slots, weights=self.n) - one)[slots], one[slots]
            if learning:
                n0, n1 = np.maximum(n0 - (way == 0), 0), np.maximum(n1 - (way == 1), 0)
            self.odds[order] = log_odds(n0, n1)
            seen[order] = seen_class(n0 + n1)
        self.gate = gates_of(seen, word_places(runs)[self.run])


def learn_weights(runs: DataFrame, shared: Broadcast, rounds: int = ROUNDS, block: int = 2048) -> np.ndarray:
    """Weights by gate.  Tasks step online from the merged weights of the round before; merging weighs by precision."""
    weights = np.full((GATES, ORDERS), 0.3)
    precision = np.tile(np.eye(ORDERS) * 50.0, (GATES, 1, 1))
    context = runs.sparkSession.sparkContext
    parts = max(1, runs.select(F.spark_partition_id()).distinct().count())

    for _ in range(rounds):
        start = context.broadcast((weights, precision))

        def learn(batches):
            w, a = (part.copy() for part in start.value)
            moved = np.zeros_like(a)
            for own, n in whole_contexts(batches):
                known = n > 0
                seen = Decisions(shared.value, own[known], n[known], learning=True)
                order = np.random.default_rng(len(own)).permutation(len(seen.run))
                for at in range(0, len(order), block):
                    pick = order[at : at + block]
                    gates, odds = seen.gate[pick], seen.odds[:, pick].astype(np.float64)
                    p = logistic(np.einsum("kd,dk->d", odds, w[gates]))
                    times, error = seen.n[pick], seen.way[pick] - p
                    for gate in np.unique(gates):
                        mine = gates == gate
                        x, weight = odds[:, mine], times[mine]
                        h = (x * (weight * p[mine] * (1 - p[mine]))) @ x.T
                        a[gate] += h
                        moved[gate] += h
                        w[gate] += np.linalg.solve(a[gate], x @ (weight * error[mine]))
            rows = np.concatenate([moved.reshape(GATES, -1), np.einsum("gij,gj->gi", moved, w)], axis=1).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(rows), dtype=np.int32)), pa.array(rows)], ["at", "value"])

        sums = collected(runs.mapInArrow(learn, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")))
        rows = np.zeros(GATES * ORDERS * (ORDERS + 1))
        rows[sums["at"]] = sums["value"]
        rows = rows.reshape(GATES, -1)
        moved, target = rows[:, : ORDERS**2].reshape(GATES, ORDERS, ORDERS), rows[:, ORDERS**2 :]
        ridge = np.eye(ORDERS) * 1e-3
        weights = np.stack([np.linalg.solve(moved[g] + ridge, target[g] + ridge @ weights[g]) for g in range(GATES)])
        precision = moved / parts + np.eye(ORDERS)
    return weights


def learn_map(runs: DataFrame, shared: Broadcast, w: np.ndarray) -> np.ndarray:
    """The corrected probability of each cell of the adaptive map, given the weights."""

    def learn(batches):
        sums = np.zeros((3, MAP_CELLS))
        for own, n in whole_contexts(batches):
            known = n > 0
            seen = Decisions(shared.value, own[known], n[known], learning=True)
            odds = np.einsum("kd,dk->d", seen.odds, w[seen.gate])
            cells = map_cells(odds, seen.node, seen.gate)
            for row, value in enumerate((seen.n, seen.n * seen.way, seen.n * logistic(odds))):
                sums[row] += np.bincount(cells, weights=value, minlength=MAP_CELLS)
        hit = np.flatnonzero(sums[0])
        yield pa.RecordBatch.from_arrays([pa.array(hit.astype(np.int32)), *(pa.array(own[hit]) for own in sums)], ["cell", "n", "ones", "expected"])

    names = ("n", "ones", "expected")
    got = collected(
        runs.mapInArrow(learn, "cell int, n double, ones double, expected double").groupBy("cell").agg(*[F.sum(x).alias(x) for x in names])
    )
    steps = np.tile(np.linspace(-ODDS_LIMIT, ODDS_LIMIT, ODDS_STEPS), MAP_CELLS // ODDS_STEPS)
    corrected = logistic(steps)
    n, ones, expected = (got[name] for name in names)
    corrected[got["cell"]] = (ones + MAP_PRIOR * expected / n) / (n + MAP_PRIOR)
    return corrected


@dataclass
class Model(Compressed):
    counts: Counts
    weights: np.ndarray
    corrected: np.ndarray

    def bits(self, runs: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The cost in bits of the last symbol of each run; ``runs`` are all runs of their contexts."""
        seen = Decisions(self.counts, runs, n, learning=False)
        odds = np.einsum("kd,dk->d", seen.odds, self.weights[seen.gate])
        p = (logistic(odds) + self.corrected[map_cells(odds, seen.node, seen.gate)]) / 2
        taken = np.clip(np.where(seen.way == 1, p, 1 - p), 1e-7, 1.0)
        return -np.bincount(seen.run, weights=np.log2(taken), minlength=len(runs))


def fit(runs: DataFrame) -> Model:
    """Learn from the stored result of ``count_runs``."""
    counts = fit_counts(runs)
    shared = runs.sparkSession.sparkContext.broadcast(counts)
    weights = learn_weights(runs, shared)
    corrected = learn_map(runs, shared, weights)
    shared.destroy()
    return Model(counts, weights, corrected)


def run_bits(runs: DataFrame, model: Model) -> DataFrame:
    """``run``, ``n`` and ``bits`` of every distinct run."""
    shared = runs.sparkSession.sparkContext.broadcast(model)

    def judge(batches):
        for own, n in whole_contexts(batches):
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(n), pa.array(shared.value.bits(own, n))], ["run", "n", "bits"])

    return runs.mapInArrow(judge, "run long, n long, bits double")


@dataclass
class HotRuns(Compressed):
    """The bits of frequent runs, sorted by run."""

    runs: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, bits: DataFrame, most: int) -> HotRuns:
        """Runs from the lowest count on, in steps of an eighth of a doubling, from which at most ``most`` are found."""
        step = F.floor(F.log2("n") * 8)
        learnt = bits.where("n > 0")
        steps = sorted(((row["step"], row["n"]) for row in learnt.groupBy(step.alias("step")).agg(F.count("n").alias("n")).collect()), reverse=True)
        totals = np.cumsum([n for _, n in steps])
        wanted = [at for (at, _), total in zip(steps, totals) if total <= most]
        if not wanted:
            return cls(np.zeros(1, np.int64) - 1, np.zeros(1))
        got = collected(learnt.where(step >= wanted[-1]).select("run", "bits"))
        order = np.argsort(got["run"])
        return cls(got["run"][order], got["bits"][order])

    def find(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each run is among them, and its bits (else 0)."""
        at = np.minimum(np.searchsorted(self.runs, runs), len(self.runs) - 1)
        found = self.runs[at] == runs
        return found, np.where(found, self.values[at], 0.0)


def lists_where(chosen: np.ndarray, doc: np.ndarray, codes: np.ndarray, values: pa.Array, docs: int, name: str) -> pa.ListArray:
    """For each of ``docs`` texts the distinct values at its chosen places, with how often they stand there."""
    kinds = max(1, len(values))
    keys, times = np.unique(doc[chosen] * kinds + codes[chosen], return_counts=True)
    offsets = np.searchsorted(keys // kinds, np.arange(docs + 1))
    entries = pa.StructArray.from_arrays([values.take(pa.array(keys % kinds)), pa.array(times.astype(np.int64))], [name, "n"])
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), entries)


def count_words(texts: DataFrame) -> DataFrame:
    """``word`` and ``n`` over the lower-cased column ``text``; the end of a text is the empty word."""

    def count(batches):
        for _, raw in blocks(batches, "text"):
            words = WordBlock([text.lower() for text in raw])
            n = np.bincount(words.codes, minlength=len(words.distinct))
            yield pa.RecordBatch.from_arrays(
                [pa.array([*words.distinct, b""], pa.binary()), pa.array(np.append(n, len(raw)).astype(np.int64))], ["word", "n"]
            )

    return texts.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def score(docs: DataFrame, hot_words: int = HOT_WORDS, hot_runs: int = HOT_RUNS) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` (log10),
    ``n_bytes`` and ``bits_per_byte`` of every row, learning from the rows that are not held out."""
    rows = docs.select("doc_id", "text", held_out("doc_id").alias("held_out"))
    training = rows.where("NOT held_out")
    words = stored(count_words(training), "words")
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    most = collected(words.orderBy(F.desc("n"), "word").limit(hot_words))
    hot = dict(zip(most["word"].tolist(), most["n"].tolist()))
    context = docs.sparkSession.sparkContext
    runs = stored(count_runs(rows), "runs")
    bits = stored(run_bits(runs, fit(runs)), "run_bits")
    shared = context.broadcast(HotRuns.of(bits, hot_runs))
    known = context.broadcast(hot)

    def judge(batches):
        key = TaskContext.get().partitionId() << 33
        for batch, raw in blocks(batches, "text", TEXT_BYTES):
            texts = [text.lower() for text in raw]
            block = WordBlock(texts)
            end = known.value.get(b"", 0)
            counts = np.array([known.value.get(word, -1) for word in block.distinct], np.int64)
            found = counts[block.codes] if len(block.codes) else np.zeros(0, np.int64)
            logs = np.log10(np.maximum(found, 0) + 1.0)
            every, sizes = runs_of(texts)
            codes, distinct = codes_of(every)
            is_hot, hot_bits = shared.value.find(distinct)
            doc = np.repeat(np.arange(len(texts)), sizes)
            columns = {
                "row_key": pa.array(key + np.arange(len(texts))),
                "doc_id": batch.column("doc_id"),
                "held_out": batch.column("held_out"),
                "n_tokens": pa.array(block.counts + 1),
                "hot_known": pa.array(block.sums(found > 0, np.int64) + int(end > 0)),
                "hot_sum": pa.array(block.sums(logs) + np.log10(end + 1.0)),
                "rare": lists_where(found < 0, block.doc, block.codes, pa.array(block.distinct, pa.binary()), len(texts), "word"),
                "hot_bits": pa.array(np.bincount(doc, weights=hot_bits[codes], minlength=len(texts))),
                "rare_runs": lists_where(~is_hot[codes], doc, codes, pa.array(distinct), len(texts), "run"),
                "n_bytes": pa.array(np.array([len(text) for text in raw], np.int64)),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))
            key += len(texts)

    kind = docs.schema["doc_id"].dataType.simpleString()
    fields = (
        f"row_key long, doc_id {kind}, held_out boolean, n_tokens long, hot_known long, hot_sum double,"
        " rare array<struct<word:binary,n:long>>, hot_bits double, rare_runs array<struct<run:long,n:long>>, n_bytes long"
    )
    judged = stored(rows.mapInArrow(judge, fields), "scored")
    asked = judged.select("row_key", F.explode("rare").alias("r")).select("row_key", "r.word", F.col("r.n").alias("times"))
    rare = (
        asked.join(words, "word")
        .groupBy("row_key")
        .agg(F.sum("times").alias("known"), F.sum(F.col("times") * F.log10(F.col("n") + F.lit(1.0))).alias("log_sum"))
    )
    smoothing = F.log10(F.lit(float(total["n"] + total["v"] + 1)))
    asked_runs = judged.select("row_key", F.explode("rare_runs").alias("r")).select("row_key", "r.run", F.col("r.n").alias("times"))
    rare_bits = asked_runs.join(bits, "run").groupBy("row_key").agg(F.sum(F.col("times") * F.col("bits")).alias("rare_bits"))
    joined = judged.drop("rare", "rare_runs").join(rare, "row_key", "left").join(rare_bits, "row_key", "left")
    joined = joined.withColumn("bits", F.col("hot_bits") + F.coalesce("rare_bits", F.lit(0.0)))
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("hot_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(total["n"]).cast("long").alias("train_tokens"),
        (F.col("hot_sum") + F.coalesce("log_sum", F.lit(0.0)) - F.col("n_tokens") * smoothing).alias("base_score"),
        (-F.col("bits") * F.log10(F.lit(2.0))).alias("score"),
        "n_bytes",
        (F.col("bits") / F.greatest(F.col("n_bytes"), F.lit(1))).alias("bits_per_byte"),
    )
