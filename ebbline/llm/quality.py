"""Quality rules: a hashed n-gram log-likelihood ratio of trusted target against raw corpus.

Words are maximal runs other than space and 0x09-0x0D, case kept.  Single words and pairs of neighbouring words are
hashed into 2**``BITS`` buckets, a fixed number, so the model has one size (16 MB) whatever the corpus.  Two multinomials
over the buckets are counted: one over *every* text (raw), one over the texts trusted by their labels (target).  An
n-gram's log ratio is

    log((target + a) / (raw * target_total / raw_total + a))

that is, both multinomials with ``a`` added at the size of the target, so that n-grams hardly seen say nothing.  A
text's score is the mean over its n-grams; its worst passage is the lowest mean over ``PASSAGE`` words in a row, a word
counting with the pair it begins.  Both are normalised for length: the first by that of the text, the second by a
fixed one, because a few abusive words do not move the mean of a long text.  A text is kept where both reach
``min_score``.  This decision is a function of the text and the counted model alone.

Defined results: a null text counts as empty; an empty text has score 0 and fails the base rules; a text of fewer words
than a passage is one passage, filled up with zeros; a very long text is judged as a whole, by all of its passages;
repeated rows are judged alike; labels with nulls are not trusted, and an id with several label rows is trusted only if
all agree; without trusted texts every score is 0; an empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbline.llm.common import WordBlock, blocks, codes_of, collected, per_text, row_struct, stored

#: Buckets, as a power of two.
BITS = 22
#: Buckets whose counts travel as one row, as a power of two.
SHARD_BITS = 12
#: At most so many labelled rows fit the target, those with the smallest hash of the id.  The raw side has no bound.
TRUSTED_ROWS = 100_000
SMOOTHING = 4.0
MIN_SCORE = -0.25
PASSAGE = 16
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SYMBOLS = b"#*$%&|<>"
_SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
_NOT_A_CODE_POINT = bytes(range(0x80, 0xC0)) + _SPACE

SIGNALS = T.StructType(
    [T.StructField(name, T.LongType()) for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [T.StructField("base_failed", T.BooleanType()), T.StructField("score", T.DoubleType()), T.StructField("worst", T.DoubleType()), T.StructField("kept", T.BooleanType())]
)


def ngram_hashes(words: WordBlock) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of every word and of every pair of neighbours within a text."""
    hashes = np.fromiter((xxhash.xxh64_intdigest(word, 7) for word in words.distinct), np.uint64, len(words.distinct))
    own = hashes[words.codes] if len(words.codes) else np.zeros(0, np.uint64)
    pair = words.doc[1:] == words.doc[:-1]
    two = own[:-1][pair] * np.uint64(0x9E3779B97F4A7C15) + (own[1:][pair] ^ np.uint64(0x2545F4914F6CDD1D))
    two *= np.uint64(0xC2B2AE3D27D4EB4F)
    return np.concatenate([own, two]), np.concatenate([words.doc, words.doc[:-1][pair]])


def ngram_buckets(words: WordBlock, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text of every word and of every pair of neighbours within a text."""
    hashes, docs = ngram_hashes(words)
    return (hashes >> np.uint64(64 - bits)).astype(np.int64), docs


def repeated_window_words(words: WordBlock, window: int = WINDOW) -> np.ndarray:
    """Per text, the words that lie in a window of ``window`` words found twice or more in that text.

    Windows are numbered exactly, by pairing the numbers of shorter runs, for all texts of the block at once.
    """
    n = len(words.codes)
    if n < window:
        return np.zeros(len(words.counts), np.int64)
    # Numbers of runs of 1, 2, 3 ... words that start at each place; a run may cross texts, such starts are masked below.
    run = words.codes
    for length in range(1, window):
        run, _ = codes_of(run[: n - length] * len(words.distinct) + words.codes[length:])
    starts = np.flatnonzero(words.doc[: n - window + 1] == words.doc[window - 1 :])
    found, _ = codes_of(run[starts] * len(words.counts) + words.doc[starts])
    again = starts[np.bincount(found)[found] > 1] if len(starts) else starts
    covered = np.zeros(n, bool)
    for step in range(window):
        covered[again + step] = True
    return words.sums(covered, np.int64)


def trusted_ids(labels: DataFrame, rows: int = TRUSTED_ROWS) -> DataFrame:
    """At most ``rows`` ids whose every label row says quality 1 and toxic 0."""
    good = F.coalesce((F.col("quality") == 1) & (F.col("toxic") == 0), F.lit(False))
    return (
        labels.where("doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min(good).alias("good"))
        .where("good")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
        .select(F.col("doc_id").alias("trusted_id"))
    )


@dataclass
class QualityModel:
    ratios: np.ndarray
    min_score: float = MIN_SCORE

    def signals(self, text: Column | str) -> Column:
        """The base counts, the score and the verdict of a text column, as one struct."""
        shared = SparkSession.getActiveSession().sparkContext.broadcast(self.ratios)
        min_score = self.min_score

        return per_text(lambda texts: judged(texts, shared.value, min_score), SIGNALS)(text)


def worst_passages(words: WordBlock, ratios: np.ndarray) -> np.ndarray:
    """Per text, the lowest mean of ``PASSAGE`` words in a row, given the ratios of all words and then of all pairs."""
    n = len(words.codes)
    worst = np.zeros(len(words.counts))
    if not n:
        return worst
    values = ratios[:n].astype(np.float64)
    values[:-1][words.doc[1:] == words.doc[:-1]] += ratios[n:]
    upto = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(words.counts)
    starts = ends - words.counts
    # Passages that would reach beyond their text start earlier, at the text's start at the earliest.
    first = np.maximum(np.minimum(np.arange(n), ends[words.doc] - PASSAGE), starts[words.doc])
    means = (upto[np.minimum(first + PASSAGE, ends[words.doc])] - upto[first]) / PASSAGE
    some = words.counts > 0
    worst[some] = np.minimum.reduceat(means, starts[some])
    return worst


def judged(texts: list[bytes], ratios: np.ndarray, min_score: float) -> pa.StructArray:
    """One row of signals per text."""
    words = WordBlock(texts)
    buckets, docs = ngram_buckets(words, int(np.log2(len(ratios))))
    grams = np.bincount(docs, minlength=len(texts))
    own = ratios[buckets]
    score = np.bincount(docs, weights=own, minlength=len(texts)) / np.maximum(grams, 1)
    worst = worst_passages(words, own)
    lines = [[line for line in text.split(b"\n") if line.strip()] for text in texts]
    repeats = repeated_window_words(words)
    failed = (words.counts < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * words.counts)
    columns = [
        words.counts,
        np.array([len(text.translate(None, _NOT_A_CODE_POINT)) for text in texts], np.int64),
        np.array([len(text) - len(text.translate(None, SYMBOLS)) for text in texts], np.int64),
        np.array([len(own) - len(set(own)) for own in lines], np.int64),
        repeats,
        failed,
        score,
        worst,
        ~failed & (score >= min_score) & (worst >= min_score),
    ]
    return pa.StructArray.from_arrays([pa.array(values) for values in columns], SIGNALS.names)


def narrow(counts: np.ndarray) -> bytes:
    """Counts in the fewest bytes each: 1, 2, 4 or 8, which the length tells."""
    return counts.astype(np.min_scalar_type(int(counts.max()))).tobytes()


def wide(data: bytes, size: int) -> np.ndarray:
    return np.frombuffer(data, f"<u{len(data) // size}").astype(np.int64)


def count_ngrams(rows: DataFrame, bits: int) -> DataFrame:
    """``shard``, ``raw`` and ``target``, arrays as bytes: the n-grams of all texts in ``rows`` and of those marked
    ``trusted``, for 2**``SHARD_BITS`` buckets a row.

    A task holds one number a bucket.  The parts of a shard, one per task, are added one after another from sorted
    rows, so that memory does not follow the number of tasks.
    """
    width = 1 << min(bits, SHARD_BITS)

    def batch(shards: list[int], arrays: list) -> pa.RecordBatch:
        parts = [pa.array([narrow(pair[side]) for pair in arrays], pa.binary()) for side in (0, 1)]
        return pa.RecordBatch.from_arrays([pa.array(shards, pa.int32()), *parts], ["shard", "raw", "target"])

    def count(batches):
        sums = np.zeros((2, 1 << bits), np.int64)
        for own, texts in blocks(batches, "text"):
            buckets, of = ngram_buckets(WordBlock(texts), bits)
            trusted = own.column("trusted").to_numpy(zero_copy_only=False)[of]
            for side, found in zip(sums, (buckets, buckets[trusted])):
                side += np.bincount(found, minlength=len(side))
        used = [at for at in range(0, 1 << bits, width) if sums[0, at : at + width].any()]
        for at in range(0, len(used), 256):
            part = used[at : at + 256]
            yield batch([first // width for first in part], [sums[:, first : first + width] for first in part])

    def add(batches):
        shard, sums = None, None
        for own in batches:
            for key, *pair in zip(*(own.column(name).to_pylist() for name in ("shard", "raw", "target"))):
                if key != shard:
                    if shard is not None:
                        yield batch([shard], [sums])
                    shard, sums = key, np.zeros((2, width), np.int64)
                sums += [wide(data, width) for data in pair]
        if shard is not None:
            yield batch([shard], [sums])

    fields = "shard int, raw binary, target binary"
    return rows.mapInArrow(count, fields).repartition("shard").sortWithinPartitions("shard").mapInArrow(add, fields)


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    bits: int = BITS,
    smoothing: float = SMOOTHING,
    trusted_rows: int = TRUSTED_ROWS,
    min_score: float = MIN_SCORE,
) -> QualityModel:
    """Count both multinomials in one pass over the texts.  The driver gets one number for each bucket at most."""
    ids = F.broadcast(trusted_ids(labels, trusted_rows))
    rows = docs.select(F.col("doc_id").alias("id"), F.col("text").alias("text"))
    rows = rows.join(ids, F.col("id") == F.col("trusted_id"), "left").select("text", F.col("trusted_id").isNotNull().alias("trusted"))
    sums = stored(count_ngrams(rows, bits), "ngrams")
    width = 1 << min(bits, SHARD_BITS)

    def totals(batches):
        for own in batches:
            sides = (sum(int(wide(data, width).sum()) for data in own.column(name).to_pylist()) for name in ("raw", "target"))
            yield pa.RecordBatch.from_arrays([pa.array([side], pa.int64()) for side in sides], ["raw", "target"])

    found = sums.mapInArrow(totals, "raw long, target long")
    total = found.agg(F.coalesce(F.sum("raw"), F.lit(0)).alias("raw"), F.coalesce(F.sum("target"), F.lit(0)).alias("target")).first()
    ratios = np.zeros(1 << bits, np.float32)
    if not total.target:
        return QualityModel(ratios, min_score)
    share = total.target / total.raw

    def divide(batches):
        for own in batches:
            pairs = zip(*(own.column(name).to_pylist() for name in ("raw", "target")))
            counts = ((wide(raw, width), wide(target, width)) for raw, target in pairs)
            logs = [np.log((target + smoothing) / (raw * share + smoothing)).astype("<f4").tobytes() for raw, target in counts]
            yield pa.RecordBatch.from_arrays([own.column("shard"), pa.array(logs, pa.binary())], ["shard", "ratios"])

    found = collected(sums.mapInArrow(divide, "shard int, ratios binary"))
    for shard, own in zip(found["shard"].tolist(), found["ratios"]):
        ratios[shard * width : (shard + 1) * width] = np.frombuffer(own, "<f4")
    return QualityModel(ratios, min_score)


def judge_documents(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """``doc_id`` and the signals of every row of ``docs``."""
    model = fit_quality(docs, labels, **settings)
    return docs.select(F.col("doc_id"), model.signals(F.col("text")).alias("s")).select("doc_id", "s.*")


def accepted(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that are kept, in the columns of ``docs``."""
    model = fit_quality(docs, labels, **settings)
    rows = row_struct(docs, model.signals(F.col("text")).alias("signals"))
    return rows.where("signals.kept").select("row.*")
