"""What several operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from ebbline.sources import scratch_path

#: Texts are handled in blocks of about this many bytes, so that a task's memory follows neither its partition
#: nor its number of rows.  A single longer text is a block of its own.
BLOCK_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: work before this point is done once and survives
    lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def blocks(
    batches: Iterable[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES
) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Runs of rows with at most ``limit`` bytes of text (one row at least), with the texts as UTF-8; null is empty."""
    for batch in batches:
        texts = batch.column(column)
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
        start, total = 0, 0
        for at, size in enumerate(sizes):
            if total and total + size > limit:
                yield batch.slice(start, at - start), _utf8(texts.slice(start, at - start))
                start, total = at, 0
            total += size
        if len(texts) > start:
            yield batch.slice(start), _utf8(texts.slice(start))


def _utf8(texts: pa.Array) -> list[bytes]:
    return [text or b"" for text in texts.cast(pa.binary()).to_pylist()]


def give_back():
    """Return memory that Arrow and the C library hold unused to the system: a Python worker keeps what its task left while
    it waits for another, beside the workers that are at work."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def codes_of(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Dense numbers for equal keys in order of appearance, and the distinct keys."""
    if not len(keys):
        return np.zeros(0, np.int64), keys
    codes, distinct = pd.factorize(keys)
    return codes.astype(np.int64, copy=False), distinct


def per_text(judge: Callable[[list[bytes]], pa.Array], returns: DataType | str) -> Callable[[Column | str], Column]:
    """A column function that calls ``judge`` for blocks of texts in Arrow batches.  It is marked as not deterministic
    so that the optimizer does not repeat it in a filter."""

    def judged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = pa.RecordBatch.from_arrays([batch], ["text"])
            yield pa.concat_arrays([judge(texts) for _, texts in blocks([rows], "text")] or [judge([])])

    judged.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(judged, returns).asNondeterministic()


_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True


class WordBlock:
    """The words of several texts: maximal runs of bytes other than space and 0x09-0x0D.

    ``codes`` numbers the words of all texts one after another, ``distinct`` are the words behind the numbers,
    ``doc`` is the text of each word and ``counts`` the words of each text.
    """

    def __init__(self, texts: list[bytes]):
        data = np.frombuffer(b" ".join(texts), np.uint8)
        inside = np.concatenate([[False], ~_SPACES[data], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        offsets = pa.array(np.concatenate([[0], np.cumsum(ends - starts)]), pa.int64())
        letters = pa.py_buffer(np.ascontiguousarray(data[inside[1:-1]]))
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, offsets.buffers()[1], letters]).dictionary_encode()
        self.codes = words.indices.to_numpy().astype(np.int64)
        self.distinct = np.empty(len(words.dictionary), object)
        self.distinct[:] = words.dictionary.to_pylist()
        text_ends = np.cumsum([len(text) + 1 for text in texts], dtype=np.int64)
        self.doc = np.searchsorted(text_ends, starts, side="right")
        self.counts = np.bincount(self.doc, minlength=len(texts))

    def sums(self, values: np.ndarray, kind=np.float64) -> np.ndarray:
        """Sums of per-word values by text."""
        return np.bincount(self.doc, weights=values, minlength=len(self.counts)).astype(kind)


def collected(df: DataFrame) -> dict[str, np.ndarray]:
    """The columns of a frame whose number of rows has a fixed bound."""
    rows = df.toArrow()
    return {name: rows.column(name).to_numpy() for name in rows.column_names}


def row_struct(df: DataFrame, *more) -> DataFrame:
    """``df`` as one column ``row``, so that further columns cannot clash with those it has."""
    return df.select(F.struct(*[F.col(f"`{name}`") for name in df.columns]).alias("row"), *more)

