"""Rows that every operator has to take."""

from __future__ import annotations

from pyspark.sql import types as T

#: Columns that clash with names that operators use inside, beside those of ``documents``.
CLASHING = "row string, fp long, cell long, item string, signals string, found_0 string, kept_id long, count long, word string"
DOCUMENTS = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"
_MORE = ("en", "s", 1, "r", 1, 2, "i", "g", "f", 3, 4, "w")

LONG = "ein langer Satz mit Wörtern. " * 8000
ODD_TEXTS = [
    None,
    "",
    " \t\n",
    "short",
    "Ünïcödé wörds and emoji \U0001f600 here. Ok!\r\nNext line   and   spaces",
    "same line\nsame line\nsame line\n\nother",
    "tie tie tie tie tie tie tie tie tie tie tie tie",
    LONG,
    "<|endoftext|> is no end here. A <|endoftext|> either.",
    "\x00\x01\x1c\x1d\x85 control characters",
]


def odd_rows() -> list[tuple]:
    """Odd texts, some twice under one id, some under a second id, some without id."""
    rows = [(at, text) for at, text in enumerate(ODD_TEXTS)]
    rows += [(3, "short"), (3, "short"), (40, "short"), (None, "short"), (None, "alone without an id but with several words"), (None, None)]
    return rows


def odd_documents(spark, rows=None):
    rows = odd_rows() if rows is None else rows
    return spark.createDataFrame([(doc_id, text, *_MORE) for doc_id, text in rows], DOCUMENTS)


def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)


def labels(spark, rows=((1, 1, 0),)):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def lower(text: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def same_columns(found, given):
    strip = lambda schema: [(field.name, field.dataType) for field in schema]
    return strip(found.schema) == strip(given.schema) and isinstance(found.schema, T.StructType)
