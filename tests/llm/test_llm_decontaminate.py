import random

import pytest

from cases import no_documents, odd_documents, same_columns
from conftest import SMALL
from ebbline.llm import decontaminate as d

ITEM = "the quick brown fox jumps over the lazy dog while seven wizards brew a potion of green tea"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def least(item, text):
    """Fewest edits between the item and any part of the text."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return min(row)


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def edited(text, edits, rng):
    out = list(text)
    for _ in range(edits):
        at = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[at] = rng.choice("xyz")
        elif kind == 1:
            del out[at]
        else:
            out.insert(at, rng.choice("xyz"))
    return "".join(out)


def test_myers_equals_the_table():
    rng = random.Random(1)
    for _ in range(300):
        item = "".join(rng.choice("ab c") for _ in range(rng.randrange(1, 90)))
        text = "".join(rng.choice("ab c") for _ in range(rng.randrange(0, 60)))
        edits, end = d.best_end(d.peq(item), len(item), text)
        assert edits == least(item, text) and edits == min(least(item, text[:end]), len(item))


def test_planted_passages_are_found_within_the_budget(spark):
    rng = random.Random(2)
    budget = len(ITEM) // d.CHARS_PER_EDIT
    texts = [f"some words before {edited(ITEM, n, rng)} and after" for n in list(range(budget + 4)) * 4]
    found = {row.doc_id: row for row in d.leaks(odd_documents(spark, list(enumerate(texts))), items(spark, [(7, ITEM)])).collect()}
    for number, text in enumerate(texts):
        want = least(ITEM, d.plain(text))
        assert (number in found) == (want <= budget)
        if number in found:
            row = found[number]
            assert row.item_id == 7 and row.edits == want
            assert distance(ITEM, d.plain(text)[row.start_char : row.end_char]) == want


def test_given_documents_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    benchmark = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    wanted = {row.item_id: d.plain(row.text) for row in benchmark.collect()}
    exact = {(row.doc_id, i) for row in docs.collect() for i, item in wanted.items() if item in d.plain(row.text or "")}
    found = d.leaks(docs, benchmark).collect()
    assert exact == {(row.doc_id, row.item_id) for row in found if row.edits == 0}


def test_case_and_white_space_do_not_matter_and_the_best_place_counts(spark):
    text = f"{ITEM[:-6]}xx tea. {ITEM.upper().replace(' ', chr(10))} end"
    (row,) = d.leaks(odd_documents(spark, [(1, text)]), items(spark, [(1, f"  {ITEM} ")])).collect()
    assert row.edits == 0 and d.plain(text)[row.start_char : row.end_char] == ITEM


def test_odd_rows_and_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(d.item_blocks, "__defaults__", (60,))
    rows = [(1, None), (2, ""), (3, "  "), (None, "short"), (4, "short"), (5, "tie tie tie tie tie tie tie tie tie tie tie"), (6, ITEM)]
    found = d.leaks(odd_documents(spark), items(spark, rows)).collect()
    assert {(row.doc_id, row.item_id) for row in found} == {(x, y) for x in (3, 40, None) for y in (None, 4)} | {(6, 5)}
    assert sum(row.doc_id == 3 for row in found) == 6


@pytest.mark.parametrize("rows", [[], [(1, None)]])
def test_empty_tables(spark, rows):
    assert d.leaks(odd_documents(spark), items(spark, rows)).count() == 0
    assert d.leaks(no_documents(spark), items(spark, [(1, ITEM)])).count() == 0
    docs = odd_documents(spark)
    assert d.without_leaks(docs, items(spark, rows)).count() == docs.count()


def test_clean_rows_stay_whole(spark):
    docs = odd_documents(spark)
    kept = d.without_leaks(docs, items(spark, [(4, "short")]))
    assert same_columns(kept, docs)
    assert kept.count() == docs.count() - 5
