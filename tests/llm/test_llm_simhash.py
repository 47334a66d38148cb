import numpy as np
import pytest
import xxhash

from cases import lower, no_documents, odd_documents, odd_rows, same_columns
from conftest import SMALL
from ebbline.llm import simhash
from ebbline.llm.graph import components


def brute_fingerprint(text):
    words = [word for word in lower(text).translate({c: " " for c in range(9, 14)}).split(" ") if word]
    if not words:
        return 0
    shingles = [" ".join(words[at : at + 4]) for at in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(shingle.encode(), 42) for shingle in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_classes(prints, bits=4):
    """For each distinct fingerprint the set of those it is connected to."""
    left, classes = set(prints), {}
    while left:
        reach, group = [left.pop()], set()
        while reach:
            at = reach.pop()
            group.add(at)
            near = {other for other in left if (at ^ other).bit_count() <= bits}
            left -= near
            reach += near
        classes |= dict.fromkeys(group, group)
    return classes


def brute_rows(rows):
    prints = [(doc_id, brute_fingerprint(text)) for doc_id, text in rows]
    classes = brute_classes({fp for _, fp in prints})
    ids = lambda group: min((i for i, fp in prints if fp in group and i is not None), default=None)
    return sorted(((i, f"{fp:016x}", ids(classes[fp])) for i, fp in prints), key=str)


def found_rows(docs):
    rows = simhash.near_duplicates(docs).select("doc_id", simhash.hex_digits("fp"), "component_id")
    return sorted((tuple(row) for row in rows.collect()), key=str)


def test_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert found_rows(docs) == brute_rows([(row.doc_id, row.text) for row in docs.collect()])


def test_odd_rows(spark):
    assert found_rows(odd_documents(spark)) == brute_rows(odd_rows())


def test_empty_table(spark):
    assert simhash.near_duplicates(no_documents(spark)).count() == 0
    assert simhash.one_of_each(no_documents(spark)).count() == 0


@pytest.mark.parametrize("bits", [0, 1, 3, 4, 6])
@pytest.mark.parametrize("chunk", [4096, 16])
def test_links_connect_all_near_fingerprints(spark, bits, chunk):
    rng = np.random.default_rng(bits)
    values = {int(x) for x in rng.integers(0, 2**63, 150, dtype=np.uint64)}
    for centre in list(values)[:3]:
        for _ in range(60):
            flips = rng.choice(64, rng.integers(0, 7), replace=False)
            values.add(centre ^ sum(1 << int(bit) for bit in flips))
    signed = np.array(sorted(values), np.uint64).view(np.int64).tolist()
    found = components(simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), bits, chunk))
    groups = {}
    for node, root in found.collect():
        groups.setdefault(root, set()).add(node & (2**64 - 1))
    want = {frozenset(group) for group in brute_classes(values, bits).values() if len(group) > 1}
    assert {frozenset(group) for group in groups.values()} == want


def test_a_crowded_cell_gives_fewer_links_than_members():
    values = np.arange(16, dtype=np.uint64)
    assert sum(len(a) for a, _ in simhash.spanning_links(values, 4)) == 15


def test_components_of_a_long_chain(spark):
    chain = spark.range(300).selectExpr("id * 7919 % 10007 AS a", "(id + 1) * 7919 % 10007 AS b")
    found = components(chain.unionByName(spark.createDataFrame([(20_000, 20_001), (20_001, 20_000), (5, 5)], "a long, b long")))
    assert sorted(row["count"] for row in found.groupBy("root").count().collect()) == [2, 301]


def test_one_document_of_each_component_stays(spark):
    docs = odd_documents(spark)
    kept = simhash.one_of_each(docs)
    assert same_columns(kept, docs)
    want = brute_rows(odd_rows())
    named = {component for _, _, component in want if component is not None}
    rows = kept.collect()
    assert sorted(row.doc_id for row in rows if row.doc_id is not None) == sorted(named)
    assert [row.text for row in rows if row.doc_id is None] == ["alone without an id but with several words"]


@pytest.mark.parametrize(
    "rows, want",
    [
        ([(1, "a"), (1, "b"), (2, "b")], [(1, "a"), (1, "b")]),
        ([(1, "b"), (2, "b"), (2, "a")], [(1, "b"), (2, "a")]),
        ([(1, "a"), (1, "a"), (3, "a")], [(1, "a")]),
        ([(4, "a"), (4, "b"), (4, "b"), (5, "c")], [(4, "a"), (4, "b"), (5, "c")]),
    ],
)
def test_ids_that_stand_on_several_texts_lose_none(spark, rows, want):
    texts = {"a": "one two three four five six seven", "b": "another text of quite different words here", "c": "third of them which is no copy"}
    kept = simhash.one_of_each(odd_documents(spark, [(doc_id, texts[name]) for doc_id, name in rows]))
    names = {text: name for name, text in texts.items()}
    assert sorted((row.doc_id, names[row.text]) for row in kept.collect()) == want
