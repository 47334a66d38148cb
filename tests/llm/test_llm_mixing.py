import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from cases import lower, no_documents, odd_documents, odd_rows
from conftest import SMALL
from ebbline.llm import mixing


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text)) + [""]


def is_held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def brute(rows):
    counts = Counter()
    for doc_id, text in rows:
        if not is_held_out(doc_id):
            counts.update(words(text))
    total, kinds = sum(counts.values()), len(counts)
    out = []
    for doc_id, text in rows:
        own = words(text)
        base = sum(math.log10((counts[word] + 1) / (total + 1 * (kinds + 1))) for word in own)
        out.append((str(doc_id), is_held_out(doc_id), len(own), sum(counts[word] > 0 for word in own), total, round(base, 6)))
    return sorted(out)


def base(rows):
    return sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet").cache()


@pytest.fixture(scope="module")
def scored(documents):
    return mixing.score(documents, hot_words=500).collect()


def test_base_score_equals_brute_force(documents, scored):
    assert base(scored) == brute([(row.doc_id, row.text) for row in documents.collect()])


def test_held_out_texts_are_predicted(scored):
    """Better than the bytes' own frequencies would do, and not only where it has learnt."""
    held = [row for row in scored if row.held_out]
    bits = -sum(row.score for row in held) / math.log10(2)
    size = sum(row.n_bytes for row in held)
    assert bits / size < 2.6
    assert all(row.score < 0 and math.isfinite(row.score) for row in scored)
    assert all(row.bits_per_byte == pytest.approx(-row.score / math.log10(2) / max(1, row.n_bytes)) for row in held)


def test_odd_rows(spark):
    found = mixing.score(odd_documents(spark)).collect()
    assert base(found) == brute(odd_rows())
    assert len({row.score for row in found if row.n_bytes == 0}) == 1


def test_empty_and_no_training(spark):
    assert mixing.score(no_documents(spark)).count() == 0
    held = next(i for i in range(100) if is_held_out(i))
    (row,) = mixing.score(odd_documents(spark, [(held, "ab")])).collect()
    assert (row.n_known, row.train_tokens, row.base_score) == (0, 0, 0)


def counted(docs):
    rows = docs.select("text", mixing.held_out("doc_id").alias("held_out"))
    return mixing.count_runs(rows).cache()


def test_probabilities_of_all_symbols_sum_to_one(documents):
    runs = counted(documents.limit(200))
    model = mixing.fit(runs)
    for before in (b"", b"the ", "é une ".encode(), b"\x00\xff"):
        symbols = [mixing.END] * 5 + list(before)
        run = sum(symbol << (mixing.SYMBOL_BITS * (back + 1)) for back, symbol in enumerate(symbols[::-1][:5]))
        context = (run >> mixing.SYMBOL_BITS) & ((1 << 3 * mixing.SYMBOL_BITS) - 1)
        known = {row.run: row.n for group in runs.where(f"context = {context}").collect() for row in group.runs}
        asked = [run | symbol for symbol in range(mixing.SYMBOLS)]
        own = np.array(sorted(known.keys() | set(asked)), np.int64)
        bits = dict(zip(own.tolist(), model.bits(own, np.array([known.get(int(one), 0) for one in own]))))
        assert sum(2 ** -bits[one] for one in asked) == pytest.approx(1.0, abs=1e-4)


def scalar_bits(texts, learnt, model):
    """The bits of texts by counting every context of every decision in a dictionary."""
    code = model.counts.code
    path = [
        [(int(code.nodes[s, step]), int(code.ways[s, step])) for step in range(code.lengths[s])] for s in range(mixing.SYMBOLS)
    ]

    def steps(text):
        symbols = [mixing.END] * 5 + list(text) + [mixing.END]
        for at in range(5, len(symbols)):
            for node, way in path[symbols[at]]:
                yield symbols, at, node, way

    counts = Counter()
    for text in learnt:
        for symbols, at, node, way in steps(text):
            counts.update((tuple(symbols[at - order : at]), node, way) for order in range(6))
    out = []
    for text in texts:
        bits = 0.0
        for symbols, at, node, way in steps(text):
            place = 0
            while place < 5 and symbols[at - place - 1] not in mixing.SPACES:
                place += 1
            odds, gate = [], 0
            for order in range(6):
                n0, n1 = (counts[tuple(symbols[at - order : at]), node, one] for one in (0, 1))
                odds.append(math.log((n1 + mixing.PRIOR) / (n0 + mixing.PRIOR)))
                if n0 + n1:
                    gate = order * 4 + sum(n0 + n1 >= least for least in (1, 2, 4, 8)) - 1
            gate += place * 24
            mixed = sum(a * b for a, b in zip(odds, model.weights[gate]))
            step = round((min(max(mixed, -12.0), 12.0) + 12.0) / 0.75)
            cell = ((gate // 4) % 6 * 256 + node) * 33 + step
            p = (1 / (1 + math.exp(-mixed)) + model.corrected[cell]) / 2
            bits -= math.log2(p if way else 1 - p)
        out.append(bits)
    return out


def test_bits_equal_brute_force(documents, monkeypatch):
    """With runs held back and evaluated in small portions, and with most runs looked up by the join."""
    monkeypatch.setattr(mixing, "HELD_RUNS", 2000)
    monkeypatch.setattr(mixing, "SLICE_RUNS", 500)
    fitted = []
    fit = mixing.fit
    monkeypatch.setattr(mixing, "fit", lambda runs: fitted.append(fit(runs)) or fitted[0])
    docs = documents.where("n_chars < 600").orderBy("doc_id").limit(40)
    texts = {row.doc_id: (row.text or "").encode().lower() for row in docs.collect()}
    found = {row.doc_id: row.score for row in mixing.score(docs, hot_words=10, hot_runs=300).collect()}
    want = scalar_bits(texts.values(), [text for doc_id, text in texts.items() if not is_held_out(doc_id)], fitted[0])
    assert any(map(is_held_out, texts))
    for doc_id, bits in zip(texts, want):
        assert found[doc_id] == pytest.approx(-bits * math.log10(2), rel=1e-3)


def test_hot_runs_are_the_most_frequent(spark):
    bits = spark.createDataFrame([(run, n, run / 8) for run, n in ((5, 9), (3, 100), (8, 0), (1, 1), (2, 1))], "run long, n long, bits double")
    assert mixing.HotRuns.of(bits, 3).runs.tolist() == [3, 5]
    found, values = mixing.HotRuns.of(bits, 4).find(np.array([1, 3, 8]))
    assert found.tolist() == [True, True, False] and values.tolist() == [1 / 8, 3 / 8, 0]
    assert not mixing.HotRuns.of(bits, 0).find(np.array([1, 3]))[0].any()


def test_runs_hold_the_last_symbols():
    runs, sizes = mixing.runs_of([b"ab", b"", b"c"])
    digits = [[(int(run) >> (9 * back)) & 511 for back in range(6)] for run in runs]
    assert sizes.tolist() == [3, 1, 2]
    assert digits[0] == [97, *[256] * 5] and digits[1] == [98, 97, *[256] * 4] and digits[2] == [256, 98, 97, *[256] * 3]
    assert digits[3] == [256] * 6 and digits[4] == [99, *[256] * 5]


def test_run_counts_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(mixing, "HELD_RUNS", 50)
    texts = ["abracadabra abra", "abra", None, "ABRA", "x" * 300, "abraham"]
    want = Counter()
    for at, text in enumerate(texts):
        runs = mixing.runs_of([(text or "").lower().encode()])[0].tolist()
        want.update({run: 0 for run in runs} if is_held_out(at) else runs)
    groups = counted(odd_documents(spark, list(enumerate(texts)))).collect()
    assert {row.run: row.n for group in groups for row in group.runs} == dict(want)
    assert len({group.context for group in groups}) == len(groups)
    assert all((row.run >> 9) & (1 << 27) - 1 == group.context for group in groups for row in group.runs)
    assert any(map(is_held_out, range(len(texts))))


def test_many_repeats_are_counted_exactly(spark):
    """Far more occurrences in one context than 16 bits hold."""
    groups = counted(odd_documents(spark, [(at, "a" * 50_000) for at in (0, 1, 3)])).collect()
    run = sum(97 << 9 * back for back in range(6))
    held = sum(is_held_out(at) for at in (0, 1, 3))
    assert {row.run: row.n for group in groups for row in group.runs}[run] == (3 - held) * 49_995


def test_code_is_a_prefix_code():
    code = mixing.Code.of(np.arange(mixing.SYMBOLS) ** 2)
    assert np.exp2(-code.lengths.astype(float)).sum() == pytest.approx(1.0)
    paths = {tuple(zip(code.nodes[s, :n], code.ways[s, :n])) for s, n in enumerate(code.lengths)}
    assert len(paths) == mixing.SYMBOLS and code.nodes.max() < 256


def test_held_out_rule(spark):
    rows = odd_documents(spark, [(i, "") for i in range(50)]).select("doc_id", mixing.held_out("doc_id").alias("h")).collect()
    assert all(row.h == is_held_out(row.doc_id) for row in rows)
    assert SMALL
