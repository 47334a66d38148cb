import zlib
from itertools import product

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cases import no_documents, odd_documents, odd_rows
from conftest import SMALL
from ebbline.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def check(tokenizer, rows, pieces, length=1024):
    """Every id in exactly one piece, sequences gapless and not too long; the share of padding."""
    want = {}
    for doc_id, text in rows:
        want.setdefault((doc_id, text or ""), 0)
        want[doc_id, text or ""] += 1
    by_doc = {}
    for piece in pieces:
        by_doc.setdefault((piece.doc_id, piece.doc_tokens), []).append(piece)
    expected = {}
    for (doc_id, text), times in want.items():
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [0], "<u4")
        expected.setdefault((doc_id, len(ids)), []).extend([ids] * times)
    assert set(by_doc) == set(expected)
    for key, own in by_doc.items():
        if len(expected[key]) > 1:
            continue
        (ids,), at = expected[key], 0
        for piece in sorted(own, key=lambda p: p.start):
            part = ids[at : at + piece.length]
            assert piece.start == at and piece.ids_crc32 == zlib.crc32(part.tobytes()) and list(part) == list(piece.ids)
            at += piece.length
        assert at == len(ids)
    sequences = {}
    for piece in pieces:
        sequences.setdefault(piece.sequence_id, []).append(piece)
    padding = total = 0
    for own in sequences.values():
        at = 0
        for piece in sorted(own, key=lambda p: p.offset):
            assert piece.offset == at and piece.length > 0
            at += piece.length
        assert at <= length
        total += at
        padding += 0 if at & (at - 1) == 0 else length - at
    return padding / max(total, 1)


def test_given_documents(spark, tokenizer):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").coalesce(1)
    pieces = packing.pack(docs, PATH, public_tokenizers.PATTERN).collect()
    assert check(tokenizer, [(row.doc_id, row.text) for row in docs.collect()], pieces) < 0.01


def test_odd_rows(spark, tokenizer):
    pieces = packing.pack(odd_documents(spark), PATH, public_tokenizers.PATTERN).collect()
    check(tokenizer, odd_rows(), pieces)


def test_empty_table(spark):
    assert packing.pack(no_documents(spark), PATH, public_tokenizers.PATTERN).count() == 0


def test_order_is_kept(spark):
    docs = odd_documents(spark, [(n, "word " * (n % 50)) for n in range(200)]).coalesce(1)
    pieces = packing.pack(docs, PATH, public_tokenizers.PATTERN).collect()
    pieces.sort(key=lambda p: (p.sequence_id, p.offset))
    assert [(p.doc_id, p.start) for p in pieces] == sorted((p.doc_id, p.start) for p in pieces)


def test_ids_equal_the_tokenizer_on_every_plane(tokenizer):
    encoder = packing.Encoder(PATH, public_tokenizers.PATTERN)
    texts = ["".join(f"a{chr(c)}1{chr(c)} {chr(c)}\n" for c in range(start, start + 64) if not 0xD800 <= c < 0xE000) for start in range(0, 0x20000, 1024)]
    texts += ["it's we'll  two   spaces \n\n\n end", "<|endoftext|>x", "", " ", "\n \n"]
    ids, totals, _ = encoder.encode(texts)
    want = [tokenizer.encode(text, add_special_tokens=False).ids + [0] for text in texts]
    assert totals.tolist() == [len(own) for own in want]
    assert ids.tolist() == [one for own in want for one in own]


def brute_cost(places, cost, length, cuts):
    total, last = 0, 0
    price = dict(zip(places.tolist(), cost.tolist()))
    for cut in cuts:
        size = cut - last
        if size > length:
            return None
        free = size & (size - 1) == 0 and size >= length // packing.FEWEST
        total += price[cut] + packing.EACH + (0 if free else length - size)
        last = cut
    return total


@pytest.mark.parametrize("seed", range(30))
def test_cuts_are_optimal(seed, monkeypatch):
    monkeypatch.setattr(packing, "FEWEST", 4 if seed % 2 else 16)
    monkeypatch.setattr(packing, "EACH", seed % 3)
    rng = np.random.default_rng(seed)
    ends = np.cumsum(rng.integers(1, 14, 4))
    stops = np.unique(rng.integers(1, ends[-1] + 1, 4))
    places, cost = packing.cut_places(ends, stops, 16)
    cuts = packing.best_cuts(places, cost, 16)
    inner = places[1:-1].tolist()
    options = ([p for p, used in zip(inner, mask) if used] + [int(places[-1])] for mask in product([0, 1], repeat=len(inner)))
    best = min(c for option in options if (c := brute_cost(places, cost, 16, option)) is not None)
    assert brute_cost(places, cost, 16, cuts.tolist()) == best


def test_every_sentence_end_and_power_is_sought():
    doc_ends, stops = np.array([900, 1600, 2500]), np.arange(3, 2500, 5)
    places, cost = packing.cut_places(doc_ends, stops, 1024)
    price = dict(zip(places.tolist(), cost.tolist()))
    assert all(price.get(stop) == (0 if stop in doc_ends else packing.SENTENCE) for stop in stops.tolist())
    assert all(price[end] == 0 for end in doc_ends.tolist())
    for power in (1 << bit for bit in range(11)):
        assert packing.best_cuts(np.array([0, 1024, 1024 + power]), np.array([0, 0, 0])).tolist() == [1024, 1024 + power]
        assert packing.best_cuts(np.array([0, power, power + 1024]), np.array([0, 0, 0])).tolist() == [power, power + 1024]


def test_small_powers_save_padding():
    """1032 ids: 1024 and 8, the last without padding, where the sentence end allows it."""
    places, cost = packing.cut_places(np.array([1032]), np.array([8, 520]), 1024)
    cuts = packing.best_cuts(places, cost).tolist()
    assert cuts == [8, 1032]
