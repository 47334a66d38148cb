import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cases import no_documents, odd_documents, odd_rows
from conftest import SMALL
from ebbline.llm import idfiles
from ebbline.llm.queries import QUERIES
from ebbline.llm.token_ids import Encoder
from ebbline.sources import scratch_path

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def want_of(tokenizer, rows):
    """(doc_id, start, number of ids, checksum) of rows in order of their ids."""
    found, start = [], 0
    for doc_id, text in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        found.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return found


def round_trip(spark, docs, **more):
    folder = scratch_path(spark, "ids")
    idfiles.write_ids(docs, folder, PATH, public_tokenizers.PATTERN)
    return idfiles.read_ids(spark, folder, **more)


def test_query_equals_brute_force(spark, tokenizer):
    rows = sorted((row.doc_id, row.text) for row in spark.read.parquet(f"{SMALL}/documents.parquet").collect())
    assert sorted(map(tuple, QUERIES["op12_idfiles"](spark, SMALL).collect())) == want_of(tokenizer, rows)


def test_odd_rows(spark, tokenizer):
    found = round_trip(spark, odd_documents(spark)).collect()
    want = [(own[0], *own[2:]) for own in want_of(tokenizer, odd_rows())]
    by = lambda rows: sorted(rows, key=lambda row: (row[0] is not None, row))
    assert by((row.doc_id, row.n_tokens, row.ids_crc32) for row in found) == by(want)
    # Gapless, in order of the ids, nulls first.
    found.sort(key=lambda row: row.start)
    assert [row.start for row in found] == np.cumsum([0, *(row.n_tokens for row in found)])[:-1].tolist()
    ids = [-1 if row.doc_id is None else row.doc_id for row in found]
    assert ids == sorted(ids)
    assert all(zlib.crc32(np.array(row.ids, "<u4").tobytes()) == row.ids_crc32 for row in found)


def test_empty_table_and_text_ids(spark):
    assert round_trip(spark, no_documents(spark)).count() == 0
    docs = spark.createDataFrame([("b", "x"), ("a\n\"", None)], "doc_id string, text string")
    found = round_trip(spark, docs, id_type="string").orderBy("start").collect()
    assert [(row.doc_id, row.start, row.n_tokens) for row in found] == [("a\n\"", 0, 1), ("b", 1, 2)]


def test_many_tasks(spark, tokenizer):
    rows = [(n, f"text {n} " * (n % 40)) for n in range(300)]
    whole = round_trip(spark, odd_documents(spark, rows)).collect()
    assert sorted((row.doc_id, row.start, row.n_tokens, row.ids_crc32) for row in whole) == want_of(tokenizer, rows)


@pytest.mark.parametrize("count, kinds", [(1, 1), (7, 3), (4096, 60), (4097, 60), (12000, 9000), (30000, 200_000), (8192, 1)])
def test_blocks_round_trip(count, kinds):
    ids = (np.random.default_rng(count).zipf(1.2, count) % kinds).astype(np.uint32)
    data = idfiles.segment_bytes(3, 1, ["x"], np.array([count]), ids)
    segment = idfiles.Segment(memoryview(data), 0)
    assert (segment.part, segment.number, segment.end) == (3, 1, len(data))
    assert np.array_equal(segment.ids(), ids)


def test_blocks_are_independent():
    """Each block's code alone gives the block's ids."""
    ranks = np.random.default_rng(5).integers(0, 500, 3 * idfiles.BLOCK + 100).astype(np.int32)
    codes = idfiles.encode_blocks(ranks, 0)
    for at, code in enumerate(codes):
        own = ranks[at * idfiles.BLOCK : (at + 1) * idfiles.BLOCK]
        assert idfiles.encode_blocks(own, 0) == [code]
        assert np.array_equal(idfiles.decode_blocks([code], len(own), 0), own)


def test_models_save_space():
    """Contexts that repeat are cheap, and a skewed order 0 costs about its entropy."""
    rng = np.random.default_rng(2)
    loop = np.tile(rng.integers(0, 20_000, 60), 600)[: 8 * idfiles.BLOCK].astype(np.uint32)
    assert len(idfiles.segment_bytes(0, 0, ["x"], np.array([len(loop)]), loop)) * 8 < 0.6 * len(loop)
    skewed = np.minimum(rng.geometric(0.02, 64 * idfiles.BLOCK), 1000).astype(np.uint32)
    share = np.bincount(skewed)[np.unique(skewed)] / len(skewed)
    bits = len(idfiles.segment_bytes(0, 0, ["x"], np.array([len(skewed)]), skewed)) * 8 / len(skewed)
    assert bits < 1.1 * -(share * np.log2(share)).sum()


def test_carries():
    """Long runs of certain choices push the interval against powers of two."""
    ranks = np.concatenate([np.zeros(3000, np.int32), np.arange(1000, dtype=np.int32), np.full(96, 40_000, np.int32)])
    for seed in range(4):
        mixed = np.random.default_rng(seed).permutation(ranks)
        assert np.array_equal(idfiles.decode_blocks(idfiles.encode_blocks(mixed, 0), len(mixed), 0), mixed)


def test_damage_is_found():
    ids = np.random.default_rng(1).integers(0, 900, 9000).astype(np.uint32)
    data = idfiles.segment_bytes(0, 0, ["x"], np.array([9000]), ids)
    whole = data + idfiles.FILLER.encode()
    assert [segment.count for segment in idfiles.segments(whole + whole)] == [9000, 9000]
    for broken in (data, whole[:-1], whole[:100], b"x" + whole, whole[:20] + b"\x01" + whole[21:], whole[:70] + b"\x00\x01" + whole[72:]):
        with pytest.raises(idfiles.BadFile):
            list(idfiles.segments(broken))
    for at in range(len(data) - 3000, len(data) - 8, 311):
        changed = bytes([*data[:at], data[at] ^ 16, *data[at + 1 :]])
        with pytest.raises(idfiles.BadFile):
            idfiles.Segment(memoryview(changed), 0).ids()


def test_file_name_is_given(spark, tmp_path):
    (tmp_path / "part-0.txt").write_bytes(b"no segment")
    with pytest.raises(Exception, match="part-0.txt"):
        idfiles.read_ids(spark, str(tmp_path)).collect()


def test_coding_holds_few_bytes_an_id():
    ids = (np.random.default_rng(1).zipf(1.2, 1 << 20) % 30_000).astype(np.uint32)
    tracemalloc.start()
    data = idfiles.segment_bytes(0, 0, ["x"], np.array([len(ids)]), ids)
    written = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    assert np.array_equal(idfiles.Segment(memoryview(data), 0).ids(), ids)
    read = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert written < 24 * len(ids) and read < 24 * len(ids)


def test_segments_of_a_task_are_even(spark, tokenizer):
    """What is left behind the last full segment makes no segment of its own."""
    blocks = [f"w{n % 50} " * (idfiles.SEGMENT_IDS // 8) for n in range(9)]
    docs = spark.createDataFrame(list(enumerate(blocks)), "doc_id long, text string").coalesce(1)
    folder = scratch_path(spark, "ids")
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 1)
    try:
        idfiles.write_ids(docs, folder, PATH, public_tokenizers.PATTERN)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    files = spark.read.format("binaryFile").load(folder).select("content").collect()
    counts = [segment.count for row in files for segment in idfiles.segments(bytes(row.content))]
    assert sum(counts) > idfiles.SEGMENT_IDS and min(counts) > idfiles.SEGMENT_IDS / 2
    got = [(row.doc_id, row.start, row.n_tokens, row.ids_crc32) for row in idfiles.read_ids(spark, folder, ids=False).collect()]
    assert sorted(got) == want_of(tokenizer, enumerate(blocks))


def test_held_words_are_dropped(monkeypatch, tokenizer):
    """Words met again stay, the others go; ids are the same with and without them."""
    monkeypatch.setattr("ebbline.llm.token_ids.GENERATION", 20)
    encoder = Encoder(PATH, public_tokenizers.PATTERN)
    for n in range(12):
        texts = [f"often seen {' '.join(f'x{n}y{m}' for m in range(9))}", "", "a <|endoftext|> b \u0531", "often " + "long" * 30]
        ids, totals, _ = encoder.encode(texts, 2)
        want = [tokenizer.encode(text, add_special_tokens=False).ids + [2] for text in texts]
        assert ids.tolist() == sum(want, []) and totals.tolist() == [len(own) for own in want]
        assert len(encoder.known) < 80 and len(encoder.known_ids) == encoder.known_sizes.sum()
    assert b"often" in encoder.known.to_pylist()
