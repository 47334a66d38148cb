import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cases import labels, no_documents, odd_documents, odd_rows, same_columns
from conftest import SMALL
from ebbline.llm import quality
from ebbline.llm.common import WordBlock

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[at : at + 5]) for at in range(len(words) - 4))
    covered = {at + step for at in range(len(words) - 4) if windows[tuple(words[at : at + 5])] > 1 for step in range(5)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered), failed


def base(row):
    return row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words, row.base_failed


def test_base_counts_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {row.doc_id: row.text for row in docs.collect()}
    found = quality.judge_documents(docs, spark.read.parquet(f"{SMALL}/labels.parquet")).collect()
    assert len(found) == len(texts)
    assert all(base(row) == brute(texts[row.doc_id]) for row in found)


def test_odd_rows(spark):
    found = quality.judge_documents(odd_documents(spark), labels(spark)).collect()
    by_text = Counter((doc_id, brute(text)) for doc_id, text in odd_rows())
    assert Counter((row.doc_id, base(row)) for row in found) == by_text
    empty = [row for row in found if row.n_words == 0]
    assert empty and all(row.score == 0 and row.base_failed and not row.kept for row in empty)


def test_empty_tables(spark):
    assert quality.judge_documents(no_documents(spark), labels(spark)).count() == 0
    found = quality.judge_documents(odd_documents(spark), labels(spark, [])).collect()
    assert all(row.score == 0 and row.kept != row.base_failed for row in found)


def test_score_is_the_mean_log_ratio(spark):
    docs = odd_documents(spark, [(1, "good words are good " * 4), (2, "bad @@ tokens @@ " * 4)])
    model = quality.fit_quality(docs, labels(spark, [(1, 1, 0), (2, 0, 0)]), bits=12, smoothing=1.0)
    raw, target = Counter(), Counter()
    for number, text in ((1, "good words are good " * 4), (2, "bad @@ tokens @@ " * 4)):
        buckets, _ = quality.ngram_buckets(WordBlock([text.encode()]), 12)
        raw.update(buckets.tolist())
        if number == 1:
            target.update(buckets.tolist())
    share = sum(target.values()) / sum(raw.values())
    for bucket in raw:
        assert model.ratios[bucket] == pytest.approx(np.log((target[bucket] + 1) / (raw[bucket] * share + 1)), rel=1e-5)
    good, bad = (row.score for row in docs.select("doc_id", model.signals("text").alias("s")).orderBy("doc_id").select("s.score").collect())
    assert good > 0 > bad


def test_only_agreeing_labels_are_trusted(spark):
    rows = [(1, 1, 0), (1, 0, 0), (2, 1, 0), (2, 1, 0), (3, 1, 1), (4, None, 0), (None, 1, 0), (5, 1, 0)]
    assert [row[0] for row in quality.trusted_ids(labels(spark, rows)).orderBy(1).collect()] == [2, 5]
    assert quality.trusted_ids(labels(spark, rows), rows=1).count() == 1


def test_labelled_junk_is_rejected_and_good_text_kept(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    marks = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = quality.judge_documents(docs, marks).join(marks, "doc_id").where("NOT base_failed AND toxic = 0")
    shares = judged.selectExpr("quality", "int(kept) AS kept").groupBy("quality").agg(F.avg("kept").alias("share"))
    share = {row.quality: row.share for row in shares.collect()}
    assert share[1] > 0.98 and share.get(0, 0) < 0.2


def test_accepted_keeps_all_columns(spark):
    docs = odd_documents(spark)
    found = quality.accepted(docs, labels(spark))
    assert same_columns(found, docs)
    assert all(row.text and len(WORD.findall(row.text)) >= 10 for row in found.collect())


def test_counts_travel_in_few_bytes():
    for most, size in ((0, 1), (255, 1), (256, 2), (70_000, 4), (1 << 40, 8)):
        counts = np.array([0, most, most // 2, 0])
        data = quality.narrow(counts)
        assert len(data) == 4 * size and quality.wide(data, 4).tolist() == counts.tolist()


@pytest.mark.parametrize("shard_bits", [quality.SHARD_BITS, 6])
def test_counts_equal_plain_counting(spark, monkeypatch, shard_bits):
    monkeypatch.setattr(quality, "SHARD_BITS", shard_bits)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").repartition(5)
    marks = spark.read.parquet(f"{SMALL}/labels.parquet")
    texts = {row.doc_id: (row.text or "").encode() for row in docs.collect()}
    buckets, of = quality.ngram_buckets(WordBlock(list(texts.values())), 14)
    good = {row[0] for row in quality.trusted_ids(marks).collect()}
    trusted = np.array([doc_id in good for doc_id in texts])
    raw = np.bincount(buckets, minlength=1 << 14)
    target = np.bincount(buckets[trusted[of]], minlength=1 << 14)
    want = np.log((target + quality.SMOOTHING) / (raw * (target.sum() / raw.sum()) + quality.SMOOTHING))
    assert np.allclose(quality.fit_quality(docs, marks, bits=14).ratios, want, atol=1e-5)


def test_the_model_has_one_size(spark):
    small = quality.fit_quality(no_documents(spark), labels(spark))
    assert small.ratios.nbytes == 4 << quality.BITS == 16 << 20


def test_worst_passage_equals_brute_force():
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{n}" for n in rng.integers(0, 9, size)).encode() for size in (0, 1, 5, 15, 16, 17, 60, 0, 33, 0)]
    words = WordBlock(texts)
    buckets, _ = quality.ngram_buckets(words, 10)
    table = rng.normal(size=1 << 10).astype(np.float32)
    found = quality.worst_passages(words, table[buckets])
    for text, got in zip(texts, found):
        own = WordBlock([text])
        numbers, _ = quality.ngram_buckets(own, 10)
        values = table[numbers[: len(own.codes)]].astype(float)
        values[:-1] += table[numbers[len(own.codes) :]]
        starts = range(max(1, len(values) - quality.PASSAGE + 1))
        assert got == pytest.approx(min(values[at : at + quality.PASSAGE].sum() / quality.PASSAGE for at in starts) if len(values) else 0)


def test_verdict_does_not_depend_on_length(spark):
    """The same passage decides alike in a short text and in one that is fifty times as long."""
    rng = np.random.default_rng(8)
    prose = lambda n: " ".join(f"w{n}" for n in rng.integers(0, 300, n))
    abuse = " idiot scum idiot scum idiot scum "
    rows = [(n, prose(200) + (abuse if n % 10 == 0 else "")) for n in range(1000)]
    rows += [(2000, prose(40) + abuse + prose(40)), (2001, prose(2000) + abuse + prose(2000)), (2002, prose(4000)), (2003, prose(40))]
    marks = labels(spark, [(n, 1, int(n % 10 == 0)) for n in range(1000)])
    kept = {row.doc_id: row.kept for row in quality.judge_documents(odd_documents(spark, rows), marks).where("doc_id >= 2000").collect()}
    assert kept == {2000: False, 2001: False, 2002: True, 2003: True}


def test_a_few_abusive_words_are_enough(spark):
    """Good prose, and the same prose with three words that trusted texts never hold; rows not used to fit."""
    rng = np.random.default_rng(3)
    prose = lambda: " ".join(f"w{n}" for n in rng.integers(0, 300, 200))
    rows = [(n, prose() + (" idiot" * 3 if n % 10 == 0 else "")) for n in range(1000)]
    marks = labels(spark, [(n, 1, int(n % 10 == 0)) for n in range(800)])
    judged = quality.judge_documents(odd_documents(spark, rows), marks).where("doc_id >= 800 AND NOT base_failed").collect()
    assert all(row.score > quality.MIN_SCORE for row in judged)
    toxic, good = ([row.kept for row in judged if (row.doc_id % 10 == 0) == kind] for kind in (True, False))
    assert len(toxic) == 20 and not any(toxic) and np.mean(good) > 0.98
