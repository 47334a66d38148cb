import hashlib
import random

import pytest
from pyspark.errors import PySparkException

from conftest import SMALL
from ebbline.llm import chat
from ebbline.llm.chat import HOSTILE
from ebbline.llm.queries import op9_chat

TURNS = "conv_id long, turn int, role string, text string, position long, formatted string, target boolean"


def turns(spark, rows):
    return spark.createDataFrame([(*row, 1, "f", True) for row in rows], TURNS)


def brute(rows):
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    loss = "".join(text or "" for role, text in rows if role == "assistant")
    return len(rows), sha("".join(f"{role or ''}\n{text or ''}\n" for role, text in rows)), len(loss), sha(loss)


def found(rows):
    return {row.conv_id: (row.n_turns, row.turns_sha256, row.loss_chars, row.loss_sha256) for row in rows.collect()}


def test_query_equals_brute_force(spark):
    given = {}
    for row in spark.read.parquet(f"{SMALL}/conversations.parquet").orderBy("conv_id", "turn").collect():
        given.setdefault(row.conv_id, []).append((row.role, row.text))
    given[-1] = [("user", HOSTILE), ("assistant", HOSTILE)]
    assert found(op9_chat(spark, SMALL)) == {conv: brute(rows) for conv, rows in given.items()}


def test_any_text_survives_escaping(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice(r"[]<>\/ INSTs" + "é\U0001f600\n$") for _ in range(rng.randrange(60))) for _ in range(400)]
    rows = [(n // 4, n % 4, rng.choice(["user", "assistant", "system", "[ROLE] \\x", ""]), text) for n, text in enumerate(texts)]
    expanded = chat.expand(turns(spark, rows))
    want = {}
    for conv, _, role, text in rows:
        want.setdefault(conv, []).append((role, text))
    assert found(chat.read_back(expanded)) == {conv: brute(own) for conv, own in want.items()}
    for row in expanded.collect():
        inner = row.formatted
        for control in (*chat.OTHER, *chat.USER, *chat.ASSISTANT):
            assert inner.count(control.strip()) <= 1


def test_odd_rows(spark):
    rows = [(1, 0, None, None), (1, 0, None, None), (1, None, "user", "first"), (None, 0, "assistant", "x"), (2, 1, "user", ""), (3, 0, "assistant", "y" * 200_000)]
    got = found(chat.read_back(chat.expand(turns(spark, rows))))
    assert got == {
        1: brute([("user", "first"), (None, None), (None, None)]),
        None: brute([("assistant", "x")]),
        2: brute([("user", "")]),
        3: brute([("assistant", "y" * 200_000)]),
    }
    assert chat.read_back(chat.expand(turns(spark, []))).count() == 0


def test_examples_hold_all_turns_before_them(spark):
    rows = [(1, 0, "system", "be [kind]"), (1, 1, "user", "hi"), (1, 2, "assistant", "a<b"), (1, 3, "user", "more"), (1, 4, "assistant", "end")]
    expanded = chat.expand(turns(spark, rows))
    stream = "".join(row.formatted for row in expanded.orderBy("position").collect())
    examples = chat.with_context(expanded, max_turns=10).orderBy("position").collect()
    spans = expanded.where("target").orderBy("position").collect()
    assert len(examples) == 2
    for example, span, text in zip(examples, spans, ("a<b", "end")):
        assert example.context == stream[: span.context_chars]
        assert chat.unescaped(example.reply) == text
        assert stream[span.context_chars :].startswith(span.formatted)
    with pytest.raises(PySparkException, match="more turns than stated"):
        chat.with_context(expanded, max_turns=4).collect()


def test_contexts_are_read_out_of_the_stream(spark):
    rows = [(1, 0, "user", "hi [x]"), (1, 1, "assistant", "a<b"), (1, 1, "assistant", "a<b"), (1, 3, "assistant", None), (2, 0, "user", "q")]
    expanded = chat.expand(turns(spark, rows))
    segments = [row.formatted for row in expanded.where("conv_id = 1").orderBy("position").collect()]
    contexts = ["".join(segments[:upto]) for upto in (1, 2, 3)]
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    got = {row.conv_id: row for row in chat.read_back(expanded).collect()}
    assert (got[1].n_examples, got[1].context_chars) == (3, sum(map(len, contexts)))
    assert got[1].contexts_sha256 == sha("".join(f"{sha(context)}\n" for context in contexts))
    assert (got[2].n_examples, got[2].context_chars, got[2].contexts_sha256) == (0, 0, sha(""))
    with pytest.raises(PySparkException, match="a context of"):
        chat.read_back(expanded.withColumn("context_chars", expanded.context_chars + 1)).collect()


def test_examples_are_whole_sequences(spark, tmp_path):
    rows = [(1, 0, "system", "be [kind]"), (1, 1, "user", "hi"), (1, 2, "assistant", "a<b"), (1, 3, "user", "é"), (1, 4, "assistant", "end"), (1, 5, "user", "bye"), (2, 0, "user", "q"), (3, 0, "assistant", "")]
    expanded = chat.expand(turns(spark, rows))
    by = {}
    for row in expanded.orderBy("position").collect():
        by.setdefault(row.conv_id, []).append(row.formatted)
    made = chat.examples(expanded)
    got = {(row.conv_id, row.example): row for row in made.collect()}
    want = {(1, 0): by[1][:3], (1, 1): by[1][:5], (1, 2): by[1], (2, 0): by[2], (3, 0): by[3]}
    assert {key: row.text for key, row in got.items()} == {key: "".join(own) for key, own in want.items()}
    masked = {key: row.loss_from is not None and chat.unescaped(row.text[row.loss_from : row.loss_to]) for key, row in got.items()}
    assert masked == {(1, 0): "a<b", (1, 1): "end", (1, 2): False, (2, 0): False, (3, 0): ""}
    # What is read back comes from these sequences alone, also when they were stored.
    direct = sorted(chat.read_back(expanded).collect())
    made.write.parquet(f"{tmp_path}/examples")
    stored = spark.read.parquet(f"{tmp_path}/examples")
    assert sorted(chat.digests(chat.gathered(stored)).collect()) == direct
    assert [row.n_examples for row in direct] == [2, 0, 1]
    other = "if(example = 1, replace(text, 'hi', 'ho'), text) AS text"
    with pytest.raises(PySparkException, match="does not start with the one before it"):
        chat.digests(chat.gathered(stored.selectExpr("conv_id", "example", "part", "parts", other, "loss_from", "loss_to"))).collect()
    with pytest.raises(PySparkException, match="is awaited"):
        chat.digests(chat.gathered(stored.where("example > 0"))).collect()


def test_long_streams_go_in_parts(monkeypatch):
    monkeypatch.setattr(chat, "PART_BYTES", 100)
    monkeypatch.setattr(chat, "HELD_BYTES", 300)
    rng, rows, stream, given = random.Random(8), [], 0, []
    for number in range(60):
        role, text = rng.choice(["user", "assistant"]), "é" * rng.randrange(90)
        start, end = chat.USER if role == "user" else chat.ASSISTANT
        formatted, target = start + text + end, role == "assistant"
        span = (len(start), len(formatted) - len(end)) if target else (None, None)
        rows.append((7, formatted, *span, stream, target))
        given.append((role, text))
        stream += len(formatted)
    made = list(chat.sequences(iter(rows)))
    reader, whole = chat.Reader(), {}
    for conv, *part in made:
        reader.part(*part)
        whole[part[0]] = whole.get(part[0], "") + part[3]
        assert len(part[3].encode()) < 100 + 2 * 200
    ends = [n + 1 for n, row in enumerate(rows) if row[-1]]
    want = ["".join(row[1] for row in rows[:end]) for end in (ends if ends[-1] == 60 else [*ends, 60])]
    assert list(whole.values()) == want and max(part[2] for part in made) > 20
    assert reader.row()[:4] == brute(given) and reader.row()[4] == stream
    cut = chat.Reader()
    for _, *part in made[:-1]:
        cut.part(*part)
    with pytest.raises(ValueError, match="cut off"):
        cut.row()
