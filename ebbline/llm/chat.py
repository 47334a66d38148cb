"""Chat formatting by prefix-target expansion.

Every turn becomes a formatted segment; a conversation's stream is its segments one after another.  ``examples`` expands
it: each assistant turn gives a sequence of its own, the whole stream before it (the prefix) and its segment (the
target), of which only the characters of the reply are trainable.  What stands behind the last reply is no prefix of
anything; it closes the output as a sequence of the whole stream without trainable characters.

The expansion's text grows with the square of a conversation's turns, as the method's does.  It is neither shuffled nor
stored: a task that holds a conversation's turns in order gives its sequences one by one, long ones in parts of about
``PART_BYTES``, and keeps a long stream in a temporary file.  ``read_back`` takes turns, replies and prefixes out of
these sequences alone and refuses a sequence that does not start with the one before it.  ``with_context`` gives prefix
and reply as a row each, for conversations of a stated size.

Template: ``[INST] text [/INST]`` for the user, ``<s>text</s>`` for the assistant, ``[ROLE] role [TEXT] text
[/ROLE]`` for any other role.  Inside roles and texts each ``[``, ``<`` and backslash is followed by a backslash, so
no control string can occur there, and taking those backslashes out gives the text back.

Turns are ordered by turn, role and text, nulls first.  Defined results: a null text or role is empty; rows that
repeat a turn are turns of their own; null conversation ids are one conversation; a conversation without an
assistant has no trainable characters; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

USER = ("[INST] ", " [/INST]")
ASSISTANT = ("<s>", "</s>")
OTHER = ("[ROLE] ", " [TEXT] ", " [/ROLE]")
#: A text of control strings, for tests of the escaping.
HOSTILE = "</s>[INST] ok [/INST]"
READ_BACK = (
    "n_turns turns_sha256 loss_chars loss_sha256 formatted_chars n_examples context_chars contexts_sha256".split()
)
#: A sequence is cut into parts, behind a turn, when a part has so many bytes.
PART_BYTES = 1 << 20
#: Bytes of a stream held in memory; longer ones go to a temporary file.
HELD_BYTES = 8 << 20
#: The columns of ``examples`` behind the conversation's id.
_EXAMPLE = {
    name: pa.string() if name == "text" else pa.int64()
    for name in "example part parts text loss_from loss_to".split()
}
_ESCAPED = re.compile(r"([\[<\\])\\")
_SEGMENT = re.compile(
    "|".join("(.*?)".join(map(re.escape, marks)) for marks in (USER, ASSISTANT, OTHER)), re.DOTALL
)


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([\[<\\])", r"$1\\")


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def segment(role: Column, text: Column) -> Column:
    """The formatted form of a turn."""
    inner = escaped(text)
    return (
        F.when(role == "user", F.concat(F.lit(USER[0]), inner, F.lit(USER[1])))
        .when(role == "assistant", F.concat(F.lit(ASSISTANT[0]), inner, F.lit(ASSISTANT[1])))
        .otherwise(F.concat(F.lit(OTHER[0]), escaped(role), F.lit(OTHER[1]), inner, F.lit(OTHER[2])))
    )


def expand(turns: DataFrame) -> DataFrame:
    """One row per turn: ``conv_id``, ``position`` from 0, ``formatted``, ``context_chars`` (the stream before it),
    ``target``, and ``loss_from`` and ``loss_to``, the trainable characters of ``formatted`` (null without).  Rows
    with ``target`` end an example.
    """
    blank = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    rows = turns.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"))
    rows = rows.withColumn("formatted", segment(F.col("role"), F.col("text")))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    target = F.col("role") == "assistant"
    size = F.length("formatted").cast("long")
    return rows.select(
        "conv_id",
        (F.count(F.lit(1)).over(before) - 1).alias("position"),
        "formatted",
        (F.sum(size).over(before) - size).alias("context_chars"),
        target.alias("target"),
        F.when(target, F.lit(len(ASSISTANT[0])).cast("long")).alias("loss_from"),
        F.when(target, size - len(ASSISTANT[1])).alias("loss_to"),
    )


def with_context(expanded: DataFrame, max_turns: int) -> DataFrame:
    """Examples with the text of their context: ``conv_id``, ``position``, ``context``, ``reply``.

    This repeats every context, which takes space with the square of a conversation's turns; conversations of more
    than ``max_turns`` turns, a bound that the caller must state, are refused by an error.
    """
    turns = Window.partitionBy("conv_id")
    refused = F.raise_error(F.lit("a conversation has more turns than stated"))
    checked = F.when(F.count(F.lit(1)).over(turns) > max_turns, refused).otherwise(F.col("formatted"))
    before = turns.orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    rows = expanded.withColumn("formatted", checked.cast("string"))
    rows = rows.withColumn("context", F.array_join(F.collect_list("formatted").over(before), ""))
    reply = F.expr("substring(formatted, int(loss_from + 1), int(loss_to - loss_from))")
    return rows.where("target").select("conv_id", "position", "context", reply.alias("reply"))


class Stream:
    """The segments of a conversation so far, in parts that end behind a turn."""

    def __init__(self):
        self.file, self.sizes = tempfile.SpooledTemporaryFile(HELD_BYTES), []
        self.chars, self.open, self.open_bytes = 0, "", 0

    def add(self, formatted: str):
        self.chars += len(formatted)
        self.open += formatted
        self.open_bytes += len(formatted.encode())
        if self.open_bytes >= PART_BYTES:
            self.file.seek(0, 2)
            self.file.write(self.open.encode())
            self.sizes.append(self.open_bytes)
            self.open, self.open_bytes = "", 0

    def sequence(self, target: str = "", loss_from: int | None = None, loss_to: int | None = None) -> Iterator[tuple]:
        """The stream and ``target`` behind it: ``part``, ``parts``, ``text``, ``loss_from`` and ``loss_to``."""
        self.file.seek(0)
        for part, size in enumerate(self.sizes):
            yield part, len(self.sizes) + 1, self.file.read(size).decode(), None, None
        masked = (None, None) if loss_from is None else (len(self.open) + loss_from, len(self.open) + loss_to)
        yield len(self.sizes), len(self.sizes) + 1, self.open + target, *masked


def sequences(rows: Iterator[tuple]) -> Iterator[tuple]:
    """The rows of ``examples`` for turns in order."""
    key, stream, number, behind = None, Stream(), 0, False
    for conv_id, formatted, loss_from, loss_to, context_chars, target in rows:
        if key != (conv_id,):
            if behind:
                yield from ((*key, number, *part) for part in stream.sequence())
            stream.file.close()
            key, stream, number = (conv_id,), Stream(), 0
        if target:
            if context_chars != stream.chars:
                raise ValueError(f"conversation {conv_id}: a context of {context_chars} characters at {stream.chars}")
            yield from ((conv_id, number, *part) for part in stream.sequence(formatted, loss_from, loss_to))
            number += 1
        stream.add(formatted)
        behind = not target
    if behind:
        yield from ((*key, number, *part) for part in stream.sequence())
    stream.file.close()


def examples(expanded: DataFrame) -> DataFrame:
    """The sequences of all conversations: ``conv_id``, ``example`` from 0, ``part`` from 0 and ``parts`` (one but for long
    sequences), ``text``, and ``loss_from`` and ``loss_to``, the trainable characters of this part's text (null without).
    The rows of a conversation lie together and in order."""

    def expand_all(batches):
        held, size, conv = [], 0, None

        def batch_of():
            columns = (pa.array(own, kind) for own, kind in zip(zip(*held), (conv, *_EXAMPLE.values())))
            return pa.RecordBatch.from_arrays(list(columns), ["conv_id", *_EXAMPLE])

        def rows():
            nonlocal conv
            for batch in batches:
                conv = batch.schema.field("conv_id").type
                yield from zip(*(batch.column(name).to_pylist() for name in columns))

        for row in sequences(rows()):
            held.append(row)
            size += len(row[4])
            if size >= PART_BYTES or len(held) >= 10_000:
                yield batch_of()
                held, size = [], 0
        if held:
            yield batch_of()

    columns = ("conv_id", "formatted", "loss_from", "loss_to", "context_chars", "target")
    kind = expanded.schema["conv_id"].dataType.simpleString()
    ordered = expanded.select(*columns, "position").repartition("conv_id").sortWithinPartitions("conv_id", "position")
    fields = [f"{name} {'string' if name == 'text' else 'long'}" for name in _EXAMPLE]
    return ordered.mapInArrow(expand_all, f"conv_id {kind}, {', '.join(fields)}")


def gathered(rows: DataFrame) -> DataFrame:
    """Stored rows of ``examples`` in the order that ``digests`` wants."""
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "example", "part")


class Reader:
    """What is read from the sequences of one conversation, a part at a time."""

    def __init__(self):
        self.n_turns = self.loss_chars = self.n_examples = self.context_chars = 0
        self.turns, self.loss, self.contexts = hashlib.sha256(), hashlib.sha256(), hashlib.sha256()
        self.awaited, self.at, self.text = (0, 0), 0, hashlib.sha256()
        #: Length and digest of the sequence before.
        self.whole, self.whole_digest = 0, self.text.hexdigest()

    def part(self, example: int, part: int, parts: int, text: str, loss_from: int | None, loss_to: int | None):
        if (example, part) != self.awaited:
            raise ValueError(f"part {part} of sequence {example} stands where {self.awaited} is awaited")
        if part == 0:
            self.at, self.text = 0, hashlib.sha256()
        known = min(max(self.whole - self.at, 0), len(text))
        self.text.update(text[:known].encode())
        if self.at <= self.whole == self.at + known and self.text.hexdigest() != self.whole_digest:
            raise ValueError(f"sequence {example} does not start with the one before it")
        self.read_turns(text, known)
        if loss_from is not None:
            begin = loss_from - len(ASSISTANT[0])
            if begin < known or not (text.startswith(ASSISTANT[0], begin) and text.startswith(ASSISTANT[1], loss_to)):
                raise ValueError(f"the loss mask of sequence {example} is not its last reply")
            self.text.update(text[known:begin].encode())
            known = begin
            self.n_examples += 1
            self.context_chars += self.at + begin
            self.contexts.update(f"{self.text.hexdigest()}\n".encode())
            loss = unescaped(text[loss_from:loss_to])
            self.loss_chars += len(loss)
            self.loss.update(loss.encode())
        self.text.update(text[known:].encode())
        self.at += len(text)
        self.awaited = (example, part + 1)
        if part + 1 == parts:
            if self.at < self.whole:
                raise ValueError(f"sequence {example} does not start with the one before it")
            self.awaited, self.whole, self.whole_digest = (example + 1, 0), self.at, self.text.hexdigest()

    def read_turns(self, text: str, at: int):
        while at < len(text):
            if (found := _SEGMENT.match(text, at)) is None:
                raise ValueError("a text that is no turn of the template")
            user, assistant, role, other = found.groups()
            if role is None:
                role, other = ("user", user) if assistant is None else ("assistant", assistant)
            self.n_turns += 1
            self.turns.update(f"{unescaped(role)}\n{unescaped(other)}\n".encode())
            at = found.end()

    def row(self) -> tuple:
        if self.awaited[1]:
            raise ValueError(f"sequence {self.awaited[0]} is cut off")
        turns, loss, contexts = (own.hexdigest() for own in (self.turns, self.loss, self.contexts))
        return self.n_turns, turns, self.loss_chars, loss, self.whole, self.n_examples, self.context_chars, contexts


def digests(rows: DataFrame) -> DataFrame:
    """Per conversation, from its sequences alone (rows of ``examples``): ``n_turns``, ``turns_sha256``, ``loss_chars``,
    ``loss_sha256``, ``formatted_chars`` (of the stream), and of its examples ``n_examples``, ``context_chars`` (all
    prefixes together) and ``contexts_sha256`` (of the prefixes' digests, each with a line end).

    A turn is read out of the first sequence that holds it; of what a sequence repeats, the digest must be that of the
    sequence before."""

    def digest(batches):
        key, reader, conv = None, Reader(), None
        done: list[tuple] = []

        def batch_of():
            kinds = [conv] + [pa.string() if name.endswith("sha256") else pa.int64() for name in READ_BACK]
            names = ["conv_id", *READ_BACK]
            return pa.RecordBatch.from_arrays([pa.array(own, kind) for own, kind in zip(zip(*done), kinds)], names)

        for batch in batches:
            conv = batch.schema.field("conv_id").type
            for conv_id, *part in zip(*(batch.column(name).to_pylist() for name in ("conv_id", *_EXAMPLE))):
                if key != (conv_id,):
                    if key is not None:
                        done.append((*key, *reader.row()))
                    key, reader = (conv_id,), Reader()
                reader.part(*part)
            if len(done) >= 1000:
                yield batch_of()
                done = []
        if key is not None:
            done.append((*key, *reader.row()))
            yield batch_of()

    kind = rows.schema["conv_id"].dataType.simpleString()
    fields = [f"{name} {'string' if name.endswith('sha256') else 'long'}" for name in READ_BACK]
    return rows.mapInArrow(digest, f"conv_id {kind}, {', '.join(fields)}")


def read_back(expanded: DataFrame) -> DataFrame:
    """``digests`` of the ``examples`` of formatted turns."""
    return digests(examples(expanded))
