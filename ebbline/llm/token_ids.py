"""Token ids of many texts by the ``tokenizers`` library, found once per distinct word of a block.

Byte-pair merges never cross the words of the tokenizer's own splitting rule, so the ids of a text are those of its
words one after another.  The texts of a block are cut into words by array operations over their bytes, Arrow numbers
the distinct words, and only words that are not in the cache go to the library, many at a time, with its merges and
without its splitting.  Texts with characters that need Unicode classes are cut by the rule itself; texts that hold a
special token, or a character which the two regex libraries class differently, are encoded whole.
"""

from __future__ import annotations

import codecs
import os
from itertools import accumulate

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex

from ebbline.llm.common import give_back

#: When a worker holds twice so many encoded words, those not met again since they came, or since the last time, are
#: dropped; at most so many stay.
GENERATION = 120_000
#: Longer words are encoded each time and not held.
HELD_BYTES = 64
#: Words that the library gets as one text.
GROUP = 200
#: Where the two regex libraries' Unicode versions differ in what is a letter or number (found by trying every code point), widened
#: to whole ranges.
NEWER_LETTERS = r"[\u0530-\u058f\u0880-\u088f\u0c5c\u0cdc\u2080-\u209f\ua7c0-\ua7ff\uab60-\uab6f\U00010000-\U0010ffff]"

_SPACE, _LETTER, _DIGIT, _OTHER = range(4)
#: Classes of the bytes of plain texts: ASCII without 0x1C-0x1F, and U+00C0-U+023F (two bytes, 0xC3-0xC8 first), which
#: are letters but for the two signs of ``_SIGNS``.
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE
_CLASS[48:58] = _DIGIT
_CLASS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = _LETTER
_PLAIN = np.zeros(256, bool)
_PLAIN[[*range(28), *range(32, 192), *range(0xC3, 0xC9)]] = True
_SIGNS = (0x97, 0xB7)
_TWO_LETTERS = [int.from_bytes(two, "little") for two in (b"re", b"ve", b"ll")]


def byte_letters() -> str:
    """The character that stands for each byte in the vocabularies of byte-level tokenizers: printable Latin-1
    characters for themselves, the others by the code points from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return "".join(chr(byte if byte in shown else next(hidden)) for byte in range(256))


def plain_starts(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Marks of the bytes at which a word of ``public_tokenizers.PATTERN`` starts, for plain texts that begin at
    ``begins`` and follow one another."""
    n = len(data)
    new = np.zeros(n + 2, bool)
    new[begins] = True
    new[n:] = True
    kind = np.append(_CLASS[data], [_SPACE, _SPACE])
    data = np.append(data, [0, 0]).astype(np.uint8)
    start = new.copy()
    start[1:] |= kind[1:] != kind[:-1]
    # The last of several white-space characters before something else stands apart; a blank joins what follows.
    blank = kind == _SPACE
    last = np.flatnonzero(blank[:n] & ~blank[1 : n + 1] & ~new[1 : n + 1])
    start[last] = True
    start[last[data[last] == 32] + 1] = False
    quote = np.flatnonzero((data[:n] == 39) & start[:n] & (kind[1 : n + 1] == _LETTER) & ~new[1 : n + 1])
    one = np.isin(data[quote + 1], np.frombuffer(b"stmd", np.uint8))
    two = np.isin(data[quote + 1].astype(np.int64) | data[quote + 2].astype(np.int64) << 8, _TWO_LETTERS) & ~new[quote + 2]
    short = quote[one | two]
    start[short + 1] = False
    start[short + 2 + two[one | two]] = True
    return start[:n]


class Encoder:
    def __init__(self, path: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = Tokenizer.from_file(path)
        self.merges.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
        # Words come here once: a cache of the library's own would only be filled.
        self.merges.model._resize_cache(0)
        self.sizes = np.zeros(self.merges.get_vocab_size(), np.int64)
        for word, number in self.merges.get_vocab().items():
            self.sizes[number] = len(word)
        #: No byte of UTF-8 is 0xFF: it sets words apart.
        self.letters = byte_letters()[:255] + "\n"
        self.split = regex.compile(pattern).findall
        self.by_bytes = pattern == public_tokenizers.PATTERN
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.marks = [token.encode() for token in self.special]
        self.whole = regex.compile("|".join([*map(regex.escape, self.special), NEWER_LETTERS])).search
        #: Held words with their numbers of ids, all their ids, and whether they were met again.
        self.known = pa.array([], pa.large_binary())
        self.known_sizes, self.known_ids = np.zeros(0, np.int64), np.zeros(0, "<u4")
        self.met = np.zeros(0, bool)

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [found.ids for found in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def merged(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words, each of which is one word of the splitting rule, and each word's number of ids.  Ids are told
        apart by their bytes."""
        texts = [codecs.charmap_decode(b"\xff".join(words[at : at + GROUP]), "strict", self.letters)[0] for at in range(0, len(words), GROUP)]
        ids = np.concatenate([np.array(found.ids, "<u4") for found in self.merges.encode_batch_fast(texts, add_special_tokens=False)])
        word_ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        return ids, np.diff(np.searchsorted(np.cumsum(self.sizes[ids]), word_ends) + 1, prepend=0)

    def coded(self, words: pa.Array, whole: set[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of distinct words, where each word's ids begin, its number of ids, and all ids.  Held words are looked up,
        those of ``whole`` texts encoded by the full rule."""
        if len(self.known) > 2 * GENERATION:
            self.drop()
        at = pc.fill_null(pc.index_in(words, value_set=self.known), -1).to_numpy()
        held, missing = np.flatnonzero(at >= 0), np.flatnonzero(at < 0)
        self.met[at[held]] = True
        sizes, begins = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        sizes[held] = self.known_sizes[at[held]]
        begins[held] = (np.cumsum(self.known_sizes) - self.known_sizes)[at[held]]
        fresh = words.take(pa.array(missing))
        texts, parts = fresh.to_pylist(), [self.known_ids]
        apart = np.fromiter((text in whole for text in texts), bool, len(texts)) if whole else np.zeros(len(texts), bool)
        plain = np.flatnonzero(~apart)
        if len(plain):
            ids, own = self.merged([texts[n] for n in plain] if len(plain) < len(texts) else texts)
            parts.append(ids)
            sizes[missing[plain]] = own
            begins[missing[plain]] = len(self.known_ids) + np.cumsum(own) - own
            short = np.fromiter(map(len, texts), np.int64, len(texts))[plain] < HELD_BYTES
            self.known = pa.concat_arrays([self.known, fresh.take(pa.array(plain[short]))])
            self.known_sizes = np.append(self.known_sizes, own[short])
            self.known_ids = np.append(self.known_ids, ids[np.repeat(short, own)])
            self.met = np.append(self.met, np.zeros(int(short.sum()), bool))
        total = sum(map(len, parts))
        for n in np.flatnonzero(apart).tolist():
            parts.append(np.array(self.ids([texts[n].decode()])[0], "<u4"))
            sizes[missing[n]], begins[missing[n]] = len(parts[-1]), total
            total += len(parts[-1])
        return begins, sizes, np.concatenate(parts)

    def drop(self):
        """Keep the held words that were met again, at most a generation."""
        kept = self.met & (np.cumsum(self.met) <= GENERATION)
        self.known_ids = self.known_ids[np.repeat(kept, self.known_sizes)]
        self.known, self.known_sizes = self.known.filter(pa.array(kept)), self.known_sizes[kept]
        self.met = np.zeros(len(self.known), bool)

    def trim(self):
        """At the end of a task: one generation stays, as workers may wait long for the next task."""
        if len(self.known) > GENERATION:
            self.drop()
        give_back()

    def cut(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, set[bytes]]:
        """The texts' bytes, where their words start, and the texts that must be encoded whole."""
        ends = np.fromiter(accumulate(map(len, texts)), np.int64, len(texts))
        begins = np.concatenate([[0], ends[:-1]])
        data = np.frombuffer(b"".join(texts), np.uint8)
        odd = np.zeros(len(texts), bool)
        if self.by_bytes:
            bad = ~_PLAIN[data]
            lead = np.flatnonzero(data[:-1] == 0xC3)
            bad[lead[np.isin(data[lead + 1], _SIGNS)]] = True
            odd[np.searchsorted(ends, np.flatnonzero(bad), side="right")] = True
            start = plain_starts(data, begins[begins < ends])
        else:
            odd[:] = True
            start = np.zeros(len(data), bool)
        whole = set()
        for at, text in enumerate(texts):
            if text and (odd[at] or any(mark in text for mark in self.marks)):
                start[begins[at] : ends[at]] = False
                start[begins[at]] = True
                if self.whole(read := text.decode()):
                    whole.add(text)
                else:
                    lengths = [len(word.encode()) for word in self.split(read)]
                    start[begins[at] + np.cumsum(lengths[:-1], dtype=np.int64)] = True
        return data, np.flatnonzero(start), whole

    def encode(self, texts: list[str], end_id: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.encode_utf8([text.encode() for text in texts], end_id)

    def encode_utf8(self, texts: list[bytes], end_id: int, stops: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts with their end ids, the number of ids of each text, and the places behind sentence ends (none
        without ``stops``)."""
        data, starts, whole = self.cut(texts)
        offsets = pa.array(np.append(starts, len(data)), pa.int64())
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, offsets.buffers()[1], pa.py_buffer(data)])
        numbered = words.dictionary_encode()
        codes, distinct = numbered.indices.to_numpy(), numbered.dictionary
        begins, lengths, pool = self.coded(distinct, whole)
        begins, pool = np.append(begins, len(pool)), np.append(pool, np.uint32(end_id)).astype("<u4", copy=False)
        # Texts end with a word of their own, the end id, numbered behind the others.
        word_ends = np.searchsorted(starts, np.fromiter(accumulate(map(len, texts)), np.int64, len(texts)))
        codes = np.insert(codes.astype(np.int64), word_ends, len(lengths))
        lengths = np.append(lengths, 1)
        per_word = lengths[codes]
        ends = np.cumsum(per_word)
        shifts = (begins[codes] - (ends - per_word)).astype(np.int32)
        ids = pool[np.repeat(shifts, per_word) + np.arange(ends[-1] if len(ends) else 0, dtype=np.int32)]
        last = word_ends + np.arange(len(texts))
        totals = np.diff(ends[last], prepend=0)
        if not stops:
            return ids, totals, np.zeros(0, np.int64)
        marks = pc.or_(pc.match_substring(distinct, "\n"), pc.match_substring_regex(distinct, r"[.!?]\z"))
        marks = np.append(marks.to_numpy(zero_copy_only=False).astype(bool), False)
        return ids, totals, ends[marks[codes]]


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder_of(path: str, pattern: str) -> Encoder:
    """The encoder of a Python worker, kept with its cache from task to task."""
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = Encoder(path, pattern)
    return _encoders[path, pattern]
