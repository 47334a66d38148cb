"""Licence scans with a positional rare-token index.

Words are maximal runs of ASCII letters and digits and of any non-ASCII characters, lower-cased (A-Z).  Every
licence template is a short notice with key phrases that must occur.  How many documents hold each template word is
counted over the whole corpus; a template's words of highest inverse document frequency enter the index as (template,
position).  A file's words are looked up there: each hit says at which word the notice would start.  Hits of one
template whose starts agree are intersected; where enough different anchors agree, the words around are compared with
the template and the key phrases are searched, word by word.  A notice counts if all its key phrases stand there and
at least ``COVERAGE`` of its words do.

The index finds every notice that words were taken out of.  At most ``lost`` words can be gone of one that counts, so
``lost + AGREEING`` anchors leave ``AGREEING`` of them standing, or ``lost`` less than all where a template has fewer
different words; and their starts differ by ``lost`` at most, to which ``SLACK`` adds room for words put in.

Base labels are independent of this: every place where the words of a base phrase stand one after another.  A file's
score is the best share of template words found in a notice that counts, at least ``BASE_SCORE`` where a base phrase
stands, else 0.

Defined results: a null or empty text has no words and no labels (empty strings, null places, score 0); repeated
rows are judged alike; equal frequencies are ranked by word; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbline.llm.common import blocks, per_text

# Labels, phrases and the wording of common licence notices.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
TEMPLATES = [
    ("mit", "Released under the MIT License", ["mit license"]),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files, to deal in the Software without restriction, including without limitation the rights to"
        " use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        ["permission is hereby granted", "without restriction"],
    ),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0", ["apache license version 2 0"]),
    (
        "gpl-3.0",
        "This work is licensed under the GNU General Public License, version 3",
        ["gnu general public license version 3"],
    ),
    (
        "gpl-2.0",
        "This work is licensed under the GNU General Public License, version 2",
        ["gnu general public license version 2"],
    ),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation",
        ["gnu general public license", "free software foundation"],
    ),
    (
        "lgpl",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser"
        " General Public License as published by the Free Software Foundation",
        ["gnu lesser general public license"],
    ),
    (
        "agpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero"
        " General Public License as published by the Free Software Foundation",
        ["gnu affero general public license"],
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met",
        ["redistribution and use in source and binary forms", "following conditions"],
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        ["permission to use copy modify", "without fee"],
    ),
    (
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        ["mozilla public license v 2 0"],
    ),
    ("mpl-2.0", "Mozilla Public License Version 2.0", ["mozilla public license version 2 0"]),
    ("gpl-3.0", "GNU General Public License Version 3, 29 June 2007", ["gnu general public license version 3"]),
    ("gpl-2.0", "GNU General Public License Version 2, June 1991", ["gnu general public license version 2"]),
    ("lgpl", "GNU Lesser General Public License Version 2.1, February 1999", ["gnu lesser general public license version"]),
    ("agpl", "GNU Affero General Public License Version 3, 19 November 2007", ["gnu affero general public license version 3"]),
    ("apache-2.0", "Apache License Version 2.0, January 2004", ["apache license version 2 0"]),
    ("epl", "Eclipse Public License v 2.0", ["eclipse public license"]),
    ("bsl-1.0", "Boost Software License Version 1.0", ["boost software license"]),
    ("mit", "SPDX-License-Identifier: MIT", ["spdx license identifier mit"]),
    ("apache-2.0", "SPDX-License-Identifier: Apache-2.0", ["spdx license identifier apache 2 0"]),
    ("gpl-2.0", "SPDX-License-Identifier: GPL-2.0", ["spdx license identifier gpl 2 0"]),
    ("gpl-3.0", "SPDX-License-Identifier: GPL-3.0", ["spdx license identifier gpl 3 0"]),
    ("bsd", "SPDX-License-Identifier: BSD-3-Clause", ["spdx license identifier bsd"]),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", ["cc by nc"]),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0", ["cc by sa"]),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0", ["cc by nd"]),
    (
        "cc-by",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        ["creative commons attribution"],
    ),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain",
        ["unencumbered software", "public domain"],
    ),
]

AGREEING = 4
SLACK = 3
COVERAGE = 0.6
BASE_SCORE = 0.5

_TO_WORDS = bytes(
    byte + 32 if 0x41 <= byte <= 0x5A else byte if 0x30 <= byte <= 0x39 or 0x61 <= byte <= 0x7A or byte >= 0x80 else 0x20
    for byte in range(256)
)
_BASE = re.compile(b"(?<= )(?:" + b"|".join(phrase.encode() for phrase in BASE_PHRASES) + b")(?= )")
_MAY_BE_BASE = re.compile(b"|".join(sorted({phrase.split()[0].encode() + b" +" + phrase.split()[1].encode() for phrase in BASE_PHRASES})))

FOUND = T.StructType(
    [T.StructField(name, T.LongType()) for name in ("n_words", "n_base", "first_word", "last_word")]
    + [T.StructField("base_labels", T.ArrayType(T.StringType())), T.StructField("notice_labels", T.ArrayType(T.StringType())), T.StructField("score", T.DoubleType())]
)
_ARROW = pa.struct(
    [(name, pa.int64()) for name in ("n_words", "n_base", "first_word", "last_word")]
    + [("base_labels", pa.list_(pa.string())), ("notice_labels", pa.list_(pa.string())), ("score", pa.float64())]
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TO_WORDS).split()


@dataclass
class Template:
    label: str
    words: list[bytes]
    phrases: list[bytes]


def templates() -> list[Template]:
    return [Template(label, words_of(text.encode()), [phrase.encode() for phrase in phrases]) for label, text, phrases in TEMPLATES]


class Index:
    """Postings of each template's rarest words, given in how many of ``documents`` every word occurs."""

    def __init__(self, known: list[Template], held_by: dict[bytes, int], documents: int):
        self.known = known
        self.postings: dict[bytes, list[tuple[int, int]]] = {}
        self.needed: list[int] = []
        self.slack: list[int] = []
        for number, template in enumerate(known):
            rank = sorted(set(template.words), key=lambda word: (-math.log((documents + 1) / (held_by.get(word, 0) + 1)), word))
            lost = len(template.words) - math.ceil(COVERAGE * len(template.words))
            anchors = set(rank[: lost + AGREEING])
            self.needed.append(max(1, len(anchors) - lost))
            self.slack.append(lost + SLACK)
            for place, word in enumerate(template.words):
                if word in anchors:
                    self.postings.setdefault(word, []).append((number, place))
        self.anchors = frozenset(self.postings)

    def notices(self, words: list[bytes]) -> dict[str, float]:
        """Labels of the notices in a file, with the best share of template words found."""
        held: Counter[int] = Counter()
        for word in self.anchors.intersection(words):
            held.update({number for number, _ in self.postings[word]})
        likely = {number for number, count in held.items() if count >= self.needed[number]}
        if not likely:
            return {}
        joined = b" " + b" ".join(words) + b" "
        likely = {number for number in likely if all(b" " + phrase + b" " in joined for phrase in self.known[number].phrases)}
        postings = {
            word: own
            for word in self.anchors
            if (own := [posting for posting in self.postings[word] if posting[0] in likely])
        }
        starts: dict[int, list[tuple[int, bytes]]] = {}
        for at, word in enumerate(words) if postings else ():
            if word in postings:
                for number, place in postings[word]:
                    starts.setdefault(number, []).append((at - place, word))
        out: dict[str, float] = {}
        for number, hits in starts.items():
            template = self.known[number]
            for low, high in self._agreeing(sorted(hits), self.needed[number], self.slack[number]):
                share = self._share(template, words[max(0, low) : high + len(template.words)])
                if share >= COVERAGE:
                    out[template.label] = max(share, out.get(template.label, 0.0))
        return out

    @staticmethod
    def _agreeing(hits: list[tuple[int, bytes]], needed: int, slack: int) -> set[tuple[int, int]]:
        """Ranges of starts, at most ``slack`` wide, on which enough different anchors agree."""
        found, left = set(), 0
        inside: Counter[bytes] = Counter()
        for start, word in hits:
            inside[word] += 1
            while hits[left][0] < start - slack:
                gone = hits[left][1]
                inside[gone] -= 1
                if not inside[gone]:
                    del inside[gone]
                left += 1
            if len(inside) >= needed:
                found.add((hits[left][0], start))
        return found

    @staticmethod
    def _share(template: Template, near: list[bytes]) -> float:
        """Share of the template's words among those near, 0 unless all key phrases stand there."""
        joined = b" " + b" ".join(near) + b" "
        if not all(b" " + phrase + b" " in joined for phrase in template.phrases):
            return 0.0
        have, want = Counter(near), Counter(template.words)
        return sum(min(have[word], count) for word, count in want.items()) / len(template.words)


def word_counts(docs: DataFrame, vocabulary: set[bytes]) -> tuple[dict[bytes, int], int]:
    """In how many texts each word of a given vocabulary occurs, and how many texts there are."""

    def count(batches):
        held: Counter[bytes] = Counter()
        for _, texts in blocks(batches, "text"):
            for text in texts:
                held.update(vocabulary.intersection(words_of(text)))
            held[b""] += len(texts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "n"]
        )

    sums = docs.select(F.col("text")).mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = {bytes(row["word"]): row["n"] for row in sums.collect()}  # bounded by the vocabulary
    return found, found.pop(b"", 0)


def found_in(texts: list[bytes], index: Index) -> pa.StructArray:
    rows = []
    for text in texts:
        plain = text.translate(_TO_WORDS)
        words = plain.split()
        places, labels = [], set()
        if _MAY_BE_BASE.search(plain):
            joined = b" " + b" ".join(words) + b" "
            done = at = 0
            for hit in _BASE.finditer(joined):
                at += joined.count(b" ", done, hit.start())
                done = hit.start()
                places.append(at - 1)
                labels.add(BASE_PHRASES[hit[0].decode()])
        notices = {} if index.anchors.isdisjoint(words) else index.notices(words)
        rows.append(
            {
                "n_words": len(words),
                "n_base": len(places),
                "first_word": places[0] if places else None,
                "last_word": places[-1] if places else None,
                "base_labels": sorted(labels),
                "notice_labels": sorted(notices),
                "score": max([*notices.values(), BASE_SCORE if places else 0.0]),
            }
        )
    return pa.array(rows, _ARROW)


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id`` and what was found, for every row of ``docs``; labels as arrays."""
    known = templates()
    index = Index(known, *word_counts(docs, {word for template in known for word in template.words}))
    shared = SparkSession.getActiveSession().sparkContext.broadcast(index)
    found = per_text(lambda texts: found_in(texts, shared.value), FOUND)(F.col("text"))
    return docs.select(F.col("doc_id"), found.alias("f")).select("doc_id", "f.*")
