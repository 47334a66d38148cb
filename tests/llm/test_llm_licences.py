import random
import re
from collections import Counter

from cases import lower, no_documents, odd_documents, odd_rows
from conftest import SMALL
from ebbline.llm import licences
from ebbline.llm.queries import op8_licences

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    words = WORD.findall(lower(text))
    places, labels = [], set()
    for at in range(len(words)):
        for phrase, label in licences.BASE_PHRASES.items():
            own = phrase.split()
            if words[at : at + len(own)] == own:
                places.append(at)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), sorted(labels)


def base(row):
    return row.n_words, row.n_base, row.first_word, row.last_word, list(row.base_labels)


def scan(spark, texts):
    rows = licences.scan(odd_documents(spark, list(enumerate(texts)))).orderBy("doc_id").collect()
    return [(list(row.notice_labels), row.score) for row in rows]


def test_base_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {row.doc_id: row.text for row in docs.collect()}
    assert all(base(row) == brute(texts[row.doc_id]) for row in licences.scan(docs).collect())
    found = op8_licences(spark, SMALL)
    assert found.count() == len(texts)
    assert found.where("n_base > 0 AND labels = base_labels AND labels <> 'mit'").count() == 0


def test_odd_rows_and_empty_table(spark):
    found = Counter((row.doc_id, str(base(row))) for row in licences.scan(odd_documents(spark)).collect())
    assert found == Counter((doc_id, str(brute(text))) for doc_id, text in odd_rows())
    assert licences.scan(no_documents(spark)).count() == 0


def test_places_of_phrases(spark):
    text = "MIT license, mit LICENSE; cc-by and cc by gnu general public mit licenseé"
    (row,) = licences.scan(odd_documents(spark, [(1, text)])).collect()
    assert base(row) == brute(text) and row.n_base == 4


def test_every_template_finds_itself_inside_a_text(spark):
    filler = "lorem ipsum dolor sit amet consectetur " * 20
    texts = [f"{filler}{wording}. {filler}" for _, wording, _ in licences.TEMPLATES]
    for (label, _, _), (labels, score) in zip(licences.TEMPLATES, scan(spark, texts)):
        assert label in labels and score == 1.0


def test_small_changes_pass_but_key_phrases_must_stand(spark):
    _, wording, _ = next(t for t in licences.TEMPLATES if t[0] == "bsd")
    changed = wording.replace("with or without modification", "with or with no modification")
    broken = wording.replace("following conditions", "conditions that follow")
    scattered = " filler ".join(wording.split())
    (near, score), (no_phrase, _), (far, _) = scan(spark, [changed, broken, scattered])
    assert near == ["bsd"] and licences.COVERAGE <= score < 1
    assert no_phrase == [] and far == []


def test_a_base_phrase_alone_has_the_base_score(spark):
    ((labels, score),) = scan(spark, ["my cc by is not yours and the apache license is not mine"])
    assert labels == [] and score == licences.BASE_SCORE


def is_notice(template, words):
    """By every window of words, whether it holds the key phrases and enough of the template's words."""
    for at in range(len(words)):
        near = words[at : at + len(template.words)]
        joined = b" " + b" ".join(near) + b" "
        have, want = Counter(near), Counter(template.words)
        share = sum(min(have[word], n) for word, n in want.items()) / len(template.words)
        if share >= licences.COVERAGE and all(b" " + phrase + b" " in joined for phrase in template.phrases):
            return True
    return False


def test_every_notice_that_words_were_taken_out_of_is_found():
    rng = random.Random(8)
    known = licences.templates()
    every = {word for template in known for word in template.words}
    index = licences.Index(known, {word: rng.randrange(1, 900) for word in sorted(every)}, 1000)
    filler = [b"lorem", b"the", b"of", b"software", b"to", b"license", b"x"]
    tried = Counter()
    for template in known * 60:
        kept = [word for word in template.words if rng.random() > 0.3]
        around = [rng.choice(filler) for _ in range(80)]
        words = around[:40] + kept + around[40:]
        if is_notice(template, words):
            tried[template.label] += 1
            assert template.label in index.notices(words), (template.label, b" ".join(kept))
    assert {label for label, n in tried.items() if n >= 5} >= {"mit", "bsd", "gpl", "agpl", "isc", "cc-by"}


def test_titles_and_identifiers_are_notices(spark):
    texts = [
        "GNU GENERAL PUBLIC LICENSE\n Version 3, 29 June 2007\n\n Copyright", "Mozilla Public License Version 2.0\n====",
        "GNU LESSER GENERAL PUBLIC LICENSE\nVersion 2.1, February 1999", "Eclipse Public License - v 2.0",
        "Boost Software License - Version 1.0 - August 17th, 2003", "// SPDX-License-Identifier: Apache-2.0\nint x;",
    ]
    labels = [own for own, _ in scan(spark, texts)]
    assert labels == [["gpl-3.0"], ["mpl-2.0"], ["lgpl"], ["epl"], ["bsl-1.0"], ["apache-2.0"]]
