from __future__ import annotations

import random
import re

import pytest

from pedalflow.llm import notices

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def places_by_hand(text):
    w = words(text)
    return sorted(
        (i, label) for phrase, label in notices.PHRASES.items() for k in [phrase.split()] for i in range(len(w)) if w[i : i + len(k)] == k
    )


def edits(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


ODD = [
    "MIT License", "mit\nlicense, the MIT--LICENSE. general Public, license apache", "", "123", "mit", "license mit", "commit license",
    "xémit license", "mit license mit license", "MITLicense", "apache\xa0license", "General  public license general public license",
]


def test_odd_texts():
    buffer = notices.words_of([t.encode() for t in ODD])
    found = [[] for _ in ODD]
    for p in notices.exact_places(buffer):
        found[p.text].append((p.first_word, p.label))
    assert [sorted(f) for f in found] == [places_by_hand(t) for t in ODD]
    assert (buffer.word_offsets[1:] - buffer.word_offsets[:-1]).tolist() == [len(words(t)) for t in ODD]


def test_a_phrase_does_not_go_on_into_the_next_text():
    assert notices.exact_places(notices.words_of([b"mit", b"license", b"general public", b"license"])) == []
    assert notices.fuzzy_places(notices.words_of([b"released under the mit", b"license"])) == []


@pytest.mark.parametrize("seed", range(4))
def test_every_notice_within_its_errors_is_found(seed):
    rng = random.Random(seed)
    texts, expected = [], []
    for phrase, label in notices.NOTICES.items():
        allowed = len(phrase) // notices.CHARS_PER_ERROR
        for errors in range(allowed + 1):
            changed = list(phrase)
            for place in rng.sample([i for i, c in enumerate(phrase) if c != " " and 0 < i < len(phrase) - 1], errors):
                changed[place] = rng.choice(("", "q", changed[place] + "q"))
            text = "".join(changed)
            texts.append(f"one two {text.upper()} three")
            expected.append((label, text, allowed))
            assert edits(text, phrase) <= allowed
    buffer = notices.words_of([t.encode() for t in texts])
    found = {}
    for p in notices.fuzzy_places(buffer):
        found.setdefault((p.text, p.label), p)
    for i, (label, text, allowed) in enumerate(expected):
        place = found[i, label]
        assert place.errors <= allowed
        assert (place.first_word, place.last_word) == (2, 1 + len(words(text)))
        assert 0 < place.score <= 1 and (place.score == 1) == (place.errors == 0)


def test_too_many_errors_are_not_found():
    far = "realaced undar te mot licance"
    assert notices.fuzzy_places(notices.words_of([far.encode()])) == []


def test_seeds_cover_the_notice():
    for words_, label in notices.NOTICES.items():
        n = notices.notice(words_, label)
        assert len(n.seeds) == n.errors + 1 and b"".join(s for _, s in n.seeds).decode() == words_
        assert all(words_.encode()[a : a + len(s)] == s for a, s in n.seeds)


def test_documents_by_hand(documents, awkward):
    for docs in (documents, awkward):
        got = notices.licenses(docs).collect()
        by_row = sorted((r.doc_id or 0, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got)
        expected = []
        for d in docs.collect():
            found = places_by_hand(d.text)
            starts = [i for i, _ in found]
            labels = ",".join(sorted({label for _, label in found}))
            expected.append((d.doc_id or 0, len(words(d.text)), len(found), min(starts, default=None), max(starts, default=None), labels))
        assert by_row == sorted(expected)
        for r in got:
            assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""}
            assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)


def test_an_empty_table(empty):
    assert notices.licenses(empty).collect() == []


def fuzzy(*texts):
    return [(p.text, p.first_word, p.last_word, p.errors) for p in sorted(notices.fuzzy_places(notices.words_of([t.encode() for t in texts])))]


def test_a_worse_notice_before_a_better_one_is_found():
    assert fuzzy("all rihts reserved all rights reserved") == [(0, 0, 2, 1), (0, 3, 5, 0)]
    assert fuzzy("all rihts reserved", "all rights reserved") == [(0, 0, 2, 1), (1, 0, 2, 0)]
    assert fuzzy("x all rihts reserved", "all rights reserved y") == fuzzy("x all rihts reserved") + [(1, 0, 2, 0)]


def test_a_text_that_repeats_a_notice():
    rng = random.Random(5)
    forms = {"licensed under cc by": 0, "licensd under cc by": 1, "licensd undr cc by": 2}
    drawn = [rng.choice(list(forms)) for _ in range(300)]
    assert [(first, errors) for _, first, _, errors in fuzzy(" ".join(drawn))] == [(4 * i, forms[d]) for i, d in enumerate(drawn)]
