"""Token counts, encoding and decoding against the vocabulary's own library."""

from __future__ import annotations

import time

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from pedalflow.llm import lattice, pieces
from pedalflow.llm.queries import VOCABULARY

PATH = public_tokenizers.path(VOCABULARY)
ODD = [
    "", " ", "   ", "\t\n x", "a" * 500, "▁▁ a ▁b", " " * 100 + "x", "日本語 𝒳 😀😀", "<s></s><0x0A><unk>", "aaaa bbb", "  é",
    "x" * 5 + "▁" * 20, "abab" * 300, "".join(chr(32 + (i * 7919) % 90) for i in range(2000)), "https://a.example/?x=1#y",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def encode(texts):
    ids, offsets = lattice.encoder(PATH).encode([t.encode() for t in texts])
    return [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]


def test_odd_texts(library):
    expected = library.encode(ODD)
    assert pieces.count_tokens(pieces.vocabulary(PATH), [t.encode() for t in ODD]).tolist() == [len(e) for e in expected]
    assert encode(ODD) == expected


LONG_TEXTS = [
    " " * 1000, "x" + " " * 777 + "y", "a" * 999, "ab" * 700, "the" * 500, "thequickbrownfox" * 100, "▁a" * 400, "=" * 1234, "-=" * 600, "é日" * 300,
    "".join("theriveroseinthenightandbymorning"[(i * i) % 33] for i in range(3000)), "\t" * 800, "0123456789" * 90,
]


def test_texts_without_a_break(library):
    """Sequences beyond ``LONG`` symbols, merged from a heap."""
    expected = [len(e) for e in library.encode(LONG_TEXTS)]
    assert pieces.count_tokens(pieces.vocabulary(PATH), [t.encode() for t in LONG_TEXTS]).tolist() == expected


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from(" ▁abetinorsh.=0é日"), max_size=30), max_size=4))
def test_the_heap_and_the_rounds_agree(texts):
    vocab = pieces.vocabulary(PATH)
    symbols, offsets = pieces.to_symbols(vocab, [t.encode() for t in texts if t])
    merged, ends = pieces.merge(vocab, symbols, offsets)
    for i in range(len(offsets) - 1):
        assert pieces.merge_one(vocab, symbols[offsets[i] : offsets[i + 1]]).tolist() == merged[ends[i] : ends[i + 1]].tolist()


@pytest.mark.parametrize("text", [" " * 1_000_000, "a" * 300_000, "thequickbrownfox" * 20_000], ids=["spaces", "letters", "words"])
def test_a_megabyte_without_a_break_takes_seconds(library, text):
    begun = time.process_time()
    counts = pieces.count_tokens(pieces.vocabulary(PATH), [text.encode()])
    assert time.process_time() - begun < 30
    assert counts.tolist() == [len(library.encode(text))]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from(" ▁abetinorsh.,\n0é日𝒳"), max_size=40), max_size=4))
def test_any_text(texts):
    expected = sentencepiece.SentencePieceProcessor(model_file=PATH).encode(texts) if texts else []
    assert encode(texts) == expected
    assert pieces.count_tokens(pieces.vocabulary(PATH), [t.encode() for t in texts]).tolist() == [len(e) for e in expected]


def test_what_is_remembered_does_not_change_the_result(monkeypatch, library):
    monkeypatch.setattr(lattice, "KNOWN_PRETOKENS", 20)
    monkeypatch.setattr(lattice, "KNOWN_PAIRS", 50)
    monkeypatch.setattr(pieces, "KNOWN_PRETOKENS", 20)
    encoder, known = lattice.Encoder(PATH), {}
    for text in ["the river rose in the night", "by morning the lower road was gone", "the river was gone"] * 2:
        ids, _ = encoder.encode([text.encode()])
        assert ids.tolist() == library.encode(text)
        assert pieces.count_tokens(pieces.vocabulary(PATH), [text.encode()], known).tolist() == [len(ids)]


def test_counts_of_the_documents(documents, library):
    got = {r.doc_id: r for r in pieces.token_counts(documents, PATH).collect()}
    for doc in documents.collect():
        n = len(library.encode(doc.text))
        assert (got[doc.doc_id].n_tokens, got[doc.doc_id].n_bytes) == (n, len(doc.text.encode()))
        assert got[doc.doc_id].over_limit == (n > 4096)


def test_ids_of_the_documents_and_back(documents, library):
    encoded = lattice.encode(documents, PATH)
    texts = {d.doc_id: d.text for d in documents.collect()}
    for r in encoded.collect():
        assert r.token_ids == library.encode(texts[r.doc_id]) and r.n_tokens == len(r.token_ids) and r.round_trip
    assert {r.doc_id: r.text for r in lattice.decode(encoded, PATH).collect()} == texts


def test_awkward_rows(awkward, empty, library):
    counts = pieces.token_counts(awkward, PATH).collect()
    encoded = lattice.encode(awkward, PATH).collect()
    texts = sorted((r.doc_id or 0, r.text or "") for r in awkward.collect())
    assert sorted((r.doc_id or 0, r.n_tokens) for r in counts) == sorted((i, len(library.encode(t))) for i, t in texts)
    assert sorted((r.doc_id or 0, r.token_ids) for r in encoded) == sorted((i, library.encode(t)) for i, t in texts)
    # The space mark itself comes back as a space.
    assert [r.doc_id for r in encoded if not r.round_trip] == [11]
    for operator in (pieces.token_counts, lattice.encode):
        assert operator(empty, PATH).collect() == []
    none = empty.sparkSession.createDataFrame([(1, None), (2, [])], "doc_id bigint, token_ids array<int>")
    assert [r.text for r in lattice.decode(none, PATH).collect()] == ["", ""]


def test_a_vocabulary_that_changes_the_text_is_refused(monkeypatch):
    class Other:
        def __init__(self, model_file):
            pass

        def normalize(self, text):
            return text.strip()

    monkeypatch.setattr(pieces.sentencepiece, "SentencePieceProcessor", Other)
    with pytest.raises(ValueError, match="keep the text"):
        pieces.Vocabulary(PATH)
