"""Alignment of two tokenizers against all pairs of token occurrences, encoded one text at a time."""

from __future__ import annotations

import bisect
import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import tokenizers

from pedalflow.llm import alignment
from pedalflow.llm.queries import BYTE_VOCABULARY, VOCABULARY, op12_tokenizer_alignment

LETTERS = alignment._byte_alphabet()
A_PATH, B_PATH = public_tokenizers.path(BYTE_VOCABULARY), public_tokenizers.path(VOCABULARY)


@pytest.fixture(scope="module")
def encoders():
    a = tokenizers.Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    return a, b


def b_bytes(piece):
    return bytes([int(piece[3:5], 16)]) if piece.startswith("<0x") and len(piece) == 6 else piece.replace("▁", " ").encode()


def tokens_of(encoders, text):
    """``(ids with byte ends)`` of both, or none where they do not spell the text."""
    a, b = encoders
    if not text:
        return [], []
    spaced = " " + text
    encoding = a.encode(spaced, add_special_tokens=False)
    raw = [bytes(LETTERS[c] for c in a.id_to_token(i)) for i in encoding.ids]
    ids = b.encode(text)
    other = [b_bytes(b.id_to_piece(i)) for i in ids]
    if b"".join(raw) != spaced.encode() or b"".join(other) != spaced.encode():
        return [], []
    found = []
    for numbers, parts in ((encoding.ids, raw), (ids, other)):
        end, ends = 0, []
        for i, part in zip(numbers, parts):
            end += len(part)
            ends.append((i, end))
        found.append(ends)
    return tuple(found)


def by_hand(encoders, docs):
    groups = []
    for _, text in docs:
        a, b = tokens_of(encoders, text)
        shared = sorted({e for _, e in a} & {e for _, e in b})
        cut = [([], []) for _ in shared]
        for side, tokens in enumerate((a, b)):
            for i, end in tokens:
                cut[bisect.bisect_left(shared, end)][side].append(i)
        groups.append((len(a), len(b), cut))
    counts = Counter()
    for _, _, cut in groups:
        counts.update({(x, y) for xs, ys in cut for x in xs for y in ys})
    most = {}
    for (x, _), n in counts.items():
        most[x] = max(most.get(x, 0), n)
    rows = []
    for (doc_id, _), (n_a, n_b, cut) in zip(docs, groups):
        links = [(x, y) for xs, ys in cut for x in xs for y in ys]
        text = ";".join(f"{','.join(map(str, xs))}|{','.join(map(str, ys))}" for xs, ys in cut)
        sha = hashlib.sha256(text.encode()).hexdigest() if n_a else ""
        best = sum(counts[link] == most[link[0]] for link in links)
        rows.append((doc_id, n_a, n_b, len(cut), len(links), best, sum(counts[link] for link in links), sha))
    return sorted(rows, key=repr)


def answer(df):
    return sorted(map(tuple, df.collect()), key=repr)


ODD = [
    "", None, " ", "   ", "\t\n x", "a" * 500, "▁▁ a ▁b", " " * 100 + "x", "日本語 𝒳 😀😀", "<s></s><0x0A><unk> <|endoftext|>", "aaaa  bbb", "  é ",
    "x y z " * 200, "don't we'll  they've", "tabs\tand\nlines \r\n", "1234567 89.0", "\x00\x01 control", "naïve café ﬁ ½", "end ",
]


def test_odd_texts(spark, encoders):
    docs = list(enumerate(ODD))
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert answer(alignment.align(df, A_PATH, B_PATH)) == by_hand(encoders, docs)


def test_given_documents(spark, encoders, documents):
    docs = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert answer(op12_tokenizer_alignment(spark, "/root/testdata/sf0.001")) == by_hand(encoders, docs)


@pytest.mark.parametrize("chunk_bytes", [1, 5_000])
def test_chunks_change_nothing(spark, documents, chunk_bytes):
    some = documents.limit(60)
    assert answer(alignment.align(some, A_PATH, B_PATH, chunk_bytes=chunk_bytes)) == answer(alignment.align(some, A_PATH, B_PATH))


def test_pieces_have_the_same_tokens(encoders):
    text = "words of many kinds, don't  stop\n" * 40 + "é日本 x y 12 a b "
    tokens = alignment.both(A_PATH, B_PATH)
    pieces, at = alignment.pieces_of([text.encode(), b"a b"])
    pieces = pieces.to_pylist()
    assert b"".join(pieces) == f" {text} a b".encode() and at.tolist() == [0, len(pieces) - 2, len(pieces)]
    plain = dict(zip(pieces, alignment._shapes(pa.array(pieces, pa.large_binary()))[1].tolist()))
    assert any(plain.values()) and not all(plain.values())
    for one_by_one in (True, False):
        ordered = pieces[:-2] if one_by_one else sorted(pieces[:-2], key=lambda p: not plain[p])
        n_plain = 0 if one_by_one else sum(plain[p] for p in ordered)
        a, a_at, b, b_at = tokens.encode(ordered, n_plain)
        of = {p: (a[a_at[i] : a_at[i + 1]].tolist(), b[b_at[i] : b_at[i + 1]].tolist()) for i, p in enumerate(ordered)}
        assert [i for p in pieces[:-2] for i in of[p][0]] == encoders[0].encode(" " + text, add_special_tokens=False).ids
        assert [i for p in pieces[:-2] for i in of[p][1]] == encoders[1].encode(text)


def test_pieces_are_cut_between_graphic_characters(encoders):
    """Sentences are not pieces of their own, which are new nearly always; every cut is where both tokenizers start a token."""
    assert alignment.pieces_of([b"one. Two, (3) 4's x\n y  z"])[0].to_pylist() == [b" one.", b" Two,", b" (3)", b" 4's", b" x\n y  z"]
    graphic = [chr(c) for c in range(0x21, 0x7F)]
    tokens = alignment.both(A_PATH, B_PATH)
    for x in graphic:
        text = " ".join(f"{y}{x} {x}{y}a {y}1{x}" for y in graphic)
        pieces = alignment.pieces_of([text.encode()])[0].to_pylist()
        assert len(pieces) == 3 * len(graphic)
        a, _, b, _ = tokens.encode(pieces)
        assert a.tolist() == encoders[0].encode(" " + text, add_special_tokens=False).ids and b.tolist() == encoders[1].encode(text)


def test_a_whole_piece_that_stands_inside_another(spark, encoders):
    """Its window has two numbers; counts and digests do not tell them apart."""
    docs = [(1, "the river\t the end"), (2, "the the river"), (3, "rose\t the the"), (4, "the"), (5, "\t the")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert answer(alignment.align(df, A_PATH, B_PATH)) == by_hand(encoders, docs)


@pytest.mark.parametrize("pieces,links", [(1, 1 << 16), (300_000, 3), (1, 1)])
def test_what_is_remembered_changes_nothing(encoders, monkeypatch, pieces, links):
    monkeypatch.setattr(alignment, "KNOWN_PIECES", pieces)
    monkeypatch.setattr(alignment, "MANY_LINKS", links)
    monkeypatch.setattr(alignment, "ENCODE_BYTES", 64)
    texts = [t for t in ODD if t] + ["the river rose", "a river"]
    aligned = alignment.Aligned(alignment.both(A_PATH, B_PATH))
    for begin in range(0, len(texts), 4):
        chunk = alignment._Chunk(aligned, True)
        some = texts[begin : begin + 4]
        chunk.add(list(range(len(some))), [t.encode() for t in some])
        for row, text, (windows, times) in zip(chunk.docs, some, chunk.windows):
            expected = by_hand(encoders, [(row[0], text)])[0]
            assert (*row[:5], row[5]) == (*expected[:5], expected[7])
            flat, sizes = aligned.pairs.of(windows)
            counts, _ = aligned.times.of(windows)
            a, b = tokens_of(encoders, text)
            shared = sorted({e for _, e in a} & {e for _, e in b})
            links_by_hand = Counter()
            for low, high in zip([0, *shared], shared):
                links_by_hand.update((x << 32) + y for x, e in a if low < e <= high for y, f in b if low < f <= high)
            found = Counter()
            for pair, n, t in zip(flat.tolist(), counts.tolist(), np.repeat(times, sizes).tolist()):
                found[pair] += n * t
            assert found == links_by_hand


def test_long_texts(spark, encoders):
    """A long text with spaces, and one that has no place to be cut."""
    docs = [(1, "the river rose in the night " * 20_000), (2, "the river\nrose"), (3, "x1" * 100_000)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {r.doc_id: r for r in alignment.align(df, A_PATH, B_PATH, keep_groups=True).collect()}
    for doc_id, text in docs:
        a, b = tokens_of(encoders, text)
        shared = {e for _, e in a} & {e for _, e in b}
        assert (got[doc_id].n_a, got[doc_id].n_b, got[doc_id].n_groups) == (len(a), len(b), len(shared))
        assert hashlib.sha256(got[doc_id].groups.encode()).hexdigest() == got[doc_id].groups_sha256


def test_linked_ids(spark, encoders):
    df = spark.createDataFrame([(1, "the river"), (2, "the road"), (3, "the river the river")], "doc_id bigint, text string")
    found = {(r.a, r.b): (r.docs, r.best) for r in alignment.linked_ids(df, A_PATH, B_PATH).collect()}
    the = (encoders[0].encode(" the").ids[0], encoders[1].encode("the")[0])
    assert found[the] == (3, True) and {n for n, _ in found.values()} <= {1, 2, 3}


def test_awkward_rows(spark, encoders, awkward, empty):
    docs = [(r.doc_id, r.text) for r in awkward.collect()]
    for name in ("chunk", "kind", "pairs", "docs", "best", "gaps", "n_a"):
        awkward = awkward.withColumn(name, awkward["n_chars"])
    assert answer(alignment.align(awkward, A_PATH, B_PATH)) == by_hand(encoders, docs)
    assert alignment.align(empty, A_PATH, B_PATH).collect() == []


@pytest.mark.parametrize("windows,times", [([], []), ([0], [1]), ([3, 700], [1, 2]), ([5, 90_000], [1, 70_000]), ([1 << 33], [1 << 40])])
def test_packed_windows_come_back(windows, times):
    back = alignment.unpacked(alignment.packed(np.array(windows, np.int64), np.array(times, np.int64)))
    assert back[0].tolist() == windows and back[1].tolist() == times
