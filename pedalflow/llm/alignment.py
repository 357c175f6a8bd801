"""Alignment of two tokenizers' tokens on the same text, by anchors at white space.

A text is encoded whole by both: a byte-level BPE (A), given as a file of the ``tokenizers`` library, on a space and the text, and
a ``sentencepiece`` vocabulary with byte fallback (B), which puts that space itself. The bytes of the tokens must spell the same;
texts for which they do not, and those that are null or empty, have no tokens here. The byte offsets where tokens of
both end cut them into *groups*; every token of A is linked with every token of B in its group.

An *anchor* is an offset where a token of both begins with a space, so where tokens of both end before it (the spelled bytes
verify it). Anchors cut a document into windows of token ids, mostly one word long. A window's alignment follows from
its two id tuples alone, so it is worked out once and remembered by them; a document is the list of its windows.

Corpus counts (in how many documents is a pair of ids linked?) are exact over all documents: each task counts the pairs of a
chunk of documents, chunks are summed by pair in Spark, and the sums come back to the chunks that asked, where they are added up
by window and then by document. What is shuffled are a chunk's different pairs and a document's different windows, not its
links. A text is the row of its pieces, cut before each space between two graphic ASCII characters (letters, digits, punctuation):
both tokenizers always start a token there, so the tokens of the text are those of its pieces, and a piece that was met before is
not encoded again.

Special strings inside texts are plain text. Rows that repeat a doc_id are documents of their own. A null doc_id stays
null. An empty table gives an empty table, and columns besides ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib
import itertools
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pedalflow.llm.arrays import as_bytes, offsets_of, ranges, sums, text_chunks
from pedalflow.llm.scratch import stored
from pedalflow.llm.ship import ship

SLICE_BYTES, ENCODE_BYTES, CHUNK_BYTES = 1 << 20, 1 << 18, 8 << 20
PLAIN_AT_ONCE = 400
KNOWN_PIECES, KNOWN_BYTES = 150_000, 16 << 20  # of text that a worker remembers from one chunk to the next (some 70 MB)
MANY_LINKS = 1 << 16  # of one group; beyond it only different ids are paired
# --- fixed value: how the byte-level vocabulary splits a text before it merges ---
_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# --- end of fixed value ---
_PAIR = 1 << 32  # a pair of ids is one number, a * 2^32 + b
_GRAPHIC = np.array([0x20 < b < 0x7F for b in range(256)])


class Spelling:
    """The bytes of each id of a vocabulary."""

    def __init__(self, tokens: list[bytes]):
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.starts = offsets_of(self.sizes)[:-1]
        self.data = np.frombuffer(b"".join(tokens), np.uint8)
        self.spaced = np.array([t[:1] == b" " for t in tokens])

    def spelled(self, ids: np.ndarray) -> np.ndarray:
        return self.data[ranges(self.starts[ids], self.sizes[ids])]


def _byte_alphabet() -> dict[str, int]:
    """The letter that a byte-level vocabulary writes for each byte: itself if it is printable, else one from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def _ranked(path: str) -> tiktoken.Encoding:
    """The byte-level BPE of a ``tokenizers`` file for the ``tiktoken`` library, which does the same merges several times faster.

    Refused where the file asks for more than byte-level BPE after the usual split, or its ids do not follow its merges.
    """
    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    model, split = described["model"], described["pre_tokenizer"]
    usual = split["type"] == "ByteLevel" and not split["add_prefix_space"] and split.get("use_regex", True)
    merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    ids = [model["vocab"][m] for m in merged]
    if model["type"] != "BPE" or not usual or described["normalizer"] or ids != sorted(ids):
        raise ValueError("only byte-level BPE files whose ids follow their merges are supported")
    letters = _byte_alphabet()
    special = {t["content"] for t in described["added_tokens"]}
    ranks = {bytes(letters[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
    return tiktoken.Encoding("a", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})


class Tokenizers:
    """Both vocabularies; encodes pieces of text and spells their tokens."""

    def __init__(self, a_path: str, b_path: str):
        self.a = _ranked(a_path)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(len(self.b))]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("a piece goes on over a space")
        words: list[bytes] = [b""] * self.a.n_vocab
        for word, i in self.a._mergeable_ranks.items():
            words[i] = word
        self.a_bytes = Spelling(words)
        self.b_bytes = Spelling([bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)])

    def encode(self, pieces: list[bytes], n_plain: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids and offsets of the pieces, which begin with a space, in A, then in B.

        The first ``n_plain`` begin with a space and a graphic character and end in one. Both tokenizers start anew at each, so these are
        encoded as a few texts; where that does not spell them they are encoded one by one, as the others are.
        """
        found = []
        texts = [b"".join(pieces[i : min(i + PLAIN_AT_ONCE, n_plain)]) for i in range(0, n_plain, PLAIN_AT_ONCE)]
        joined = b"".join(texts)
        for spelling, encode in (
            (self.a_bytes, lambda parts: [self.a.encode_ordinary(p.decode()) for p in parts]),
            (self.b_bytes, lambda parts: self.b.encode([p[1:].decode() for p in parts], num_threads=1)),
        ):
            first, begin = (np.zeros(0, np.int64), np.zeros(0, np.int64)), 0
            if n_plain:
                ids = np.array(list(itertools.chain.from_iterable(encode(texts))), np.int64)
                ends, wanted = np.cumsum(spelling.sizes[ids]), np.cumsum([len(p) for p in pieces[:n_plain]])
                at = np.searchsorted(ends, wanted, "right")
                if len(ids) and ends[-1] == wanted[-1] and (ends[at - 1] == wanted).all() and spelling.spelled(ids).tobytes() == joined:
                    first, begin = (ids, np.diff(at, prepend=0)), n_plain
            lists = encode(pieces[begin:])
            sizes = np.array([len(x) for x in lists], np.int64)
            rest = np.fromiter(itertools.chain.from_iterable(lists), np.int64, int(sizes.sum()))
            found += [np.concatenate([first[0], rest]), offsets_of(np.concatenate([first[1], sizes]))]
        return tuple(found)


@lru_cache(maxsize=2)
def both(a_path: str, b_path: str) -> Tokenizers:
    return Tokenizers(a_path, b_path)


def pieces_of(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The texts, with a space before each, cut before every space between two graphic characters; and where each text begins."""
    spaced = [b" " + t for t in texts]
    data = np.frombuffer(b"".join(spaced), np.uint8)
    begins = offsets_of([len(t) for t in spaced])
    cut = np.zeros(len(data), bool)
    graphic = _GRAPHIC[data]
    cut[1:-1] = (data[1:-1] == 32) & graphic[:-2] & graphic[2:]
    cut[begins[:-1]] = True
    starts = np.flatnonzero(cut)
    offsets = np.append(starts, len(data)).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)]), np.searchsorted(starts, begins)


def _shapes(pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of each piece, and whether a graphic character follows its first space and one ends it."""
    offsets = np.frombuffer(pieces.buffers()[1], np.int64)[pieces.offset : pieces.offset + len(pieces) + 1]
    data = np.frombuffer(pieces.buffers()[2], np.uint8)
    sizes = np.diff(offsets)
    second = data[np.minimum(offsets[:-1] + 1, len(data) - 1)]
    return sizes, (sizes > 1) & _GRAPHIC[second] & _GRAPHIC[data[offsets[1:] - 1]]


class _Lists:
    """Lists of numbers, flat."""

    def __init__(self, kind=np.int64):
        self.flat, self.offsets = np.zeros(0, kind), np.zeros(1, np.int64)

    def extend(self, flat: np.ndarray, sizes: np.ndarray) -> None:
        self.flat = np.concatenate([self.flat, flat.astype(self.flat.dtype)])
        self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(sizes)])

    def of(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists at these places, one after the other, and their sizes."""
        sizes = self.offsets[at + 1] - self.offsets[at]
        return self.flat[ranges(self.offsets[at], sizes)], sizes


class Decimals:
    """The ids below a limit as text."""

    def __init__(self, limit: int):
        texts = [str(i).encode() for i in range(limit)]
        self.sizes = np.array([len(t) for t in texts])
        self.starts = offsets_of(self.sizes)[:-1]
        self.data = np.frombuffer(b"".join(texts), np.uint8)

    def joined(self, ids: np.ndarray, separators: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The ids with a separator after each, and where each begins."""
        sizes = self.sizes[ids]
        at = offsets_of(sizes + 1)
        out = np.empty(int(at[-1]), np.uint8)
        out[ranges(at[:-1], sizes)] = self.data[ranges(self.starts[ids], sizes)]
        out[at[1:] - 1] = separators
        return out.tobytes(), at


class Aligned:
    """The pieces of text and the windows of token ids that a worker has met, with what follows from each.

    A window is known by its two id tuples. It has the numbers of its groups and links, its groups as text, and its different
    linked pairs with how often each is linked.
    """

    def __init__(self, tokens: Tokenizers):
        self.tokens = tokens
        self.decimals = Decimals(max(len(tokens.a_bytes.sizes), len(tokens.b_bytes.sizes)))
        self.forget()

    def forget(self) -> None:
        self.piece_number: dict[bytes, int] = {}
        self.held = 0
        self.sound, self.n_a, self.n_b = np.zeros(0, bool), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.windows_of_piece = _Lists(np.int32)
        self.piece_text: list[bytes] = []
        self.window_number: dict[bytes, int] = {}
        self.window_text: list[bytes] = []
        self.groups, self.links = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pairs, self.times = _Lists(), _Lists()

    def full(self) -> bool:
        return len(self.piece_number) > KNOWN_PIECES or self.held > KNOWN_BYTES

    def numbers(self, pieces: pa.Array) -> np.ndarray:
        """The number of each piece; new ones are encoded and aligned."""
        encoded = pieces.dictionary_encode()
        different = encoded.dictionary.to_numpy(zero_copy_only=False).tolist()
        number = np.fromiter(map(self.piece_number.get, different, itertools.repeat(-1)), np.int64, len(different))
        new = np.flatnonzero(number < 0)
        sizes, plain = _shapes(encoded.dictionary)
        new = new[np.argsort(~plain[new], kind="stable")]  # the plain ones first
        number[new] = np.arange(len(self.piece_number), len(self.piece_number) + len(new))
        ends, begin = np.cumsum(sizes[new]), 0
        while begin < len(new):
            before = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + ENCODE_BYTES, "right")))
            part = new[begin:end]
            self._add([different[i] for i in part.tolist()], sizes[part], int(plain[part].sum()))
            begin = end
        return number[encoded.indices.to_numpy(zero_copy_only=False)]

    def _add(self, pieces: list[bytes], lengths: np.ndarray, n_plain: int) -> None:
        """Encode and align pieces, of which the first ``n_plain`` are plain."""
        first = len(self.piece_number)
        self.piece_number.update(zip(pieces, range(first, first + len(pieces))))
        self.held += int(lengths.sum())
        t = self.tokens
        a, a_at, b, b_at = t.encode(pieces, n_plain)
        sound = _spell(pieces, lengths, a, a_at, t.a_bytes) & _spell(pieces, lengths, b, b_at, t.b_bytes)
        n_a, n_b = np.diff(a_at), np.diff(b_at)
        self.sound = np.append(self.sound, sound)
        self.n_a, self.n_b = np.append(self.n_a, n_a), np.append(self.n_b, n_b)
        if not sound.all():
            a, b = a[np.repeat(sound, n_a)], b[np.repeat(sound, n_b)]
        begins = offsets_of(lengths * sound)
        total = int(begins[-1])
        # Offsets where tokens of both end, and those where tokens of both begin with a space.
        a_ends, b_ends = np.cumsum(t.a_bytes.sizes[a]), np.cumsum(t.b_bytes.sizes[b])
        mark = np.zeros(total + 1, np.uint8)
        mark[a_ends] |= 1
        mark[b_ends] |= 2
        mark[(a_ends - t.a_bytes.sizes[a])[t.a_bytes.spaced[a]]] |= 4
        mark[(b_ends - t.b_bytes.sizes[b])[t.b_bytes.spaced[b]]] |= 8
        ends = np.flatnonzero((mark & 3) == 3)
        anchors = np.flatnonzero((mark & 12) == 12)
        a_cut = np.concatenate([[0], np.searchsorted(a_ends, ends) + 1])
        b_cut = np.concatenate([[0], np.searchsorted(b_ends, ends) + 1])
        first_group = np.searchsorted(ends, np.append(anchors, total), "right")
        first_group[-1] = len(ends)
        sizes = np.diff(np.searchsorted(anchors, begins))
        numbers = self._windows(a, b, a_cut, b_cut, first_group, np.repeat(sizes == 1, sizes))
        self.windows_of_piece.extend(numbers, sizes)
        texts = list(map(self.window_text.__getitem__, numbers.tolist()))
        if len(texts) == len(pieces) and (sizes == 1).all():
            self.piece_text += texts
        else:
            cuts = offsets_of(sizes).tolist()
            self.piece_text += [texts[i] if j - i == 1 else b";".join(texts[i:j]) for i, j in zip(cuts, cuts[1:])]

    def _windows(
        self, a: np.ndarray, b: np.ndarray, a_cut: np.ndarray, b_cut: np.ndarray, first_group: np.ndarray, whole: np.ndarray
    ) -> np.ndarray:
        """The number of each window, ``first_group`` the groups that they begin with; new ones are aligned.

        One that is a ``whole`` piece is new, as its piece is, and is not looked up: should it also stand inside another piece it has
        two numbers there, which adds up to the same.
        """
        n, known = len(whole), len(self.groups)
        number = np.empty(n, np.int64)
        seen = np.flatnonzero(whole)  # where each new one stands first
        number[seen] = np.arange(known, known + len(seen))
        inside = np.flatnonzero(~whole)
        if len(inside):
            # The ids of A, a mark, the ids of B: the key of a window.
            a_from, b_from = a_cut[first_group[:-1][inside]], b_cut[first_group[:-1][inside]]
            n_a, n_b = a_cut[first_group[1:][inside]] - a_from, b_cut[first_group[1:][inside]] - b_from
            at = offsets_of(n_a + n_b + 1)
            key = np.full(int(at[-1]), 0xFFFFFFFF, np.uint32)
            key[ranges(at[:-1], n_a)] = a[ranges(a_from, n_a)]
            key[ranges(at[:-1] + n_a + 1, n_b)] = b[ranges(b_from, n_b)]
            column = pa.Array.from_buffers(pa.large_binary(), len(inside), [None, pa.py_buffer(4 * at), pa.py_buffer(key)])
            encoded = column.dictionary_encode()
            different, place = encoded.dictionary.to_numpy(zero_copy_only=False).tolist(), encoded.indices.to_numpy(zero_copy_only=False)
            held = np.fromiter(map(self.window_number.get, different, itertools.repeat(-1)), np.int64, len(different))
            new = np.flatnonzero(held < 0)
            held[new] = np.arange(known + len(seen), known + len(seen) + len(new))
            self.window_number.update(zip(map(different.__getitem__, new.tolist()), held[new].tolist()))
            number[inside] = held[place]
            seen = np.append(seen, inside[np.unique(place, return_index=True)[1][new]])
        if len(seen):
            self._align(a, b, a_cut, b_cut, first_group[seen], first_group[seen + 1])
        return number

    def _align(self, a: np.ndarray, b: np.ndarray, a_cut: np.ndarray, b_cut: np.ndarray, begin: np.ndarray, end: np.ndarray) -> None:
        """Add windows of the groups from ``begin`` to ``end``."""
        n_groups = end - begin
        group = ranges(begin, n_groups)
        owner = np.repeat(np.arange(len(begin)), n_groups)
        a_from, b_from = a_cut[group], b_cut[group]
        n_a, n_b = a_cut[group + 1] - a_from, b_cut[group + 1] - b_from
        n_links = n_a * n_b
        self.groups = np.append(self.groups, n_groups)
        self.links = np.append(self.links, sums(n_links, offsets_of(n_groups)))

        small = np.where(n_links <= MANY_LINKS, n_links, 0)
        at = np.repeat(np.arange(len(group)), small)
        nth = ranges(np.zeros(len(group), np.int64), small)
        pair = a[a_from[at] + nth // n_b[at]] * _PAIR + b[b_from[at] + nth % n_b[at]]
        window, times = owner[at], np.ones(len(at), np.int64)
        for g in np.flatnonzero(n_links > MANY_LINKS).tolist():  # the different ids meet, with how often they do
            xs, x_times = np.unique(a[a_from[g] : a_from[g] + n_a[g]], return_counts=True)
            ys, y_times = np.unique(b[b_from[g] : b_from[g] + n_b[g]], return_counts=True)
            pair = np.append(pair, (xs[:, None] * _PAIR + ys).ravel())
            times = np.append(times, (x_times[:, None] * y_times).ravel())
            window = np.append(window, np.full(len(xs) * len(ys), owner[g]))
        order = np.lexsort((pair, window))
        pair, window, times = pair[order], window[order], times[order]
        first = np.flatnonzero(np.concatenate([[True], (pair[1:] != pair[:-1]) | (window[1:] != window[:-1])]))
        sizes = np.bincount(window[first], minlength=len(begin))
        self.pairs.extend(pair[first], sizes)
        self.times.extend(np.add.reduceat(times, first), sizes)

        # The ids of all groups in a row, with what stands after each.
        item = offsets_of(n_a + n_b)
        ids, after = np.empty(int(item[-1]), np.int64), np.full(int(item[-1]), ord(","), np.uint8)
        ids[ranges(item[:-1], n_a)] = a[ranges(a_from, n_a)]
        ids[ranges(item[:-1] + n_a, n_b)] = b[ranges(b_from, n_b)]
        after[item[:-1] + n_a - 1] = ord("|")
        after[item[1:] - 1] = ord(";")
        text, place = self.decimals.joined(ids, after)
        cuts = place[item[offsets_of(n_groups)]].tolist()
        self.window_text += [text[i : j - 1] for i, j in zip(cuts, cuts[1:])]


def _spell(pieces: list[bytes], want: np.ndarray, ids: np.ndarray, at: np.ndarray, spelling: Spelling) -> np.ndarray:
    """Whether the tokens of each piece, of ``want`` bytes, spell it."""
    have = sums(spelling.sizes[ids], at)
    data, made = np.frombuffer(b"".join(pieces), np.uint8), spelling.spelled(ids)
    if (want == have).all():
        return sums((data != made).astype(np.int64), offsets_of(want)) == 0
    cuts, raw = offsets_of(have).tolist(), made.tobytes()
    return np.array([raw[i:j] == p for i, j, p in zip(cuts, cuts[1:], pieces)])


def _distinct(windows: np.ndarray, cuts: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different windows of each wanted document, in their order, how often each is there, and the offsets of the documents."""
    sizes, base = np.diff(cuts), int(windows.max(initial=0)) + 1
    doc = np.repeat(np.arange(len(sizes)), sizes)
    key = np.sort((doc * base + windows)[np.repeat(wanted, sizes)])
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[: len(key)])
    times = np.diff(np.append(first, len(key)))
    return key[first] % base, times, np.searchsorted(key[first], np.arange(len(cuts)) * base)


_worker: dict[tuple[str, str], Aligned] = {}


def packed(windows: np.ndarray, times: np.ndarray) -> bytes:
    """A document's windows and how often it has each, as bytes: the width of a number, the steps between windows, the times."""
    numbers = np.concatenate([np.diff(windows, prepend=0), times])
    width = 1 if not len(numbers) or numbers.max() < 1 << 8 else 2 if numbers.max() < 1 << 16 else 8
    return bytes([width]) + numbers.astype(f"<u{width}").tobytes()


def unpacked(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    numbers = np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(np.int64)
    return np.cumsum(numbers[: len(numbers) // 2]), numbers[len(numbers) // 2 :]


class _Chunk:
    """Documents whose windows and pairs are counted together."""

    def __init__(self, aligned: Aligned, keep_groups: bool):
        self.aligned, self.keep_groups = aligned, keep_groups
        self.bytes, self.n_docs = 0, 0
        self.docs: list[list] = []
        self.windows: list[np.ndarray] = []
        self.pairs: list[np.ndarray] = []
        if aligned.full():
            aligned.forget()

    def add(self, ids: list, texts: list[bytes]) -> None:
        """All of these documents."""
        self.bytes += sum(map(len, texts))
        self.n_docs += len(texts)
        known = self.aligned
        filled = np.flatnonzero([bool(t) for t in texts])
        pieces, at = pieces_of([texts[i] for i in filled.tolist()]) if len(filled) else (None, None)
        rows = [[i, 0, 0, 0, 0, ""] + [""] * self.keep_groups for i in ids]
        of_doc = [np.zeros(0, np.int64)] * len(ids)
        times_of = [np.zeros(0, np.int64)] * len(ids)
        if pieces is not None:
            number = known.numbers(pieces)
            bad = sums((~known.sound[number]).astype(np.int64), at) > 0
            n_a, n_b = sums(known.n_a[number], at), sums(known.n_b[number], at)
            flat, sizes = known.windows_of_piece.of(number)
            windows = flat.astype(np.int64)
            cuts = offsets_of(sums(sizes, at))
            n_groups, n_links = sums(known.groups[windows], cuts), sums(known.links[windows], cuts)
            flat, times, ends = _distinct(windows, cuts, ~bad)
            for k, i in enumerate(filled.tolist()):
                if bad[k]:
                    continue
                groups = b";".join([known.piece_text[p] for p in number[at[k] : at[k + 1]].tolist()])
                row = [ids[i], int(n_a[k]), int(n_b[k]), int(n_groups[k]), int(n_links[k]), hashlib.sha256(groups).hexdigest()]
                rows[i] = row + [groups.decode()] * self.keep_groups
                of_doc[i], times_of[i] = flat[ends[k] : ends[k + 1]], times[ends[k] : ends[k + 1]]
            self._count(flat, ends)
        self.docs += rows
        self.windows += list(zip(of_doc, times_of))

    def _count(self, windows: np.ndarray, ends: np.ndarray) -> None:
        """Add the documents of each pair, from the different windows of each document."""
        if not len(windows):
            return
        met = np.zeros(len(self.aligned.groups), bool)
        met[windows] = True
        flat, sizes = self.aligned.pairs.of(np.flatnonzero(met))
        pairs, place = np.unique(flat, return_inverse=True)
        which = (np.cumsum(met) - 1)[windows]
        doc = np.repeat(np.repeat(np.arange(len(ends) - 1), np.diff(ends)), sizes[which])
        both = np.sort(doc * len(pairs) + place[ranges(offsets_of(sizes)[which], sizes[which])])
        both = both[np.concatenate([[True], both[1:] != both[:-1]])]
        self.pairs.append(np.stack([pairs, np.bincount(both % len(pairs), minlength=len(pairs))]))
        if len(self.pairs) > 16:
            self.pairs = [self._summed()]

    def _summed(self) -> np.ndarray:
        if not self.pairs:
            return np.zeros((2, 0), np.int64)
        every = np.concatenate(self.pairs, 1)
        pairs, place = np.unique(every[0], return_inverse=True)
        return np.stack([pairs, np.bincount(place, every[1], len(pairs)).astype(np.int64)])

    def rows(self, number: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """The documents, then one row of the chunk's pairs and windows, which are numbered anew."""
        used = np.unique(np.concatenate([w for w, _ in self.windows] or [np.zeros(0, np.int64)]))
        names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"] + ["groups"] * self.keep_groups
        for begin in range(0, len(self.docs), 2000):
            part = [dict(zip(names, row)) for row in self.docs[begin : begin + 2000]]
            for row, (windows, times) in zip(part, self.windows[begin : begin + 2000]):
                row |= {"chunk": number, "windows": packed(np.searchsorted(used, windows), times)}
            yield pa.RecordBatch.from_pylist(part, schema)
        pairs, counted = self._summed()
        flat, sizes = self.aligned.pairs.of(used)
        times, _ = self.aligned.times.of(used)
        row = {"chunk": number, "pairs": pairs, "counted": counted, "sizes": sizes, "places": np.searchsorted(pairs, flat), "linked": times}
        yield pa.RecordBatch.from_pylist([row], schema)


def _aligned_chunks(docs: DataFrame, a_path: str, b_path: str, keep_groups: bool, chunk_bytes: int) -> DataFrame:
    """Rows of documents and rows of chunks (``pairs`` is not null), kept in the shared folder."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (a_path, b_path) not in _worker:
            _worker[a_path, b_path] = Aligned(both(a_path, b_path))
        aligned = _worker[a_path, b_path]
        number, chunk, schema = TaskContext.get().partitionId() << 24, _Chunk(aligned, keep_groups), None
        longs, long = pa.list_(pa.int64()), pa.int64()
        for rows in text_chunks(batches, "text", limit=SLICE_BYTES, rows=2000):
            if schema is None:
                fields = [("chunk", long), ("doc_id", rows.schema.field("doc_id").type)]
                fields += [(c, long) for c in ("n_a", "n_b", "n_groups", "n_links")] + [("groups_sha256", pa.string())]
                fields += [("windows", pa.binary())]
                fields += [("pairs", longs), ("counted", longs), ("sizes", pa.list_(pa.int32())), ("places", pa.list_(pa.int32())), ("linked", longs)]
                schema = pa.schema(fields + [("groups", pa.string())] * keep_groups)
            chunk.add(rows.column("doc_id").to_pylist(), as_bytes(rows.column("text")))
            if chunk.bytes > chunk_bytes:
                yield from chunk.rows(number, schema)
                number, chunk = number + 1, _Chunk(aligned, keep_groups)
        if schema is not None and chunk.n_docs:
            yield from chunk.rows(number, schema)

    columns = (
        f"chunk bigint, doc_id {id_type}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, windows binary, "
        "pairs array<bigint>, counted array<bigint>, sizes array<int>, places array<int>, linked array<bigint>"
    )
    return stored(docs.select("doc_id", "text").mapInArrow(align, columns + ", groups string" * keep_groups), "aligned-documents")


def _pair_counts(chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(chunk, pair)`` and ``(pair, docs, best)``."""
    met = chunks.filter("pairs IS NOT NULL").select("chunk", F.inline(F.arrays_zip("pairs", "counted")))
    counts = met.groupBy(F.col("pairs").alias("pair")).agg(F.sum("counted").alias("docs"))
    of_a = Window.partitionBy(F.shiftright("pair", 32))  # a row for each token of B at most
    best = F.col("docs") == F.max("docs").over(of_a)
    return met.select("chunk", F.col("pairs").alias("pair")), counts.withColumn("best", best)


def linked_ids(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``(a, b, docs, best)``: the pairs of ids that are linked in a document, in how many, and whether that is the most for a."""
    ship(docs.sparkSession)
    counts = _pair_counts(_aligned_chunks(docs, a_path, b_path, False, CHUNK_BYTES))[1]
    return counts.select(
        F.shiftright("pair", 32).cast("int").alias("a"), F.col("pair").bitwiseAND(F.lit(_PAIR - 1)).cast("int").alias("b"), "docs", "best"
    )


def align(docs: DataFrame, a_path: str, b_path: str, keep_groups: bool = False, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` of every row of ``docs``, and with
    ``keep_groups`` the ``groups`` themselves, as ``a1,a2|b1;a3|b2,b3``."""
    ship(docs.sparkSession)
    chunks = _aligned_chunks(docs, a_path, b_path, keep_groups, chunk_bytes)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    met, counts = _pair_counts(chunks)
    known = met.join(counts, "pair").select("chunk", F.lit(1).alias("kind"), "pair", "docs", "best")
    kind = F.when(F.col("pairs").isNotNull(), 0).otherwise(2)
    rows = chunks.withColumn("kind", kind).drop("pairs", "counted").unionByName(known, allowMissingColumns=True)
    together = rows.repartition("chunk").sortWithinPartitions("chunk", "kind", "pair")
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"] + ["groups"] * keep_groups

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The counts of a chunk come before its documents."""
        chunk, waiting, sums_of = None, [], None
        for batch in batches:
            numbers = batch.column("chunk").to_numpy()
            kinds = batch.column("kind").to_numpy()
            change = np.flatnonzero((np.diff(numbers) != 0) | (np.diff(kinds) != 0)) + 1
            for begin, end in zip([0, *change.tolist()], [*change.tolist(), len(numbers)]):
                if begin == end:
                    continue
                part = batch.slice(begin, end - begin)
                if numbers[begin] != chunk:
                    chunk, waiting, sums_of, table = numbers[begin], [], None, None
                if kinds[begin] == 0:
                    table = [part.column(c)[0].values.to_numpy(zero_copy_only=False) for c in ("sizes", "places", "linked")]
                elif kinds[begin] == 1:
                    waiting.append((part.column("docs").to_numpy(), part.column("best").to_numpy(zero_copy_only=False)))
                else:
                    if sums_of is None:
                        sizes, places, linked = table
                        docs_of = np.concatenate([w[0] for w in waiting] or [np.zeros(1, np.int64)])
                        best_of = np.concatenate([w[1] for w in waiting] or [np.zeros(1, bool)])
                        offsets = offsets_of(sizes)
                        sums_of = sums(linked * best_of[places], offsets), sums(linked * docs_of[places], offsets)
                    yield _of_documents(part, sums_of, names)

    schema = f"doc_id {id_type}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
    return together.mapInArrow(add_up, schema + ", groups string" * keep_groups)


def _of_documents(part: pa.RecordBatch, of_window: tuple[np.ndarray, np.ndarray], names: list[str]) -> pa.RecordBatch:
    held = [unpacked(raw) for raw in part.column("windows").to_pylist()]
    offsets = offsets_of([len(w) for w, _ in held])
    window, times = (np.concatenate(x) for x in zip(*held))
    added = {name: pa.array(sums(values[window] * times, offsets), pa.int64()) for name, values in zip(("n_best", "count_sum"), of_window)}
    return pa.RecordBatch.from_arrays([added[c] if c in added else part.column(c) for c in names], names=names)
