"""Encoding into a vocabulary's pieces by suffix-array matching, and decoding.

The distinct pre-tokens of a batch are laid end to end and indexed by a suffix array. Every piece of the
vocabulary is searched in it by bisection, which gives its whole range of occurrences at once; these are the
edges of a lattice over the text. The edges are sorted by the position they end at and relaxed in that order: of
the edges that end at a position exactly one continues the encoding of the text before it, namely the one whose
piece and the piece before it are what the two together encode to. This yields the same ids as the library's merge
order, since an encoding is right as a whole exactly if it is right for every two neighbours.

Results equal the ``sentencepiece`` library's for the vocabulary file, without begin and end tokens; see
``pieces`` for the treatment of spaces, control symbols and unknown characters. A null or empty text has no ids
and decodes to the empty text; a row is encoded for itself and whole; an empty table gives an empty table; columns
besides ``doc_id`` and ``text`` are not read. Decoding gives the text back unless it holds the vocabulary's own space
mark, which comes back as a space.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from pedalflow.llm import pieces
from pedalflow.llm.arrays import as_bytes, offsets_of, ranges, sums, text_chunks
from pedalflow.llm.ship import ship

# A worker remembers the ids of so many pre-tokens of at most so many bytes, and for so many pairs of pieces whether
# one may follow the other; others are worked out anew.
KNOWN_PRETOKENS, KNOWN_BYTES, KNOWN_PAIRS = 300_000, 24, 1_000_000
# Pre-tokens are indexed together in slices of about this many bytes, which bounds the arrays of a slice to some 60 MB.
SLICE_BYTES = 400_000
_NONE, _OUTSIDE = -1, -2


class Encoder:
    """A vocabulary with its pieces as search keys and what has been learned about pairs of pieces."""

    def __init__(self, path: str):
        self.vocab = pieces.vocabulary(path)
        texts = sorted(self.vocab.pieces, key=self.vocab.pieces.get)
        self.ids = np.array([self.vocab.pieces[t] for t in texts], np.int32)
        self.sizes = np.array([len(t) for t in texts])
        self.longest = int(self.sizes.max())
        self.keys = np.full((len(texts), self.longest), _NONE, np.int32)
        for row, t in enumerate(texts):
            self.keys[row, : len(t)] = self._symbols(t)
        # Characters of each piece, to build pairs of pieces.
        flat, offsets = self.keys[self.keys != _NONE], offsets_of(self.sizes)
        row = np.zeros(self.vocab.n_symbols, np.int64)
        row[self.ids] = np.arange(len(texts))
        self.piece_start, self.piece_size = offsets[:-1][row], np.zeros(self.vocab.n_symbols, np.int64)
        self.piece_size[self.ids] = self.sizes
        self.piece_symbols = flat
        # A piece that its own characters do not merge to is never used.
        merged, ends = pieces.merge(self.vocab, flat, offsets)
        alone = np.diff(ends) == 1
        self.usable = np.zeros(self.vocab.n_symbols, bool)
        self.usable[self.ids[alone]] = merged[ends[:-1][alone]] == self.ids[alone]
        # Ids of pre-tokens met before: a row for each, with the place and number of its ids in one array.
        self.known_row: dict[bytes, int] = {}
        self.known_ids, self.known_offsets = np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.pair_keys = np.zeros(0, np.int64)
        self.pair_fits = np.zeros(0, bool)

    def _symbols(self, text: str) -> np.ndarray:
        return self.vocab.symbol_of[np.frombuffer(text.encode("utf-32-le"), np.uint32)]

    def fits(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether piece ``right`` may follow piece ``left``: the two together encode to just these."""
        wanted = left.astype(np.int64) * self.vocab.n_symbols + right
        distinct, which = np.unique(wanted, return_inverse=True)
        at = np.searchsorted(self.pair_keys, distinct)
        known = at < len(self.pair_keys)
        known[known] = self.pair_keys[at[known]] == distinct[known]
        fits = np.zeros(len(distinct), bool)
        fits[known] = self.pair_fits[at[known]]
        new = distinct[~known]
        if len(new):
            fits[~known] = fresh = self._try_pairs(new // self.vocab.n_symbols, new % self.vocab.n_symbols)
            if len(self.pair_keys) + len(new) > KNOWN_PAIRS:
                self.pair_keys, self.pair_fits = new, fresh
            else:
                place = np.searchsorted(self.pair_keys, new)
                self.pair_keys = np.insert(self.pair_keys, place, new)
                self.pair_fits = np.insert(self.pair_fits, place, fresh)
        return fits[which]

    def _try_pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        both = np.stack([left, right], 1).ravel()
        sizes = self.piece_size[both]
        symbols = self.piece_symbols[ranges(self.piece_start[both], sizes)]
        merged, ends = pieces.merge(self.vocab, symbols, offsets_of(sizes.reshape(-1, 2).sum(1)))
        two = np.flatnonzero(np.diff(ends) == 2)
        out = np.zeros(len(left), bool)
        first = ends[two]
        out[two] = (merged[first] == left[two]) & (merged[first + 1] == right[two])
        return out

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, flat, and their offsets."""
        pretokens, at, token_offsets = pieces.distinct_pretokens(self.vocab, texts)
        if not pretokens:
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        row = np.array([self.known_row.get(t, -1) for t in pretokens], np.int64)
        known, known_offsets = [self.known_ids], [self.known_offsets]
        rows = len(self.known_offsets) - 1
        new = np.flatnonzero(row < 0)
        row[new] = rows + np.arange(len(new))
        fresh = [pretokens[i] for i in new.tolist()]
        for part in _slices(fresh, SLICE_BYTES):
            flat, offsets = self._encode_pretokens(fresh[part])
            known.append(flat)
            known_offsets.append(known_offsets[-1][-1] + offsets[1:])
        known, known_offsets = np.concatenate(known), np.concatenate(known_offsets)
        if len(known_offsets) <= KNOWN_PRETOKENS:
            self.known_row.update((t, r) for t, r in zip(fresh, range(rows, rows + len(fresh))) if len(t) <= KNOWN_BYTES)
            self.known_ids, self.known_offsets = known, known_offsets
        else:
            self.known_row = {}
            self.known_ids, self.known_offsets = np.zeros(0, np.int32), np.zeros(1, np.int64)
        sizes = np.diff(known_offsets)[row]
        per_place = sizes[at]
        out = known[ranges(known_offsets[row][at], per_place)]
        return out, offsets_of(sums(per_place, token_offsets))

    def _encode_pretokens(self, pretokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        symbols, offsets = pieces.to_symbols(self.vocab, pretokens)
        points = np.frombuffer(b"".join(pretokens).decode().encode("utf-32-le"), np.uint32)
        start, end, piece = self._edges(symbols, offsets)
        chosen, first = self._relax(symbols, offsets, start, end, piece)
        # Back from the last position of each pre-token.
        is_token = np.zeros(len(symbols) + 1, bool)
        here = offsets[1:].copy()
        begin = offsets[:-1]
        while len(here):
            is_token[here] = True
            here = first[here]
            more = here > begin
            here, begin = here[more], begin[more]
        ends = np.flatnonzero(is_token)
        counts = np.bincount(np.searchsorted(offsets, ends, "left") - 1, minlength=len(pretokens))
        return pieces.token_ids(self.vocab, chosen[ends], offsets_of(counts), points[ends - 1])

    def _edges(self, symbols: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Every occurrence of a usable piece inside a pre-token: where it begins and ends, and the piece."""
        n = len(offsets) - 1
        # One symbol that no piece holds after each pre-token.
        text = np.full(len(symbols) + n + self.longest, _OUTSIDE, np.int32)
        place = np.arange(len(symbols)) + np.repeat(np.arange(n), np.diff(offsets))
        text[place] = symbols
        suffixes = suffix_array(text, self.longest)
        low = self._bisect(text, suffixes, upper=False)
        high = self._bisect(text, suffixes, upper=True)
        use = (high > low) & self.usable[self.ids]
        at = suffixes[ranges(low[use], (high - low)[use])]
        count = (high - low)[use]
        back = np.zeros(len(text), np.int64)
        back[place] = np.arange(len(symbols))
        start = back[at]
        end = start + np.repeat(self.sizes[use], count)
        return start.astype(np.int32), end.astype(np.int32), np.repeat(self.ids[use], count)

    def _bisect(self, text: np.ndarray, suffixes: np.ndarray, upper: bool) -> np.ndarray:
        """For each piece the first suffix that does not come before it; ``upper``: that does not begin with it either."""
        low, high = np.zeros(len(self.keys), np.int64), np.full(len(self.keys), len(suffixes))
        column = np.arange(self.longest)
        while (open_ := low < high).any():
            middle = (low + high) // 2
            at = np.minimum(middle, len(suffixes) - 1)
            found = text[np.minimum(suffixes[at][:, None] + column, len(text) - 1)]
            differs = (found != self.keys) & (self.keys != _NONE)
            first = differs.argmax(1)
            row = np.arange(len(self.keys))
            same = ~differs[row, first]
            before = np.where(same, upper, found[row, first] < self.keys[row, first])
            low = np.where(open_ & before, middle + 1, low)
            high = np.where(open_ & ~before, middle, high)
        return low

    def _relax(self, symbols, offsets, start, end, piece) -> tuple[np.ndarray, np.ndarray]:
        """For each position the piece that ends there in the encoding of the pre-token up to it, and where it begins.

        All pre-tokens go forward together, one symbol a step.
        """
        n = len(symbols)
        owner_begin = np.repeat(offsets[:-1], np.diff(offsets))
        # A character without a piece is an edge of its own.
        single = np.zeros(n, bool)
        single[start[end - start == 1]] = True
        lone = np.flatnonzero(~single).astype(np.int32)
        start, end = np.concatenate([start, lone]), np.concatenate([end, lone + 1])
        piece = np.concatenate([piece, symbols[lone]])
        step = (end - owner_begin[start]).astype(np.int32)
        order = np.argsort(step)
        start, end, piece = start[order], end[order], piece[order]
        bounds = np.searchsorted(step[order], np.arange(1, int(step.max()) + 2))
        chosen, first = np.full(n + 1, _NONE, np.int32), np.zeros(n + 1, np.int64)
        is_piece = self.piece_size > 0
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            s, p = start[a:b], piece[a:b]
            before = np.where(s > owner_begin[s], chosen[s], _NONE)
            # An unknown character never merges, so anything may stand beside it.
            free = (before == _NONE) | ~is_piece[p] | ~is_piece[np.maximum(before, 0)]
            good = free.copy()
            ask = np.flatnonzero(~free)
            good[ask] = self.fits(before[ask], p[ask])
            chosen[end[a:b][good]] = p[good]
            first[end[a:b][good]] = s[good]
        return chosen, first


def _slices(texts: list[bytes], limit: int) -> Iterator[slice]:
    """Slices of the list of at most ``limit`` bytes each, one text at least."""
    ends = np.cumsum([len(t) for t in texts])
    begin = 0
    while begin < len(texts):
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield slice(begin, end)
        begin = end


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """The positions of ``text`` in the order of what follows, as far as ``depth`` symbols matter."""
    _, rank = np.unique(text, return_inverse=True)
    known = 1
    order = None
    while known < depth:
        later = np.zeros(len(text), np.int64)
        later[: len(text) - known] = rank[known:] + 1
        key = rank * (len(text) + 1) + later
        order = np.argsort(key)
        ranked = key[order]
        rank = np.empty(len(text), np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])])
        known *= 2
    return np.argsort(rank) if order is None else order


class Decoder:
    """The bytes of each id of a vocabulary."""

    def __init__(self, path: str):
        vocab = pieces.vocabulary(path)
        parts = [b""] * vocab.n_pieces
        for text, i in vocab.pieces.items():
            parts[i] = text.replace("▁", " ").encode()
        for byte, i in enumerate(vocab.byte_ids.tolist()):
            parts[i] = bytes([byte])
        self.sizes = np.array([len(p) for p in parts])
        self.starts = offsets_of(self.sizes)[:-1]
        self.raw = np.frombuffer(b"".join(parts), np.uint8)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """The texts, without the space that encoding puts before them."""
        sizes = self.sizes[ids]
        raw = self.raw[ranges(self.starts[ids], sizes)].tobytes()
        ends = offsets_of(sums(sizes, offsets)).tolist()
        return [raw[a + 1 : b] if raw[a : a + 1] == b" " else raw[a:b] for a, b in zip(ends, ends[1:])]


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    return Encoder(path)


@lru_cache(maxsize=1)
def decoder(path: str) -> Decoder:
    return Decoder(path)


def encode(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """``(doc_id, token_ids, n_tokens, round_trip)`` of every row; ``round_trip``: decoding gives the text back."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches, "text"):
            texts = as_bytes(chunk.column("text"))
            ids, offsets = encoder(vocabulary_path).encode(texts)
            back = decoder(vocabulary_path).decode(ids, offsets)
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [
                    chunk.column("doc_id"),
                    lists,
                    pa.array(np.diff(offsets), pa.int64()),
                    pa.array([a == b for a, b in zip(texts, back)], pa.bool_()),
                ],
                names=["doc_id", "token_ids", "n_tokens", "round_trip"],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, token_ids array<int>, n_tokens bigint, round_trip boolean"
    )


def decode(encoded: DataFrame, vocabulary_path: str) -> DataFrame:
    """``(doc_id, text)`` of rows with ``token_ids``; null ids give the empty text."""
    ship(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("token_ids")
            sizes = pc.fill_null(lists.value_lengths(), 0).to_numpy(zero_copy_only=False)
            ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            texts = decoder(vocabulary_path).decode(ids, offsets_of(sizes))
            column = pa.array([t.decode("utf-8", "replace") for t in texts], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), column], names=["doc_id", "text"])

    id_type = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "token_ids").mapInArrow(run, f"doc_id {id_type}, text string")
