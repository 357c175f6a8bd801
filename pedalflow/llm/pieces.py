"""Token counts of a byte-fallback BPE vocabulary by rank-synchronous merging.

The pre-tokens of a batch of texts are made distinct and laid end to end in one flat array of symbol
ids. In each round every sequence applies its pair of lowest rank, all sequences at the same time;
what is left when no sequence has a pair to merge are its tokens. The texts themselves never enter
a Python loop. Only a sequence of more than ``LONG`` symbols, which would take a round for each of its ranks or more, is
merged pair by pair, from a heap of its pairs by rank and place: in a time that follows its length.

Results equal the ``sentencepiece`` library's for the vocabulary file, without begin and end tokens:

* a text that is null or empty has 0 tokens; white space alone is counted as the library does;
* a space is put before the text, spaces are never joined or dropped, control symbols written in a
  text are ordinary text, a character that no piece holds counts one token per UTF-8 byte;
* a row is independent of all others: repeated rows get equal counts, an empty table gives an empty
  table, and columns besides ``doc_id`` and the text are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from pedalflow.llm.arrays import as_bytes, offsets_of, ranges, sums, text_chunks
from pedalflow.llm.ship import ship

TOKEN_LIMIT = 4096
# A worker remembers the counts of so many pre-tokens of at most so many bytes (some 80 MB); others are counted anew.
KNOWN_PRETOKENS, KNOWN_BYTES = 600_000, 24
LONG = 256  # symbols; a word has some 10
NO_PAIR = np.iinfo(np.int32).max
_SPACE_MARK = "▁"
_known: dict[str, dict[bytes, int]] = {}


class Vocabulary:
    """Symbols, pieces and the ranked pairs of a vocabulary file.

    Symbol ids below ``n_pieces`` are the file's piece ids, then come the characters that occur inside
    pieces without being one, then one id for unknown characters of each UTF-8 length.
    """

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        if model.normalize("  a ﬁ  ") != "▁▁▁a▁ﬁ ▁":
            raise ValueError("only vocabularies that keep the text as it is and put a space before it are supported")
        self.n_pieces = len(model)
        ids = range(self.n_pieces)
        special = {i for i in ids if model.is_byte(i) or model.is_control(i) or model.is_unknown(i)}
        self.pieces = {model.id_to_piece(i): i for i in ids if i not in special}
        self.byte_ids = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        if any(" " in p or _SPACE_MARK in p.lstrip(_SPACE_MARK) for p in self.pieces):
            raise ValueError("a piece goes on over a space")

        letters = sorted({c for p in self.pieces for c in p} - set(self.pieces))
        self.symbols = dict(self.pieces) | {c: self.n_pieces + i for i, c in enumerate(letters)}
        self.first_unknown = self.n_pieces + len(letters)
        self.n_symbols = self.first_unknown + 4
        self.weight = np.ones(self.n_symbols, np.int64)  # tokens that a left-over symbol stands for
        for c in letters:
            self.weight[self.symbols[c]] = len(c.encode())
        self.weight[self.first_unknown :] = [1, 2, 3, 4]

        self.symbol_of = np.empty(0x110000, np.int32)
        for begin, end, size in ((0, 0x80, 1), (0x80, 0x800, 2), (0x800, 0x10000, 3), (0x10000, 0x110000, 4)):
            self.symbol_of[begin:end] = self.first_unknown + size - 1
        for c, symbol in self.symbols.items():
            if len(c) == 1:
                self.symbol_of[ord(c)] = symbol
        self.symbol_of[ord(" ")] = self.symbol_of[ord(_SPACE_MARK)]

        scores = {i: model.get_score(i) for i in self.pieces.values()}
        rank_of = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        pairs = [
            (self.symbols[p[:k]] * self.n_symbols + self.symbols[p[k:]], rank_of[scores[i]], i)
            for p, i in self.pieces.items()
            for k in range(1, len(p))
            if p[:k] in self.symbols and p[k:] in self.symbols
        ]
        table = np.array(sorted(pairs), np.int64).reshape(-1, 3)
        self.pair_keys = np.append(table[:, 0], np.iinfo(np.int64).max)
        self.pair_rank = np.append(table[:, 1], NO_PAIR).astype(np.int32)
        self.pair_piece = np.append(table[:, 2], 0).astype(np.int32)
        # A piece is held back if a pair with it can come before or level with the merge that made it: then only the
        # leftmost of several equal merges is sure to be next. All others may be applied at once.
        made_at = np.full(self.n_symbols, -1)
        made_at[list(scores)] = [rank_of[s] for s in scores.values()]
        ranks, keys = table[:, 1], table[:, 0]
        self.held_back = np.zeros(self.n_symbols, bool)
        for side in (keys // self.n_symbols, keys % self.n_symbols):
            self.held_back[side[ranks <= made_at[side]]] = True
        # ASCII characters outside all longer pieces: a text can be cut before and after them.
        inside = {c for p in self.pieces if len(p) > 1 for c in p}
        self.cuts = np.array([b < 128 and chr(b) not in inside and b != 32 for b in range(256)])

    @cached_property
    def pairs(self) -> dict[int, tuple[int, int]]:
        """Rank and piece by the key of the pair."""
        return dict(zip(self.pair_keys[:-1].tolist(), zip(self.pair_rank[:-1].tolist(), self.pair_piece[:-1].tolist())))

    def rank_pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of each pair; NO_PAIR where there is none."""
        keys = left.astype(np.int64) * self.n_symbols + right
        at = np.searchsorted(self.pair_keys, keys)
        found = self.pair_keys[at] == keys
        return np.where(found, self.pair_rank[at], NO_PAIR).astype(np.int32), self.pair_piece[at]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def distinct_pretokens(vocab: Vocabulary, texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct pre-tokens, the one at each place of the texts, and where each text begins there.

    A pre-token is a run of spaces with what follows it. No piece goes on over the start of such a run, so the
    tokens of a text are those of its pre-tokens.
    """
    spaced = [b" " + t.replace(_SPACE_MARK.encode(), b" ") if t else t for t in texts]
    data = np.frombuffer(b"".join(spaced), np.uint8)
    doc_offsets = offsets_of([len(t) for t in spaced])
    if not len(data):
        return [], np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    space, alone = data == 32, vocab.cuts[data]
    begins = np.zeros(len(data), bool)
    begins[1:] = (space[1:] & ~space[:-1]) | alone[1:] | alone[:-1]
    begins[doc_offsets[:-1][np.diff(doc_offsets) > 0]] = True
    starts = np.flatnonzero(begins)
    offsets = np.append(starts, len(data)).astype(np.int32)
    column = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    encoded = column.dictionary_encode()
    token_offsets = np.searchsorted(starts, doc_offsets)
    return encoded.dictionary.to_pylist(), encoded.indices.to_numpy(zero_copy_only=False), token_offsets


def to_symbols(vocab: Vocabulary, pretokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The characters of the pre-tokens as symbols, flat, and their offsets."""
    points = np.frombuffer(b"".join(pretokens).decode().encode("utf-32-le"), np.uint32)
    return vocab.symbol_of[points], offsets_of([len(t.decode()) for t in pretokens])


def merge(vocab: Vocabulary, symbols: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge all sequences to the end: their remaining symbols, flat, and the offsets."""
    n = len(offsets) - 1
    symbols, owner = symbols.copy(), np.repeat(np.arange(n), np.diff(offsets))
    done_symbols, done_owner = [], []
    long = np.flatnonzero(np.diff(offsets) > LONG)
    if len(long):
        for i in long.tolist():
            done_symbols.append(merge_one(vocab, symbols[offsets[i] : offsets[i + 1]]))
            done_owner.append(np.full(len(done_symbols[-1]), i))
        short = np.diff(offsets)[owner] <= LONG
        symbols, owner = symbols[short], owner[short]
    rank, piece = _all_pairs(vocab, symbols, owner)
    while len(symbols):
        starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        sizes = np.diff(np.append(starts, len(owner)))
        lowest = np.minimum.reduceat(rank, starts)
        live = lowest < NO_PAIR
        if not live.all():
            over = np.repeat(~live, sizes)
            done_symbols.append(symbols[over])
            done_owner.append(owner[over])
            symbols, owner, rank, piece = symbols[~over], owner[~over], rank[~over], piece[~over]
            sizes, lowest = sizes[live], lowest[live]
            if not len(symbols):
                break
        hit = np.flatnonzero(rank == np.repeat(lowest, sizes))
        hit = hit[_together(vocab, hit, owner, piece)]
        symbols[hit] = piece[hit]
        keep = np.ones(len(symbols), bool)
        keep[hit + 1] = False
        place = np.cumsum(keep) - 1
        changed = place[hit]
        symbols, owner, rank, piece = symbols[keep], owner[keep], rank[keep], piece[keep]
        touched = np.zeros(len(symbols), bool)
        touched[changed] = True
        touched[changed[changed > 0] - 1] = True
        stale = np.flatnonzero(touched)
        last = stale == len(symbols) - 1
        rank[stale[last]] = NO_PAIR
        stale = stale[~last]
        new_rank, new_piece = vocab.rank_pairs(symbols[stale], symbols[stale + 1])
        new_rank[owner[stale] != owner[stale + 1]] = NO_PAIR
        rank[stale], piece[stale] = new_rank, new_piece
    if not done_symbols:
        return symbols, np.zeros(n + 1, np.int64)
    symbols, owner = np.concatenate(done_symbols), np.concatenate(done_owner)
    order = np.argsort(owner, kind="stable")
    return symbols[order], offsets_of(np.bincount(owner, minlength=n))


def merge_one(vocab: Vocabulary, symbols: np.ndarray) -> np.ndarray:
    """Merge one sequence to the end: of all pairs that of the lowest rank first, of equal ones the leftmost."""
    left, pairs, base = symbols.tolist(), vocab.pairs, vocab.n_symbols
    n = len(left)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    # Rank and place in one number; the pair is looked up again when its turn comes, for it may be gone by then.
    heap = [pairs[key][0] << 40 | i for i, key in enumerate(a * base + b for a, b in zip(left, left[1:])) if key in pairs]
    heapq.heapify(heap)
    while heap:
        first = heapq.heappop(heap)
        rank, i = first >> 40, first & (1 << 40) - 1
        j = after[i]
        if left[i] < 0 or j >= n:
            continue
        found = pairs.get(left[i] * base + left[j])
        if found is None or found[0] != rank:
            continue
        left[i], left[j] = found[1], -1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            following = pairs.get(left[i] * base + left[k])
            if following:
                heapq.heappush(heap, following[0] << 40 | i)
        h = before[i]
        if h >= 0:
            earlier = pairs.get(left[h] * base + left[i])
            if earlier:
                heapq.heappush(heap, earlier[0] << 40 | h)
    return np.array([s for s in left if s >= 0], symbols.dtype)


def _all_pairs(vocab: Vocabulary, symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    rank, piece = np.full(len(symbols), NO_PAIR, np.int32), np.zeros(len(symbols), np.int32)
    if len(symbols) > 1:
        rank[:-1], piece[:-1] = vocab.rank_pairs(symbols[:-1], symbols[1:])
        rank[:-1][owner[1:] != owner[:-1]] = NO_PAIR
    return rank, piece


def _together(vocab: Vocabulary, hit: np.ndarray, owner: np.ndarray, piece: np.ndarray) -> np.ndarray:
    """Which of the lowest pairs of the sequences can be merged in one round."""
    first = np.concatenate([[True], owner[hit[1:]] != owner[hit[:-1]]])
    # Of pairs that overlap, as in a run of one letter, every second one from the left.
    touching = np.concatenate([[False], (hit[1:] == hit[:-1] + 1) & ~first[1:]])
    index = np.arange(len(hit))
    run_start = np.maximum.accumulate(np.where(touching, 0, index))
    alternate = (index - run_start) % 2 == 0
    # One held-back pair anywhere in a sequence makes the whole sequence go one step at a time.
    group = np.cumsum(first) - 1
    careful = np.bincount(group, weights=vocab.held_back[piece[hit]]) > 0
    return np.where(careful[group], first, alternate)


def count_tokens(vocab: Vocabulary, texts: list[bytes], known: dict[bytes, int] | None = None) -> np.ndarray:
    """Tokens of each text. ``known`` keeps the counts of short pre-tokens from one call to the next."""
    pretokens, at, token_offsets = distinct_pretokens(vocab, texts)
    if not pretokens:
        return np.zeros(len(texts), np.int64)
    known = {} if known is None else known
    counts = np.array([known.get(t, -1) for t in pretokens], np.int64)
    new = np.flatnonzero(counts < 0)
    if len(new):
        fresh = [pretokens[i] for i in new]
        symbols, offsets = merge(vocab, *to_symbols(vocab, fresh))
        counts[new] = sums(vocab.weight[symbols], offsets)
        if len(known) > KNOWN_PRETOKENS:
            known.clear()
        known.update((t, n) for t, n in zip(fresh, counts[new].tolist()) if len(t) <= KNOWN_BYTES)
    return sums(counts[at], token_offsets)


def token_ids(vocab: Vocabulary, symbols: np.ndarray, offsets: np.ndarray, points: np.ndarray) -> tuple:
    """Final symbols as piece ids; a symbol that is no piece becomes the ids of its character's bytes.

    ``points`` holds the code point of each symbol that is a lone character (any value elsewhere).
    """
    lone = symbols >= vocab.n_pieces
    sizes = np.where(lone, vocab.weight[symbols], 1)
    ids = np.repeat(symbols, sizes)
    if lone.any():
        first = offsets_of(sizes)[:-1][lone]
        raw = np.frombuffer(points[lone].astype("<u4").tobytes().decode("utf-32-le").encode(), np.uint8)
        ids[ranges(first, sizes[lone])] = vocab.byte_ids[raw]
    return ids, offsets_of(sums(sizes, offsets))


def token_counts(docs: DataFrame, vocabulary_path: str, limit: int = TOKEN_LIMIT) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` of every row of ``docs`` (``doc_id``, ``text``)."""
    ship(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, known = vocabulary(vocabulary_path), _known.setdefault(vocabulary_path, {})
        for chunk in text_chunks(batches, "text", limit=8 << 20):
            texts = as_bytes(chunk.column("text"))
            tokens = count_tokens(vocab, texts, known)
            yield pa.RecordBatch.from_arrays(
                [
                    chunk.column("doc_id"),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array(tokens > limit),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    return docs.select("doc_id", "text").mapInArrow(count, schema)
