"""License scans: exact phrases, and short notices found with a bounded number of errors.

Texts are reduced to their words (ASCII letters lower-cased) joined by single spaces, all texts of a chunk
in one buffer. A notice that may have k errors is split into k + 1 seeds: wherever it stands with at most k
errors, one seed at least stands there unchanged. So the seeds are searched exactly, and only around them
the ``regex`` library's bounded-error matching decides, counts the edits and gives the span.

Defined results: a text that is null, empty or without words has no words, no places and score 0; every
row is scanned for itself and whole, so repeated rows get equal results; matches do not overlap within one
notice; of matches that overlap the one with the fewest errors counts, then the first, and what stands before and after
it counts too; an empty table gives an empty table; columns
besides ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import bisect
import heapq
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pedalflow.llm.arrays import LOWER, as_bytes, offsets_of, text_chunks
from pedalflow.llm.ship import ship

# Exact phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Short notices as words, and their labels.
NOTICES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "licensed under the apache license version 2 0": "apache",
    "licensed under the gnu general public license version": "gpl",
    "under the terms of the gnu general public license as published by": "gpl",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "subject to the terms of the mozilla public license": "mpl",
    "licensed under cc by": "cc-by",
    "licensed under a creative commons attribution": "cc-by",
    "all rights reserved": "reserved",
}
# A notice may have one error (a letter changed, added or left out) for so many characters.
CHARS_PER_ERROR = 10
# A window that is searched at once is so many times as long as its notice at most, or as one seed asks.
WINDOW_SIZES = 4

_WORD = np.array([b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 for b in range(256)])
_END = 255  # between two texts; no byte of UTF-8
_EDGE = rb"[ \xff]"


class Notice(NamedTuple):
    words: str
    label: str
    errors: int
    seeds: list[tuple[int, bytes]]
    pattern: regex.Pattern


def notice(words: str, label: str, chars_per_error: int = CHARS_PER_ERROR) -> Notice:
    raw = words.encode()
    errors = len(raw) // chars_per_error
    cut = [len(raw) * i // (errors + 1) for i in range(errors + 2)]
    seeds = [(a, raw[a:b]) for a, b in zip(cut, cut[1:])]
    pattern = regex.compile(rb"(?b)(?<=%s)(?:%s){e<=%d}(?=%s)" % (_EDGE, regex.escape(raw), errors, _EDGE))
    return Notice(words, label, errors, seeds, pattern)


@lru_cache(maxsize=1)
def _notices() -> list[Notice]:
    return [notice(words, label) for words, label in NOTICES.items()]


@lru_cache(maxsize=1)
def _phrases() -> regex.Pattern:
    names = b"|".join(regex.escape(p.encode()) for p in sorted(PHRASES, key=len, reverse=True))
    return regex.compile(rb"(?<=%s)(?:%s)(?=%s)" % (_EDGE, names, _EDGE))


class Buffer(NamedTuple):
    """Words of several texts, each word with a space before and the last of a text with one after it."""

    raw: bytes
    text_offsets: np.ndarray  # where each text begins
    word_starts: np.ndarray
    word_offsets: np.ndarray  # the number of words before each text


def words_of(texts: list[bytes]) -> Buffer:
    lowered = b"".join(b" " + t.translate(LOWER) + b" \xff" for t in texts)
    data = np.frombuffer(lowered, np.uint8)
    ends = offsets_of([len(t) + 3 for t in texts])
    is_word = _WORD[data]
    is_word[ends[1:] - 1] = False
    # Of each gap only its first byte stays, as a space.
    keep = is_word.copy()
    keep[1:] |= is_word[:-1]
    keep[ends[:-1]] = True
    keep[ends[1:] - 1] = True
    spaced = np.where(is_word, data, 32).astype(np.uint8)
    spaced[ends[1:] - 1] = _END
    before = offsets_of(keep)
    kept = spaced[keep]
    is_word = is_word[keep]
    starts = np.flatnonzero(is_word[1:] & ~is_word[:-1]) + 1
    text_offsets = before[ends]
    return Buffer(kept.tobytes(), text_offsets, starts, np.searchsorted(starts, text_offsets))


class Place(NamedTuple):
    text: int
    first_word: int
    last_word: int
    label: str
    errors: int
    score: float


def _place(buffer: Buffer, begin: int, end: int, label: str, errors: int, score: float) -> Place:
    text = int(np.searchsorted(buffer.text_offsets, begin, "right")) - 1
    # The word that the match begins in, and the one it ends in.
    first = int(np.searchsorted(buffer.word_starts, begin, "right")) - 1
    last = int(np.searchsorted(buffer.word_starts, end, "left")) - 1
    base = int(buffer.word_offsets[text])
    return Place(text, max(first - base, 0), max(last - base, 0), label, errors, score)


def exact_places(buffer: Buffer) -> list[Place]:
    """Where the phrases stand."""
    found = []
    at = buffer.raw.find(b"license")
    # Every phrase ends in the same rare word: only around it the pattern is tried.
    reach = max(map(len, PHRASES))
    while at >= 0:
        for m in _phrases().finditer(buffer.raw, max(0, at - reach), at + len(b"license") + 1):
            if m.end() == at + len(b"license"):
                found.append(_place(buffer, m.start(), m.end(), PHRASES[m.group().decode()], 0, 1.0))
        at = buffer.raw.find(b"license", at + 1)
    return found


def fuzzy_places(buffer: Buffer, notices: list[Notice] | None = None) -> list[Place]:
    """Where the notices stand with at most their number of errors: of places that overlap the one with the fewest, then the first."""
    found = []
    for n in _notices() if notices is None else notices:
        size = len(n.words)
        for begin, end, errors in _best_first(n, buffer.raw, _joined(_windows(n, buffer), WINDOW_SIZES * size)):
            found.append(_place(buffer, begin, end, n.label, errors, 1 - errors / size))
    return found


def _windows(n: Notice, buffer: Buffer) -> list[tuple[int, int]]:
    """Around each seed the room that the whole notice may take, within the seed's text."""
    begins = []
    for offset, seed in n.seeds:
        at = buffer.raw.find(seed)
        while at >= 0:
            begins.append((at, at - offset - n.errors - 1))
            at = buffer.raw.find(seed, at + 1)
    if not begins:
        return []
    at, begin = np.array(begins).T
    text = np.searchsorted(buffer.text_offsets, at, "right")
    low, high = buffer.text_offsets[text - 1], buffer.text_offsets[text] - 1  # without _END
    end = begin + len(n.words) + 2 * n.errors + 2
    return list(zip(np.maximum(begin, low).tolist(), np.minimum(end, high).tolist()))


def _joined(windows: list[tuple[int, int]], longest: int) -> list[tuple[int, int]]:
    """Windows that overlap as one, up to a length; each given window lies whole in one of the result."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted(windows):
        if out and begin <= out[-1][1] and max(end, out[-1][1]) - out[-1][0] <= longest:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def _best_first(n: Notice, raw: bytes, windows: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """``(begin, end, errors)`` of matches that do not overlap; what a match leaves of its window is searched again."""
    heap: list[tuple[int, int, int, int, int]] = []
    taken: list[tuple[int, int, int]] = []

    def look(low: int, high: int) -> None:
        # Too short for a match and the edge after it.
        if high - low <= len(n.words) - n.errors:
            return
        m = n.pattern.search(raw, low, high)
        if m:
            heapq.heappush(heap, (sum(m.fuzzy_counts), m.start(), m.end(), low, high))

    for low, high in windows:
        look(low, high)
    while heap:
        errors, begin, end, low, high = heapq.heappop(heap)
        at = bisect.bisect(taken, (begin, end))
        if at and taken[at - 1][1] > begin:
            begin, end, _ = taken[at - 1]
        elif at < len(taken) and taken[at][0] < end:
            begin, end, _ = taken[at]
        else:
            taken.insert(at, (begin, end, errors))
        look(low, min(begin, high))
        look(max(end, low), high)
    return taken


SPANS = "array<struct<first_word:bigint,last_word:bigint,label:string,errors:int,score:double>>"
_SPAN = pa.struct(
    [("first_word", pa.int64()), ("last_word", pa.int64()), ("label", pa.string()), ("errors", pa.int32()), ("score", pa.float64())]
)


def scan(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_words, base, fuzzy)`` of every row: the spans of the phrases and of the notices, in word numbers from 0."""
    ship(docs.sparkSession)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches, "text"):
            buffer = words_of(as_bytes(chunk.column("text")))
            spans = []
            for places in (exact_places(buffer), fuzzy_places(buffer)):
                per_text: list[list[dict]] = [[] for _ in range(chunk.num_rows)]
                for p in sorted(places):
                    per_text[p.text].append({k: v for k, v in p._asdict().items() if k != "text"})
                spans.append(pa.array(per_text, pa.list_(_SPAN)))
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), pa.array(np.diff(buffer.word_offsets), pa.int64()), *spans],
                names=["doc_id", "n_words", "base", "fuzzy"],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        find, f"doc_id {id_type}, n_words bigint, base {SPANS}, fuzzy {SPANS}"
    )


def licenses(docs: DataFrame) -> DataFrame:
    """One row per document with its labels and the best score; ``first_word`` and ``last_word`` of the phrases."""
    both = F.concat("base", "fuzzy")

    def names(spans) -> F.Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")

    starts = F.transform("base", lambda s: s["first_word"])
    return scan(docs).select(
        "doc_id",
        "n_words",
        F.size("base").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        names("base").alias("base_labels"),
        names(both).alias("labels"),
        F.coalesce(F.array_max(F.transform(both, lambda s: s["score"])), F.lit(0.0)).alias("score"),
        F.col("fuzzy").alias("spans"),
    )
