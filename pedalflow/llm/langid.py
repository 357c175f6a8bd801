"""Language identification with interpolated Kneser-Ney character models.

For every language there is one model of the letters of words, of order ``ORDER``, kept as sorted hash
arrays: a sorted array of n-gram hashes with the discounted probabilities beside it, and a sorted array
of context hashes with the weights of the next lower order. A text gets the language whose model needs
the fewest bits per letter. It is rejected if that figure lies too far above what the language's own
texts showed when the models were calibrated.

Words are runs of letters, lower-cased; everything else only separates words. Models and scores work on
the distinct words of a batch, and within these on the distinct n-grams, so the whole of every text counts.

Defined results: a text that is null or has no letter is ``und`` with score 0 and is rejected; ties go to
the language that comes first in order; a row does not depend on other rows, so repeated rows get equal
results; without any labelled text everything is ``und``. Rows with a null language are not learned from.
Columns besides those named are passed over.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pedalflow.llm.arrays import mix, offsets_of, ranges, sums, text_chunks
from pedalflow.llm.ship import ship

ORDER = 5
# The models are fitted on a sample of labelled texts of about this many characters per language, or of about SAMPLE_TEXTS
# texts if these are more (the bound); of texts longer than MAX_SAMPLE_TEXT a piece of that length is taken. A quarter of the drawn
# texts calibrates the rejection.
SAMPLE_CHARS, SAMPLE_TEXTS = 600_000, 20
MAX_SAMPLE_TEXT = 100_000
MAX_LANGUAGES = 200  # those with most text; texts of others are told to be in the nearest of these, or rejected
# A text is rejected beyond so many standard deviations of its language's calibration texts, and two bits in any case.
REJECT_DEVIATIONS, REJECT_BITS = 6.0, 2.0
UND = "und"
DISCOUNT_FLOOR = 0.1
# A task remembers the bits of so many words of at most so many letters; others are worked out anew.
KNOWN_WORDS, KNOWN_LETTERS = 150_000, 20
# Texts are scored in pieces of so many bytes; a piece takes some 25 times as much memory.
PIECE_BYTES = 2 << 20


@lru_cache(maxsize=1)
def _letter_table() -> np.ndarray:
    """Code point to the code point of its lower-case letter, 0 for what is no letter."""
    table = np.zeros(0x110000, np.int32)
    for point in range(0x110000):
        c = chr(point)
        if c.isalpha():
            lower = c.lower()
            table[point] = ord(lower) if len(lower) == 1 else point
    return table


class Words(NamedTuple):
    """The distinct words of some texts: letters (flat, offsets), and the word at each place of each text."""

    letters: np.ndarray
    offsets: np.ndarray
    at: np.ndarray
    text_offsets: np.ndarray
    keys: list[bytes]

    def some(self, which: np.ndarray) -> Words:
        """These distinct words alone."""
        starts, sizes = self.offsets[which], np.diff(self.offsets)[which]
        return Words(self.letters[ranges(starts, sizes)], offsets_of(sizes), self.at[:0], self.text_offsets[:0], [])


def distinct_words(texts: list[str]) -> Words:
    joined = "\n".join(texts) + "\n"
    letters = _letter_table()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
    is_letter = letters > 0
    edge = np.diff(np.concatenate([[0], is_letter.view(np.int8), [0]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    text_starts = offsets_of([len(t) + 1 for t in texts])
    text_offsets = np.searchsorted(starts, text_starts)
    words = letters[is_letter].astype("<i4")
    offsets = offsets_of(ends - starts)
    # Equal words are found by their bytes, four to a letter.
    column = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets * 4), pa.py_buffer(np.ascontiguousarray(words))]
    )
    encoded = column.dictionary_encode()
    keys = encoded.dictionary.to_pylist()
    flat = np.frombuffer(b"".join(keys), "<i4")
    sizes = pc.binary_length(encoded.dictionary).to_numpy(zero_copy_only=False) // 4
    at = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return Words(flat, offsets_of(sizes), at, text_offsets, keys)


BOUNDARY = 1  # stands before and after every word; no letter has this code point


def _padded(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The letters with a boundary before and after each word, and of each symbol its word and its place in it."""
    n = len(words.offsets) - 1
    sizes = np.diff(words.offsets)
    padded = np.full(int(sizes.sum()) + 2 * n, BOUNDARY, np.int64)
    begin = words.offsets[:-1] + 2 * np.arange(n)
    inside = np.ones(len(padded), bool)
    inside[begin] = False
    inside[begin + sizes + 1] = False
    padded[inside] = words.letters
    owner = np.repeat(np.arange(n), sizes + 2)
    return padded, owner, np.arange(len(padded)) - begin[owner]


def _grams(words: Words) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Of each letter and word end to be predicted: its word, how many symbols stand before it (the word's
    boundary included), and the hashes of the n-grams of length 1 .. ORDER that end there."""
    padded, owner, place = _padded(words)
    target = np.flatnonzero(place > 0)
    hashes, current = [], np.zeros(len(padded), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(ORDER):
            # Extend each n-gram to the left by the symbol k places before its end.
            current = mix(current * np.uint64(0xD6E8FEB86659FD93) + _earlier(padded, k) + np.uint64(k + 1))
            hashes.append(current[target])
    return owner[target], place[target], hashes


def _earlier(symbols: np.ndarray, k: int) -> np.ndarray:
    """The symbol k places before each; 0 where there is none."""
    out = np.zeros(len(symbols), np.uint64)
    if k < len(symbols):
        out[k:] = symbols[: len(symbols) - k]
    return out


class Level(NamedTuple):
    grams: np.ndarray  # sorted hashes
    share: np.ndarray  # discounted count / count of the context
    contexts: np.ndarray  # sorted hashes
    weight: np.ndarray  # of the next lower order


class Model(NamedTuple):
    levels: list[Level]
    uniform: float


def fit(words: Words, counts: np.ndarray) -> Model:
    """An interpolated Kneser-Ney model of words seen ``counts`` times.

    The longest n-gram at a place, and those that start at the word's boundary, count how often they were
    seen; shorter ones count how many different symbols were seen before them.
    """
    owner, place, hashes = _grams(words)
    seen = counts[owner].astype(np.float64)
    context_hash = _contexts(words)
    levels = []
    for k in range(1, ORDER + 1):
        exists = place >= k - 1
        at_start = place == k - 1
        if k == ORDER:
            base = exists
            gram, context, count = hashes[k - 1][base], context_hash[k - 1][base], seen[base]
        else:
            # Distinct longer n-grams, one for each symbol before this n-gram.
            longer = np.flatnonzero(place >= k)
            _, first = np.unique(hashes[k][longer], return_index=True)
            inner = longer[first]
            outer = np.flatnonzero(at_start)
            rows = np.concatenate([inner, outer])
            gram, context = hashes[k - 1][rows], context_hash[k - 1][rows]
            count = np.concatenate([np.ones(len(inner)), seen[outer]])
        grams, first, which = np.unique(gram, return_index=True, return_inverse=True)
        total = np.bincount(which, weights=count, minlength=len(grams))
        contexts, of = np.unique(context[first], return_inverse=True)
        context_total = np.bincount(of, weights=total, minlength=len(contexts))
        once, twice = (total == 1).sum(), (total == 2).sum()
        discount = max(DISCOUNT_FLOOR, once / (once + 2 * twice) if once else DISCOUNT_FLOOR)
        taken = np.minimum(total, discount)
        share = (total - taken) / context_total[of]
        weight = np.bincount(of, weights=taken, minlength=len(contexts)) / context_total
        levels.append(Level(grams, share.astype(np.float32), contexts, weight.astype(np.float32)))
    return Model(levels, 1.0 / (1 + len(levels[0].grams)))


def _contexts(words: Words) -> list[np.ndarray]:
    """The hash of the symbols before each place, for n-grams of length 1 .. ORDER; the empty one is 0."""
    padded, _, place = _padded(words)
    target = np.flatnonzero(place > 0)
    out, current = [np.zeros(len(target), np.uint64)], np.zeros(len(padded), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(1, ORDER):
            current = mix(current * np.uint64(0xD6E8FEB86659FD93) + _earlier(padded, k) + np.uint64(k + 100))
            out.append(current[target])
    return out


def _look_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, missing: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), missing)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], missing)


def word_bits(models: list[Model], words: Words) -> np.ndarray:
    """Bits that each model needs for each distinct word, (models, words)."""
    n = len(words.offsets) - 1
    owner, place, hashes = _grams(words)
    if not len(owner):
        return np.zeros((len(models), n))
    context_hash = _contexts(words)
    # Places with the same ORDER symbols get the same figure; it is worked out once.
    with np.errstate(over="ignore"):
        full = hashes[ORDER - 1] + np.minimum(place, ORDER).astype(np.uint64)
    _, first, which = np.unique(full, return_index=True, return_inverse=True)
    depth = place[first]
    bits = np.empty((len(models), n))
    offsets = offsets_of(np.bincount(owner, minlength=n))
    for m, model in enumerate(models):
        p = np.full(len(first), model.uniform)
        for k, level in enumerate(model.levels):
            share = _look_up(level.grams, level.share, hashes[k][first], 0.0)
            weight = _look_up(level.contexts, level.weight, context_hash[k][first], 1.0)
            p = np.where(depth >= k, share + weight * p, p)
        bits[m] = sums(-np.log2(p)[which], offsets)
    return bits


class Memory:
    """The bits of words met before, by word."""

    def __init__(self, n_models: int):
        self.rows: dict[bytes, int] = {}
        self.bits = np.empty((n_models, KNOWN_WORDS))

    def word_bits(self, models: list[Model], words: Words) -> np.ndarray:
        row = np.array([self.rows.get(key, -1) for key in words.keys], np.int64)
        bits = self.bits[:, row]
        new = np.flatnonzero(row < 0)
        if len(new):
            bits[:, new] = word_bits(models, words.some(new))
            keep = [i for i in new.tolist() if len(words.keys[i]) <= 4 * KNOWN_LETTERS][:KNOWN_WORDS]
            if len(self.rows) + len(keep) > KNOWN_WORDS:
                self.rows.clear()
            begin = len(self.rows)
            self.bits[:, begin : begin + len(keep)] = bits[:, keep]
            self.rows.update((words.keys[i], begin + j) for j, i in enumerate(keep))
        return bits


def text_bits(
    models: list[Model], texts: list[str], memory: Memory | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Bits per letter of each text under each model, (models, texts), and the letters (word ends included)."""
    words = distinct_words(texts)
    per_word = memory.word_bits(models, words) if memory else word_bits(models, words)
    length = (np.diff(words.offsets) + 1)[words.at] if len(words.at) else np.zeros(0, np.int64)
    letters = sums(length, words.text_offsets)
    bits = np.array([sums(b[words.at], words.text_offsets) for b in per_word]).reshape(len(models), len(texts))
    return bits / np.maximum(letters, 1), letters


class Identifier(NamedTuple):
    """Models in the order of their languages, and what each language's calibration texts showed."""

    languages: list[str]
    models: list[Model]
    mean: np.ndarray
    deviation: np.ndarray  # between texts
    noise: np.ndarray  # per letter, falls with the root of the length

    def predict(self, texts: list[str], memory: Memory | None = None) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and whether it is rejected. The score is the best language's share when each counts
        2 ** -(bits of 20 letters); it is 1 / languages at worst."""
        if not self.languages:
            return [UND] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        bits, letters = text_bits(self.models, texts, memory)
        best = bits.argmin(axis=0)
        least = bits[best, np.arange(len(texts))]
        score = 1.0 / np.exp2(-20.0 * (bits - least)).sum(axis=0)
        spread = np.hypot(self.deviation[best], self.noise[best] / np.sqrt(np.maximum(letters, 1)))
        limit = self.mean[best] + REJECT_BITS + REJECT_DEVIATIONS * spread
        none = letters == 0
        names = [UND if e else self.languages[b] for b, e in zip(best, none)]
        return names, np.where(none, 0.0, score), none | (least > limit)


def learnable(doc_id: str = "doc_id") -> Column:
    """True for rows that may be learned from; the other quarter is held out."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(4)) != 2


def sample(docs: DataFrame, chars: int = SAMPLE_CHARS) -> DataFrame:
    """Labelled texts of about ``chars`` characters per language: ``lang``, ``text``.

    A text is drawn by a hash of itself, with the chance that makes the language's draw as large as asked; the chance is taken
    from the different texts, so that copies take no room. The text of the least hash is drawn in any case, so every
    language has one. Of a long text a piece is taken from a place that its hash tells.
    """
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    hashed, size = F.xxhash64("text"), F.length("text")
    place = F.pmod(hashed, F.greatest(size - MAX_SAMPLE_TEXT, F.lit(0)) + 1).cast("int") + 1
    labelled = known.select(
        "lang", F.col("text").substr(place, F.lit(MAX_SAMPLE_TEXT)).alias("text"), hashed.alias("hash"),
        F.least(size, F.lit(MAX_SAMPLE_TEXT)).alias("size"),
    )
    draw = F.pmod("hash", F.lit(1 << 30))
    different = labelled.select("lang", "hash", "size").distinct()
    totals = different.groupBy("lang").agg(F.sum("size").alias("n"), F.count("*").alias("texts"), F.min(draw).alias("least"))
    drawn = F.lit(False)
    for lang, n, texts, least in totals.orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES).collect():
        chance = min(1.0, max(chars / max(n, 1), SAMPLE_TEXTS / texts))
        drawn = drawn | ((F.col("lang") == lang) & (draw <= max(int(chance * (1 << 30)), least)))
    return labelled.filter(drawn).select("lang", "text")


def learn(docs: DataFrame, chars: int = SAMPLE_CHARS) -> Identifier:
    """Models of the languages of the rows of ``docs`` (``text``, ``lang``); take ``learnable`` rows only.

    What reaches the driver is the sample, whose size does not grow with ``docs``.
    """
    texts: dict[str, set[str]] = {}
    for lang, text in sample(docs, chars).distinct().collect():  # copies of a text are drawn together
        texts.setdefault(lang, set()).add(text)
    return identifier(texts)


def identifier(texts: dict[str, set[str]]) -> Identifier:
    """Fit and calibrate on the texts of each language; the result does not depend on their order."""
    names, models, figures = [], [], []
    for lang in sorted(texts):
        ordered = sorted(texts[lang])
        fitted, held = [t for i, t in enumerate(ordered) if i % 4], ordered[::4]
        words = distinct_words(fitted or held)
        if not len(words.at):
            continue
        names.append(lang)
        models.append(fit(words, np.bincount(words.at, minlength=len(words.offsets) - 1)))
        bits, letters = text_bits(models[-1:], held)
        bits, letters = bits[0][letters > 0], letters[letters > 0]
        if not len(bits):
            bits, letters = np.zeros(1), np.ones(1)
        long = letters >= np.median(letters)
        mean = np.average(bits, weights=letters)
        figures.append((mean, np.std(bits[long]), np.std((bits - mean) * np.sqrt(letters))))
    mean, deviation, noise = np.array(figures).reshape(-1, 3).T
    return Identifier(names, models, mean, deviation, noise)


def identify(docs: DataFrame, known: Identifier) -> DataFrame:
    """``(doc_id, lang_pred, score, rejected)`` of every row of ``docs`` (``doc_id``, ``text``)."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(known)  # a few MB for each language, bounded by the sample

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = Memory(len(shared.value.models))
        for chunk in text_chunks(batches, "text", limit=PIECE_BYTES):
            texts = ["" if t is None else t for t in chunk.column("text").to_pylist()]
            names, score, rejected = shared.value.predict(texts, memory)
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(rejected)],
                names=["doc_id", "lang_pred", "score", "rejected"],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        predict, f"doc_id {id_type}, lang_pred string, score double, rejected boolean"
    )


def accepted(docs: DataFrame, known: Identifier) -> DataFrame:
    """The rows of ``docs``, with all their columns, that are not rejected."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(known)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = Memory(len(shared.value.models))
        for chunk in text_chunks(batches, "text", limit=PIECE_BYTES):
            texts = ["" if t is None else t for t in chunk.column("text").to_pylist()]
            yield chunk.filter(pa.array(~shared.value.predict(texts, memory)[2]))

    return docs.mapInArrow(keep, docs.schema)
