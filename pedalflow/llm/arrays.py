"""Helpers on flat numpy arrays that hold many texts or lists at once."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts are worked on in pieces of about this many bytes, so a task's memory does not depend on its batch.
CHUNK_BYTES = 4 << 20

_FACTOR = 0x9E3779B97F4A7C15
_WORD = 1 << 64
_FACTOR_INVERSE = pow(_FACTOR, -1, _WORD)


def text_chunks(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES, rows: int = 4000
) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of at most ``rows`` rows and ``limit`` bytes of ``column``, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        begin = 0
        while begin < batch.num_rows:
            before = ends[begin - 1] if begin else 0
            end = max(begin + 1, min(begin + rows, int(np.searchsorted(ends, before + limit, "right"))))
            yield batch.slice(begin, end - begin)
            begin = end
    give_back_memory()


def give_back_memory() -> None:
    """Return freed memory to the system: Spark keeps Python workers between tasks, and others need the room."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library has no such call
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def as_bytes(column: pa.Array) -> list[bytes]:
    """The texts as UTF-8; null is empty."""
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def offsets_of(sizes) -> np.ndarray:
    offsets = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    return offsets


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, ... of every range, one range after the other."""
    total = int(sizes.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(sizes)
    return np.arange(total) + np.repeat(starts - (ends - sizes), sizes)


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of each slice of ``values``; an empty slice gives 0."""
    totals = np.concatenate([[0], np.cumsum(values)])
    return totals[offsets[1:]] - totals[offsets[:-1]]


def mix(values: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values one to one (the finisher of the public-domain splitmix64)."""
    with np.errstate(over="ignore"):
        x = values.astype(np.uint64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power_table(name: str, base: int, size: int) -> np.ndarray:
    if len(_powers[name]) < size:
        with np.errstate(over="ignore"):
            steps = np.full(max(size, CHUNK_BYTES + 1), base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers[name]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each slice of the bytes ``data``, equal for equal slices wherever they stand."""
    up = _power_table("up", _FACTOR, len(data) + 1)
    down = _power_table("down", _FACTOR_INVERSE, len(data) + 1)
    with np.errstate(over="ignore"):
        totals = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=totals[1:])
        slices = (totals[ends] - totals[starts]) * down[starts]
        return mix(slices + (ends - starts).astype(np.uint64))


def runs(is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.diff(np.concatenate([[False], is_word, [False]]).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
