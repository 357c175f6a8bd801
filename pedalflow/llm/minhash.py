"""Near duplicates by a multi-index Hamming join of b-bit MinHash signatures.

A signature has ``HASHES`` values of 16 bits; two documents of similarity J differ in each with chance 1 - J. Pairs at the
asked similarity differ in more than ``max_distance`` values with a chance below one in ten thousand. The signature is
split into chunks, so few that of two signatures within the distance some chunk differs in one value at most
(pigeonhole). So each document is entered under every chunk with every one of its values left out: two documents within
the distance share one of these keys for certain.

Documents that share a key and are within the distance are joined to clusters, in tasks that hold one bounded block pair
of a key. In a cluster the whole shingle sets are compared, again by bounded block pairs; only these links count. Documents
with equal sets are one member from the start, so groups of exact copies cost one.

Words are lower-cased (A-Z) runs without white space. A document's set is its distinct shingles (compared by 52-bit hashes);
with fewer words than a shingle it is the whole sequence; without words it is empty and the document links with nothing,
as does one whose doc_id is null (component_id null, kept). Rows with one doc_id are one document for linking. Ties
cannot occur: a component's id is its smallest doc_id. An empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pedalflow.llm import bitmaps
from pedalflow.llm.arrays import LOWER, as_bytes, mix, offsets_of, ranges, span_hashes, sums, text_chunks
from pedalflow.llm.links import by_runs, components_within, in_block_pairs, roots, stars, whole_runs
from pedalflow.llm.scratch import stored
from pedalflow.llm.ship import ship

HASHES = 64
# A block of a key holds about so many signatures, one of a cluster about so many shingles (16 MB).
KEY_BLOCK, SET_BLOCK = 4096, 2_000_000

_WHITE = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])
_LOWER = np.frombuffer(LOWER, np.uint8)
_HASH_BITS = 52
_FACTORS = mix(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)


def max_distance(percent: int) -> int:
    """Signature values that may differ: the expected number and four standard deviations."""
    p = 1 - percent / 100
    return math.ceil(HASHES * p + 4 * math.sqrt(HASHES * p * (1 - p)))


def chunk_bounds(distance: int) -> np.ndarray:
    """Where the chunks begin: so many that one of them has an error at most."""
    n = min(distance // 2 + 1, HASHES // 2)
    return np.arange(n + 1) * HASHES // n


def shingle_sets(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text in order, flat, and their offsets. At most 4096 texts."""
    data = _LOWER[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
    edge = np.diff(np.concatenate([[0], (~_WHITE[data]).view(np.int8), [0]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    words = span_hashes(data, starts, ends)
    text_starts = offsets_of([len(t) + 1 for t in texts])
    word_offsets = np.searchsorted(starts, text_starts)
    n_words = np.diff(word_offsets)

    hashes, owners = [], []
    for length in range(1, size + 1):
        # Texts shorter than a shingle give one of their own length.
        some = np.flatnonzero(n_words >= size if length == size else n_words == length)
        count = n_words[some] - length + 1
        at = ranges(word_offsets[some], count)
        value = np.full(len(at), length, np.uint64)
        with np.errstate(over="ignore"):
            for k in range(length):
                value = mix(value * np.uint64(0x9E3779B97F4A7C15) + words[at + k])
        hashes.append(value)
        owners.append(np.repeat(some, count))
    value, owner = np.concatenate(hashes), np.concatenate(owners)
    both = (owner.astype(np.uint64) << np.uint64(_HASH_BITS)) | (value >> np.uint64(64 - _HASH_BITS))
    both.sort()
    if len(both):
        both = both[np.concatenate([[True], both[1:] != both[:-1]])]
    counts = np.bincount((both >> np.uint64(_HASH_BITS)).astype(np.int64), minlength=len(texts))
    return both & np.uint64((1 << _HASH_BITS) - 1), offsets_of(counts)


def signatures(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """MinHash values of each set, (sets, HASHES); those of an empty set are 0."""
    out = np.zeros((len(offsets) - 1, HASHES), np.uint16)
    full = np.diff(offsets) > 0
    if full.any():
        begin = offsets[:-1][full]
        with np.errstate(over="ignore"):
            for k in range(HASHES):
                hashed = (values * _FACTORS[k] >> np.uint64(32)).astype(np.uint32)
                out[full, k] = np.minimum.reduceat(hashed, begin) & 0xFFFF
    return out


def index_keys(sigs: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One key for each signature and value left out, (signatures, HASHES)."""
    with np.errstate(over="ignore"):
        salted = mix(sigs.astype(np.uint64) + (np.arange(HASHES, dtype=np.uint64) << np.uint64(20)))
        chunk = np.add.reduceat(salted, bounds[:-1], axis=1)
        of = np.searchsorted(bounds, np.arange(HASHES), "right") - 1
        return mix(chunk[:, of] - salted + _FACTORS).view(np.int64)


def _binary(rows: np.ndarray) -> pa.Array:
    width = rows.shape[1] * rows.itemsize
    fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(rows), [None, pa.py_buffer(np.ascontiguousarray(rows))])
    return fixed.cast(pa.binary())


def signature_table(docs: DataFrame, size: int) -> DataFrame:
    """``(doc_id, n_shingles, set_key, signature)`` of every row; equal sets have equal keys (128-bit digests of the sets)."""
    ship(docs.sparkSession)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches, "text"):
            values, offsets = shingle_sets(as_bytes(chunk.column("text")), size)
            ends = offsets.tolist()
            keys = [hashlib.blake2b(values[a:b].tobytes(), digest_size=16).digest() for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    chunk.column("doc_id"),
                    pa.array(np.diff(offsets), pa.int64()),
                    pa.array(keys, pa.binary()),
                    _binary(signatures(values, offsets)),
                ],
                names=["doc_id", "n_shingles", "set_key", "signature"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        sign, f"doc_id {_id_type(docs)}, n_shingles bigint, set_key binary, signature binary"
    )


def _id_type(df: DataFrame, column: str = "doc_id") -> str:
    return df.schema[column].dataType.simpleString()


def _read_signatures(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, np.uint16).reshape(-1, HASHES)


def _ids(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False) if isinstance(column, pa.Array) else column.to_numpy()


def _edge_batch(ids: list[np.ndarray], lowest: list[np.ndarray], kind: pa.DataType) -> pa.RecordBatch:
    src = np.concatenate(ids) if ids else np.zeros(0, np.int64)
    dst = np.concatenate(lowest) if lowest else np.zeros(0, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(src, kind), pa.array(dst, kind)], names=["src", "dst"])


def candidate_edges(members: DataFrame, distance: int) -> DataFrame:
    """``(src, dst)`` that connect all ``members`` (``id``, ``signature``) within the distance of one another."""
    bounds = chunk_bounds(distance)
    id_type = _id_type(members, "id")

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 2000):
                part = batch.slice(begin, 2000)
                keys = index_keys(_read_signatures(part.column("signature")), bounds)
                ids = part.column("id").take(pa.array(np.repeat(np.arange(part.num_rows), HASHES)))
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), ids], names=["key", "id"])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, offsets in whole_runs(batches, "key"):
            ids, sigs = _ids(table.column("id")), _read_signatures(table.column("signature"))
            size = np.diff(offsets)
            two = offsets[:-1][size == 2]
            near = (sigs[two] != sigs[two + 1]).sum(1) <= distance
            a, b = ids[two][near], ids[two + 1][near]
            found, lowest = [np.maximum(a, b)], [np.minimum(a, b)]
            for begin, end in zip(offsets[:-1][size > 2].tolist(), offsets[1:][size > 2].tolist()):
                run = sigs[begin:end]
                label = components_within(end - begin, lambda i, rest: (run[rest] != run[i]).sum(1) <= distance)
                src, dst = stars(ids[begin:end], label)
                found.append(src)
                lowest.append(dst)
            yield _edge_batch(found, lowest, table.column("id").type)

    keys = members.mapInArrow(enter, f"key bigint, id {id_type}")
    shared = stored(keys.groupBy("key").agg(F.count("*").alias("_n")).filter("_n > 1"), "minhash-keys")
    hits = keys.join(shared, "key").join(members.select("id", "signature"), "id")
    paired = in_block_pairs(hits, F.ceil(F.col("_n") / KEY_BLOCK), "id").select("key", "_low", "_high", "id", "signature")
    return by_runs(paired, "key").mapInArrow(link, f"src {id_type}, dst {id_type}").distinct()


def confirmed_edges(docs: DataFrame, clusters: DataFrame, size: int, percent: int) -> DataFrame:
    """``(src, dst)`` that connect the documents of a cluster whose whole sets are similar enough.

    ``clusters``: ``id``, ``root``, ``n_shingles``.
    """
    id_type = _id_type(docs)
    weight = clusters.groupBy("root").agg(F.ceil(F.sum("n_shingles") / SET_BLOCK).alias("_n"))
    members = clusters.join(weight, "root").select("id", "root", "_n")

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches, "text"):
            values, offsets = shingle_sets(as_bytes(chunk.column("text")), size)
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [*(chunk.column(c) for c in ("id", "root", "_n")), lists], names=["id", "root", "_n", "shingles"]
            )

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, offsets in whole_runs(batches, "root"):
            ids = _ids(table.column("id"))
            lists = table.column("shingles").combine_chunks()
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            ends = offsets_of(lists.value_lengths().to_numpy(zero_copy_only=False))
            found, lowest = [], []
            for begin, end in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                if end - begin < 2:
                    continue
                label = similar_components(flat[ends[begin] : ends[end]], ends[begin : end + 1] - ends[begin], percent)
                src, dst = stars(ids[begin:end], label)
                found.append(src)
                lowest.append(dst)
            yield _edge_batch(found, lowest, table.column("id").type)

    # Texts outside all clusters are passed over before the shuffle.
    given = bitmaps.with_chance(
        docs.select(F.col("doc_id").alias("id"), "text"), [F.col("id")], bitmaps.pages(clusters.select("id")), "_chance"
    )
    texts = given.filter("_chance").drop("_chance").join(members, "id")
    sets = texts.mapInArrow(to_sets, f"id {id_type}, root {id_type}, _n bigint, shingles array<bigint>")
    paired = in_block_pairs(sets, F.col("_n"), "id")
    return by_runs(paired, "root").mapInArrow(link, f"src {id_type}, dst {id_type}").distinct()


def similar_components(flat: np.ndarray, offsets: np.ndarray, percent: int) -> np.ndarray:
    """The component of each set, linked where 100 * intersection >= percent * union."""
    _, dense = np.unique(flat, return_inverse=True)
    sizes = np.diff(offsets)
    held = np.zeros(int(dense.max()) + 1 if len(dense) else 1, np.int64)

    def near(i: int, rest: np.ndarray) -> np.ndarray:
        own = dense[offsets[i] : offsets[i + 1]]
        # Sets of too different sizes cannot be similar.
        close = (100 * np.minimum(sizes[rest], sizes[i]) >= percent * np.maximum(sizes[rest], sizes[i])) & (sizes[rest] > 0)
        some = rest[close]
        held[own] = 1
        common = sums(held[dense[ranges(offsets[some], sizes[some])]], offsets_of(sizes[some]))
        held[own] = 0
        out = close.copy()
        out[close] = 100 * common >= percent * (sizes[some] + sizes[i] - common)
        return out

    return components_within(len(sizes), near)


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` of every row of ``docs`` (``doc_id``, ``text``)."""
    signed = stored(signature_table(docs, size), "minhash-signatures")
    linkable = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    members = stored(
        linkable.groupBy("set_key").agg(
            F.min("doc_id").alias("id"), F.any_value("signature").alias("signature"), F.any_value("n_shingles").alias("n_shingles")
        ),
        "minhash-members",
    )
    candidates = stored(candidate_edges(members, max_distance(percent)), "minhash-candidates")
    clusters = roots(candidates).join(members.select("id", "n_shingles"), "id")
    links = stored(confirmed_edges(docs, stored(clusters, "minhash-clusters"), size, percent), "minhash-links")
    linked = roots(links)
    # Every document to the smallest id with its set, and that to the smallest id it is connected with.
    smallest = members.select("set_key", "id").join(linked, "id", "left")
    component = stored(smallest.select("set_key", F.coalesce("root", "id").alias("component_id")), "minhash-components")
    labelled = signed.join(component, "set_key", "left")
    known = F.when(F.col("doc_id").isNotNull(), F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
    return labelled.select("doc_id", "n_shingles", known.alias("component_id"), F.col("doc_id").eqNullSafe(known).alias("kept"))


def without_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row of ``docs``, with all its columns, of each group of near duplicates: that with the smallest doc_id.

    Every row is a document of its own here, whatever doc_id it has, so a text that is near nothing stays, also if its doc_id has
    another text. Rows without doc_id come after those with one; of rows with one doc_id that with the least digest of its
    text stays, then that whose columns have the least hash. Rows without words all stay.
    """
    # Written once with numbers of their own, so that what is told apart by these is the same row in every pass.
    rows = stored(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("_row_id")), "near-rows")
    texts = rows.select(F.col("_row_id").alias("doc_id"), F.col("row.text").alias("text"))
    found = near_duplicates(texts, size, percent).filter("n_shingles > 0").select(F.col("doc_id").alias("_row_id"), "component_id")
    found = stored(found, "near-components")
    groups = found.groupBy("component_id").agg(F.count("*").alias("_n")).filter("_n > 1").select("component_id")
    grouped = stored(found.join(groups, "component_id"), "near-groups")
    chance = bitmaps.with_chance(rows, [F.col("_row_id")], bitmaps.pages(grouped.select("_row_id")), "_grouped").filter("_grouped")
    sha = F.sha2(F.coalesce(F.col("row.text"), F.lit("")), 256)
    rank = F.struct(F.col("row.doc_id").isNull(), F.col("row.doc_id"), sha, F.xxhash64(F.to_json("row")), F.col("_row_id"))
    ranked = stored(chance.select("_row_id", rank.alias("_rank")).join(grouped, "_row_id"), "near-ranked")
    # Combined before the shuffle, so a large group is a row from each task.
    first = ranked.groupBy("component_id").agg(F.min("_rank").alias("_first"))
    gone = stored(ranked.join(first, "component_id").filter("_rank != _first").select(F.col("_row_id").alias("_gone")), "near-copies")
    marked = bitmaps.with_chance(rows, [F.col("_row_id")], bitmaps.pages(gone), "may_go")
    left = marked.filter("may_go").join(gone, F.col("_row_id") == F.col("_gone"), "left_anti")
    return marked.filter("NOT may_go").select("row").unionByName(left.select("row")).select("row.*")
