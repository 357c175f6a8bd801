"""Near-duplicate vectors by randomised-rotation binary codes (after RaBitQ, Gao and Long 2024).

A unit vector u is rotated at random, R u, and kept as the signs s of its coordinates, with the factor f = <s, R u> / sqrt(d).
For any other unit vector v, <s, R v> / sqrt(d) / f is an unbiased estimate of <u, v>, and its error exceeds
``ERROR_BOUND`` * sqrt((1 - f^2) / f^2 / (d - 1)) with vanishing chance. A pair whose estimate plus that bound is below the
asked cosine is out; only the others are computed anew, in double precision, and only that result makes a link.

Which pairs are looked at is settled by further random projections: vectors share a bucket of a table if all their signs in
it agree. The number of signs follows the logarithm of the number of vectors (about 16 vectors to a bucket), and there are
so many tables that a pair at the asked cosine misses all of them with a chance of ``MISS``; closer pairs miss less.
A pair counts in the first table that it shares. Buckets are compared in bounded block pairs (``links``).

Equal vectors are one member with a multiplicity. Vectors that are null, empty, zero or hold null, infinite or NaN
components link with nothing (0 links, their own component); so do rows with a null vec_id (component null). Vectors of
different lengths are never linked. Rows that repeat vec_id and vector count each other as links; where a vec_id has several
vectors, each row counts the links of its own vector, and the rows are one document as far as components go. An empty table gives an
empty table; labels and other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pedalflow.llm.arrays import mix, offsets_of, ranges
from pedalflow.llm.links import by_runs, in_block_pairs, roots, whole_runs
from pedalflow.llm.scratch import stored
from pedalflow.llm.ship import ship

COSINE, MISS, ERROR_BOUND = 0.9, 0.01, 4.0
BUCKET_BITS, BUCKET_BLOCK = 4, 4096
PAIR_SLICE = 100_000
_SEED = 20_240_521


def table_shape(n: int, cosine: float = COSINE) -> tuple[int, int]:
    """Signs of a table's key and number of tables for ``n`` vectors."""
    bits = min(max(round(math.log2(max(n, 1))) - BUCKET_BITS, 6), 40)
    agree = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(MISS) / math.log(1 - agree))


@lru_cache(maxsize=8)
def _rotation(dim: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng([_SEED, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


@lru_cache(maxsize=8)
def _planes(dim: int, bits: int, tables: int) -> np.ndarray:
    return np.random.default_rng([_SEED, dim, 1]).standard_normal((dim, bits * tables))


def table_keys(unit: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """The key of each vector in each table."""
    signs = (unit @ _planes(unit.shape[1], bits, tables) > 0).reshape(len(unit), tables, bits)
    number = signs @ (np.uint64(1) << np.arange(bits, dtype=np.uint64))
    place = np.arange(tables, dtype=np.uint64) + np.uint64(unit.shape[1] << 20)
    with np.errstate(over="ignore"):
        return mix(number + mix(place + np.uint64(1))).view(np.int64)


class Codes:
    """Unit vectors with their rotated form, binary codes and correction factors."""

    def __init__(self, unit: np.ndarray):
        dim = unit.shape[1]
        self.unit = unit
        self.rotated = (unit @ _rotation(dim).T).astype(np.float32)
        self.signs = np.where(self.rotated > 0, 1, -1).astype(np.int8)
        self.factor = np.abs(self.rotated).sum(1) / np.sqrt(dim)
        self.bound = ERROR_BOUND * np.sqrt(np.maximum(1 - self.factor**2, 0) / self.factor**2 / max(dim - 1, 1))

    def estimates(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Estimated cosines, from the codes of ``i`` and the rotated vectors ``j``."""
        raw = np.einsum("ij,ij->i", self.signs[i], self.rotated[j], dtype=np.float32)
        return raw / np.sqrt(self.unit.shape[1]) / self.factor[i]

    def linked(self, i: np.ndarray, j: np.ndarray, cosine: float) -> np.ndarray:
        """Which of the pairs have at least this cosine; the codes say which of them need computing."""
        maybe = np.flatnonzero(self.estimates(i, j) + self.bound[i] >= cosine)
        exact = np.einsum("ij,ij->i", self.unit[i[maybe]], self.unit[j[maybe]])
        return maybe[exact >= cosine]


def _unit(raw: list[bytes], kind: str) -> np.ndarray:
    rows = np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float64)
    largest = np.abs(rows).max(1, keepdims=True)
    rows = rows / largest  # squares of very large or small components would not fit
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def _by_length(raw: list[bytes]) -> list[np.ndarray]:
    sizes = np.array([len(r) for r in raw])
    return [np.flatnonzero(sizes == s) for s in np.unique(sizes)]


def links_of(codes: Codes, offsets: np.ndarray, own: np.ndarray, same_block: np.ndarray, cosine: float):
    """The linked pairs inside the runs; of two blocks only pairs between them."""
    row = np.arange(int(offsets[-1]))
    end = np.repeat(offsets[1:], np.diff(offsets))
    count = end - row - 1
    done = 0
    ends = np.cumsum(count)
    while done < len(row):
        before = ends[done - 1] if done else 0
        until = max(done + 1, int(np.searchsorted(ends, before + PAIR_SLICE, "right")))
        part = slice(done, until)
        i, j = np.repeat(row[part], count[part]), ranges(row[part] + 1, count[part])
        fit = same_block[i] | (own[i] != own[j])
        i, j = i[fit], j[fit]
        hit = codes.linked(i, j, cosine)
        yield i[hit], j[hit]
        done = until


def lowest_reachable(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The lowest member connected with each of ``n`` members by the links."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def near_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of every row of ``vectors`` (``vec_id``, ``embedding``)."""
    spark = vectors.sparkSession
    ship(spark)
    id_type = vectors.schema["vec_id"].dataType.simpleString()
    kind = "<f4" if vectors.schema["embedding"].dataType.elementType.simpleString() == "float" else "<f8"

    element = F.col("embedding")
    sound = (
        F.col("vec_id").isNotNull()
        & F.coalesce(F.forall(element, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x)), F.lit(False))
        & F.coalesce(F.exists(element, lambda x: x != 0), F.lit(False))
    )
    rows = vectors.select("vec_id", F.when(sound, element).alias("_vector"))
    members = stored(
        rows.filter("_vector IS NOT NULL")
        .groupBy("_vector")
        .agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"))
        .withColumn("member", F.monotonically_increasing_id()),  # ids can repeat with other vectors
        "vectors",
    )
    bits, tables = table_shape(members.count(), cosine)

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 2000):
                part = batch.slice(begin, 2000)
                lists = part.column("_vector")
                flat = lists.flatten().to_numpy(zero_copy_only=False).astype(kind)
                ends = offsets_of(lists.value_lengths().to_numpy(zero_copy_only=False)).tolist()
                raw = [flat[a:b].tobytes() for a, b in zip(ends, ends[1:])]
                for same in _by_length(raw):
                    here = [raw[i] for i in same.tolist()]
                    keys = table_keys(_unit(here, kind), bits, tables)
                    at = np.repeat(np.arange(len(same)), tables)
                    rows_at = pa.array(same[at])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(keys.ravel()),
                            pa.array(np.tile(np.arange(tables, dtype=np.int32), len(same))),
                            part.column("id").take(rows_at),
                            part.column("copies").take(rows_at),
                            part.column("member").take(rows_at),
                            pa.array(here, pa.binary()).take(pa.array(at)),
                        ],
                        names=["key", "table", "id", "copies", "member", "raw"],
                    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run_table, offsets in whole_runs(batches, "key"):
            ids, copies = run_table.column("id").to_numpy(), run_table.column("copies").to_numpy()
            members_here = run_table.column("member").to_numpy()
            table, own = run_table.column("table").to_numpy(), run_table.column("_own").to_numpy()
            same_block = run_table.column("_low").to_numpy() == run_table.column("_high").to_numpy()
            raw = run_table.column("raw").to_pylist()
            for same in _by_length(raw):  # a key belongs to one length, so runs stay whole
                unit = _unit([raw[i] for i in same.tolist()], kind)
                codes, keys = Codes(unit), table_keys(unit, bits, tables)
                run_of = np.searchsorted(offsets, same, "right")
                here = np.concatenate([[0], np.flatnonzero(np.diff(run_of)) + 1, [len(same)]])
                i, j = [], []
                for a, b in links_of(codes, here, own[same], same_block[same], cosine):
                    # Only in the first table that the two share.
                    earlier = (keys[a] == keys[b]) & (np.arange(tables) < table[same][a][:, None])
                    first = ~earlier.any(1)
                    i.append(a[first])
                    j.append(b[first])
                a, b = np.concatenate(i or [here[:0]]), np.concatenate(j or [here[:0]])
                n = len(same)
                links = np.bincount(a, copies[same][b], n) + np.bincount(b, copies[same][a], n)
                # A star on the lowest id of what is connected in the run.
                order = np.argsort(ids[same], kind="stable")
                place = np.empty(n, np.int64)
                place[order] = np.arange(n)
                root = ids[same][order[lowest_reachable(n, place[a], place[b])[place]]]
                some = links > 0
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[same][some], run_table.column("id").type),
                        pa.array(members_here[same][some]),
                        pa.array(links[some].astype(np.int64)),
                        pa.array(root[some], run_table.column("id").type),
                    ],
                    names=["id", "member", "links", "root"],
                )

    entered = members.mapInArrow(enter, f"key bigint, table int, id {id_type}, copies bigint, member bigint, raw binary")
    large = stored(
        entered.groupBy("key").agg(F.count("*").alias("_n")).filter(F.col("_n") > BUCKET_BLOCK), "vector-buckets"
    )
    blocks = F.coalesce(F.ceil(F.col("_n") / BUCKET_BLOCK), F.lit(1))
    paired = in_block_pairs(entered.join(large, "key", "left"), blocks, "member").drop("_n")
    found = stored(
        by_runs(paired, "key").mapInArrow(compare, f"id {id_type}, member bigint, links bigint, root {id_type}"), "vector-links"
    )
    counts = found.groupBy("member").agg(F.sum("links").alias("links"))
    edges = found.filter("id != root").select(F.col("id").alias("src"), F.col("root").alias("dst")).distinct()
    component = roots(stored(edges, "vector-edges"))
    known = stored(members.join(counts, "member", "left").join(component, "id", "left"), "vector-members").select(
        F.col("_vector").alias("_same"), "id", "copies", "links", "root"
    )
    joined = rows.join(known, F.col("_vector") == F.col("_same"), "left")
    lowest = F.coalesce("root", "id", "vec_id")
    return joined.select(
        "vec_id",
        F.coalesce(F.col("copies") - 1 + F.coalesce("links", F.lit(0)), F.lit(0)).cast("bigint").alias("n_links"),
        lowest.alias("component_id"),
        F.col("vec_id").eqNullSafe(lowest).alias("kept"),
    )
