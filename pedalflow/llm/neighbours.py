"""Approximate nearest neighbours by learned partitions (after Dong, Indyk, Razenshteyn and Wagner, "Learning Space Partitions
for Nearest Neighbor Search", 2020).

The index is fitted on a sample of at most ``SAMPLE`` vectors. Their neighbour graph by inner product is cut into 2, 4, ... parts
of equal size, each cut refined by swaps that leave fewer links cut. A small network learns to tell from a vector in which
parts its neighbours are. It puts every vector of the table into its likeliest part, and sends every query to its ``probes``
likeliest ones; their vectors are ranked by the exact inner product in double precision, summed from left to right. ``probes``
is the least number for which a held-out quarter of the sample finds ``TARGET`` of its true neighbours, all parts if need be,
so it does not rest on how the vectors lie. Where the table is so small that there is one part, the search is exact.

The number of parts grows with the table up to ``MAX_PARTS``; from there on parts grow. Parts are compared in blocks of bounded
size, every block of queries with every block of vectors, so no part needs to fit in a task, and there is no cap on one.

Equal vectors are one entry of the index with its ``k + 1`` smallest ids, which are all that a list of k can show of them, and
equal queries are searched once; so a hot vector costs no more than any other.

Vectors that are null, empty, zero or hold null, infinite or NaN components take no part, nor do rows with a null vec_id.
Vectors of another length than the sample's commonest are compared with those of their length, all of them. Rows that repeat
vec_id and vector count once; if a vec_id has several vectors, each is a query of its own, and the others are candidates. Ties
go to the smaller vec_id. An empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pedalflow.llm.arrays import offsets_of
from pedalflow.llm.links import by_runs, whole_runs
from pedalflow.llm.scratch import stored
from pedalflow.llm.ship import ship

NEAREST, EVERY = 20, 20
SAMPLE, PART_ROWS, MAX_PARTS = 16_384, 512, 512
TARGET = 0.95
GRAPH_LINKS, HIDDEN, EPOCHS, BATCH = 16, 128, 24, 512
BASE_BLOCK, QUERY_BLOCK = 4096, 1024
KEPT_ENTRIES = 400_000  # that a task holds before they go on (some 60 MB)
_SEED = 20_240_613
_ODD_PARTS = 256  # for vectors of other lengths


class Router(NamedTuple):
    """The network: how many parts, how many of them a query visits, and what was found of the held-out neighbours."""

    dim: int
    parts: int
    probes: int
    recall: float
    scale: float
    layers: list[np.ndarray]

    def scores(self, vectors: np.ndarray) -> np.ndarray:
        return _forward(self.layers, _features(vectors, self.scale))[1]


def _norms(vectors: np.ndarray) -> np.ndarray:
    largest = np.abs(vectors).max(1)
    return largest * np.sqrt(((vectors / largest[:, None]) ** 2).sum(1))


def _features(vectors: np.ndarray, scale: float) -> np.ndarray:
    """Vectors in units of the sample's typical length, of at most 4 of these."""
    norms = _norms(vectors)
    return (vectors / norms[:, None] * np.minimum(norms / scale, 4)[:, None]).astype(np.float32)


def _forward(layers: list[np.ndarray], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    w1, b1, w2, b2 = layers
    hidden = np.maximum(x @ w1 + b1, 0)
    return hidden, hidden @ w2 + b2


def nearest_in(vectors: np.ndarray, k: int) -> np.ndarray:
    """The k others of largest inner product for each vector."""
    k = min(k, len(vectors) - 1)
    found = np.empty((len(vectors), k), np.int64)
    for begin in range(0, len(vectors), 1024):
        rows = np.arange(begin, min(begin + 1024, len(vectors)))
        products = vectors[rows] @ vectors.T
        products[np.arange(len(rows)), rows] = -np.inf
        found[rows] = np.argpartition(-products, k - 1, 1)[:, :k]
    return found


def balanced_parts(links: np.ndarray, levels: int) -> np.ndarray:
    """The part of each vertex: the graph is halved ``levels`` times, in halves of equal size with few links between them."""
    n, k = links.shape
    a, b = np.repeat(np.arange(n), k), links.ravel()
    a, b = np.concatenate([a, b]), np.concatenate([b, a])
    part = np.zeros(n, np.int64)
    rng = np.random.default_rng(_SEED)
    for level in range(levels):
        inside = part[a] == part[b]
        u, v = a[inside], b[inside]
        degree = np.bincount(u, minlength=n) + 1.0
        size = np.bincount(part)
        side = rng.standard_normal(n)
        for _ in range(60):  # towards the slowest vector of a random walk inside each part
            side = (side + (np.bincount(u, side[v], n) + side) / degree) / 2
            side -= (np.bincount(part, side * degree) / np.bincount(part, degree))[part]
            side /= np.sqrt(np.bincount(part, side**2) / size)[part] + 1e-30
        order = np.lexsort((side, part))
        place = np.empty(n, np.int64)
        place[order] = np.arange(n) - offsets_of(size)[part[order]]
        half = place >= (size[part] + 1) // 2
        for _ in range(8):  # swap the vertices of both halves that gain most by it
            same = np.bincount(u, half[u] == half[v], n)
            gain = np.bincount(u, minlength=n) - 2 * same
            order = np.lexsort((-gain, half, part))
            group = 2 * part + half
            start = offsets_of(np.bincount(group, minlength=2 * len(size)))
            rank = np.empty(n, np.int64)
            rank[order] = np.arange(n) - start[group[order]]
            # The vertex of the same rank in the other half.
            twin = start[group ^ 1] + rank
            paired = rank < np.diff(start)[group ^ 1]
            partner = order[np.minimum(twin, n - 1)]
            swap = paired & (gain + gain[partner] > 2)  # a link between the two would be counted twice
            if not swap.any():
                break
            swap &= (rank % 2 == rng.integers(2)) | (gain > k)  # not all at once, for neighbours move together
            half ^= swap & swap[partner]
        part = 2 * part + half
    return part


def _train(x: np.ndarray, wanted: np.ndarray) -> list[np.ndarray]:
    """Two layers fitted to the wanted shares of parts, by Adam on the cross-entropy."""
    rng = np.random.default_rng(_SEED)
    sizes = ((x.shape[1], HIDDEN), (HIDDEN,), (HIDDEN, wanted.shape[1]), (wanted.shape[1],))
    layers = [(rng.standard_normal(s) * math.sqrt(2 / s[0])).astype(np.float32) if len(s) > 1 else np.zeros(s, np.float32) for s in sizes]
    first, second = [np.zeros_like(w) for w in layers], [np.zeros_like(w) for w in layers]
    step, steps = 0, EPOCHS * math.ceil(len(x) / BATCH)
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for begin in range(0, len(x), BATCH):
            rows = order[begin : begin + BATCH]
            hidden, out = _forward(layers, x[rows])
            out = np.exp(out - out.max(1, keepdims=True))
            error = (out / out.sum(1, keepdims=True) - wanted[rows]) / len(rows)
            back = (error @ layers[2].T) * (hidden > 0)
            step += 1
            rate = 0.004 * (1 - step / (steps + 1))
            for i, slope in enumerate((x[rows].T @ back, back.sum(0), hidden.T @ error, error.sum(0))):
                first[i] = 0.9 * first[i] + 0.1 * slope
                second[i] = 0.99 * second[i] + 0.01 * slope**2
                layers[i] = layers[i] - rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.99**step)) + 1e-8)
    return [w.astype(np.float32) for w in layers]


def fit(sample: np.ndarray, n: int, k: int = NEAREST, part_rows: int = PART_ROWS) -> Router:
    """The router for ``n`` vectors like those of ``sample``."""
    parts = min(n // part_rows, MAX_PARTS, len(sample) // 32)
    levels = int(math.log2(parts)) if parts > 1 else 0
    parts = 1 << levels
    scale = float(np.median(_norms(sample))) if len(sample) else 1.0
    if not levels:
        return Router(sample.shape[1], 1, 1, 1.0, scale, [])
    held_out = np.random.default_rng(_SEED).random(len(sample)) < 0.25
    known, asked = sample[~held_out] / scale, sample[held_out] / scale
    links = nearest_in(known, GRAPH_LINKS)
    part = balanced_parts(links, levels)
    wanted = np.zeros((len(known), parts), np.float32)
    np.add.at(wanted, (np.repeat(np.arange(len(known)), links.shape[1]), part[links].ravel()), 1)
    wanted[np.arange(len(known)), part] += 1
    wanted /= wanted.sum(1, keepdims=True)
    layers = _train(_features(sample[~held_out], scale), wanted)

    scores = _forward(layers, _features(sample[held_out], scale))[1]
    true = nearest_in(asked, k)
    visited = np.argsort(np.argsort(-scores, 1, kind="stable"), 1)  # when a query would visit each part
    when = np.take_along_axis(visited, scores.argmax(1)[true], 1)
    found = np.cumsum(np.bincount(when.ravel(), minlength=parts)) / when.size
    probes = min(int(np.searchsorted(found, TARGET)) + 1, parts)
    return Router(sample.shape[1], parts, probes, float(found[probes - 1]), scale, layers)


def best_of(queries: np.ndarray, base: np.ndarray, least: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each query the k rows of ``base`` with the largest inner product and these; of equal ones the lower ``least``."""
    products = queries @ base.T
    slack = 1e-12 * np.sqrt((queries**2).sum(1)) * math.sqrt((base**2).sum(1).max())
    if len(base) > k:
        cut = np.partition(products, len(base) - k, 1)[:, len(base) - k] - slack
    for i, row in enumerate(products):
        near = np.flatnonzero(row >= cut[i]) if len(base) > k else np.arange(len(base))
        exact = np.add.accumulate(queries[i] * base[near], 1)[:, -1]
        first = np.lexsort((least[near], -exact))[:k]
        yield near[first], exact[first]


def _sound(vector: Column) -> Column:
    return F.coalesce(
        F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x)) & F.exists(vector, lambda x: x != 0),
        F.lit(False),
    )


def members_of(vectors: DataFrame, k: int, every: int) -> tuple[DataFrame, DataFrame]:
    """``(key, vector, ids, asked)`` of each different vector, with its k + 1 smallest ids and whether a query has it; and
    ``(vec_id, identity)`` of all rows that take part. Kept in the shared folder."""
    # Adding zero makes both zeros one; the shortest decimal form of a number tells it apart from all others.
    text = F.transform("embedding", lambda x: x + F.lit(0).cast("float")).cast("string")
    sound = vectors.filter(F.col("vec_id").isNotNull() & _sound(F.col("embedding"))).select(
        "vec_id", F.unhex(F.sha2(text, 256)).alias("identity"), F.col("embedding").alias("vector")
    )
    rows = stored(sound.groupBy("vec_id", "identity").agg((F.col("vec_id") % every == 0).alias("asks")), "vector-rows")
    # The limit on a rank is applied before rows are shuffled, so a hot vector sends a few of them from each task.
    in_order = Window.partitionBy("identity", "asks").orderBy("vec_id")
    few = rows.withColumn("_rank", F.row_number().over(in_order)).filter(F.col("_rank") <= k + 1)
    ids = few.groupBy("identity").agg(F.slice(F.sort_array(F.collect_list("vec_id")), 1, k + 1).alias("ids"), F.max("asks").alias("asked"))
    different = sound.groupBy("identity").agg(F.first("vector").alias("vector"))
    members = different.join(ids, "identity").withColumn("key", F.monotonically_increasing_id())
    return stored(members, "vector-members"), rows


def learn(members: DataFrame, k: int = NEAREST, part_rows: int = PART_ROWS) -> Router:
    """The router fitted on at most ``SAMPLE`` of the members, of the commonest length."""
    sizes = members.groupBy(F.size("vector").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").limit(1).collect()
    dim, n = (sizes[0].dim, sizes[0].n) if sizes else (0, 0)
    by = F.xxhash64("identity")
    share = min(1.0, 1.2 * SAMPLE / max(n, 1))
    drawn = members.filter((F.size("vector") == dim) & (F.pmod(by, F.lit(1 << 20)) < math.ceil(share * (1 << 20))))
    table = drawn.orderBy(by).select("vector").limit(SAMPLE).toArrow()
    flat = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return fit(flat.reshape(-1, dim) if dim else np.zeros((0, 1)), n, k, part_rows)


def _routed(members: DataFrame, router: Router) -> DataFrame:
    """A row for each member in its part (``asks`` false), and one for each part that it asks as a query."""

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 4000):
                rows = batch.slice(begin, 4000)
                lists = rows.column("vector")
                sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
                asked = np.flatnonzero(rows.column("asked").to_numpy(zero_copy_only=False))
                part = -1 - (sizes % _ODD_PARTS)
                probed = np.repeat(part[:, None], router.probes, 1)
                extra = np.zeros(probed.shape, bool)
                extra[:, 1:] = True  # a vector of another length asks its one part
                usual = np.flatnonzero(sizes == router.dim)
                if len(usual):
                    flat = lists.take(pa.array(usual)).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                    if router.layers:
                        order = np.argsort(-router.scores(flat.reshape(len(usual), -1)), 1, kind="stable")
                        part[usual], probed[usual] = order[:, 0], order[:, : router.probes]
                    else:
                        part[usual], probed[usual] = 0, 0
                    extra[usual] = False
                at, which = np.nonzero(~extra[asked])
                where = np.concatenate([np.arange(len(sizes)), asked[at]])
                taken = pa.array(where)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([part, probed[asked[at], which]]), pa.int64()),
                        pa.array(np.arange(len(where)) >= len(sizes)),
                        rows.column("key").take(taken),
                        rows.column("ids").take(taken),
                        lists.take(taken),
                    ],
                    names=["part", "asks", "key", "ids", "vector"],
                )

    kinds = {f.name: f.dataType.simpleString() for f in members.schema}
    schema = f"part bigint, asks boolean, key bigint, ids {kinds['ids']}, vector {kinds['vector']}"
    return members.select("key", "ids", "vector", "asked").mapInArrow(route, schema)


def _met(routed: DataFrame) -> DataFrame:
    """Every block of a part's vectors (``_low``) with every block of its queries (``_high``)."""
    # At most MAX_PARTS + _ODD_PARTS rows.
    sizes = stored(
        routed.groupBy("part").agg(
            F.ceil(F.count_if(~F.col("asks")) / BASE_BLOCK).cast("int").alias("_bases"),
            F.ceil(F.count_if("asks") / QUERY_BLOCK).cast("int").alias("_queries"),
        ),
        "part-sizes",
    ).filter("_bases > 0 AND _queries > 0")
    sized = routed.join(F.broadcast(sizes), "part")
    hashed = F.xxhash64("key")
    own = F.pmod(hashed, F.when(F.col("asks"), F.col("_queries")).otherwise(F.col("_bases"))).cast("int")
    others = F.when(F.col("asks"), F.col("_bases")).otherwise(F.col("_queries"))
    dealt = sized.withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0), others - 1)))
    low = F.when(F.col("asks"), F.col("_other")).otherwise(F.col("_own"))
    high = F.when(F.col("asks"), F.col("_own")).otherwise(F.col("_other"))
    return dealt.withColumns({"_low": low, "_high": high}).select("part", "_low", "_high", "asks", "key", "ids", "vector")


class _Kept:
    """A task's best entries of each query so far; a query meets many parts in one task, and only its best go on."""

    def __init__(self, k: int, kind: pa.DataType):
        self.k, self.kind, self.held = k, kind, 0
        self.best: dict[int, list[tuple[float, int, bool]]] = {}

    def add(self, key: int, found: list[tuple[float, int, bool]]) -> None:
        """``found`` is sorted."""
        old = self.best.get(key)
        merged = found if old is None else sorted(old + found)[: self.k]
        self.held += len(merged) - len(old or ())
        self.best[key] = merged

    def overflow(self) -> Iterator[pa.RecordBatch]:
        if self.held > KEPT_ENTRIES:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        lists = list(self.best.values())
        if lists:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.array(list(self.best), np.int64), [len(f) for f in lists])),
                    pa.array([-f[0] for found in lists for f in found], pa.float64()),
                    pa.array([f[1] for found in lists for f in found], self.kind),
                    pa.array([bool(f[2]) for found in lists for f in found], pa.bool_()),
                ],
                names=["key", "score", "id", "own"],
            )
        self.best, self.held = {}, 0


def search(members: DataFrame, router: Router, k: int = NEAREST) -> DataFrame:
    """``(key, near)``: for each member that a query has its k + 1 nearest ids, as ``(score, id, own)``."""
    id_type = members.schema["ids"].dataType.elementType.simpleString()
    kind = pa.int32() if id_type == "int" else pa.int64()

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = _Kept(k + 1, kind)
        for table, offsets in whole_runs(batches, "part"):
            asks = table.column("asks").to_numpy()
            keys = table.column("key").to_numpy()
            ids = table.column("ids").combine_chunks()
            id_offsets = offsets_of(ids.value_lengths().to_numpy())
            flat_ids = ids.flatten().to_numpy()
            lists = table.column("vector").combine_chunks()
            sizes = lists.value_lengths().to_numpy()
            value_offsets = offsets_of(sizes)
            values = lists.flatten().to_numpy().astype(np.float64)
            for begin, end in zip(offsets[:-1], offsets[1:]):
                rows = np.arange(begin, end)
                for size in np.unique(sizes[begin:end]):
                    same = rows[sizes[rows] == size]
                    base, queries = same[~asks[same]], same[asks[same]]
                    if not len(base) or not len(queries):
                        continue
                    span = np.arange(size)
                    b, q = (values[value_offsets[r][:, None] + span] for r in (base, queries))
                    for asked, (near, score) in zip(keys[queries], best_of(q, b, flat_ids[id_offsets[base]], k + 1)):
                        found = [
                            (-s, i, keys[base[m]] == asked)
                            for m, s in zip(near.tolist(), score.tolist())
                            for i in flat_ids[id_offsets[base[m]] : id_offsets[base[m] + 1]].tolist()
                        ]
                        found.sort()
                        kept.add(asked, found[: k + 1])
                    yield from kept.overflow()
        yield from kept.rest()

    runs = by_runs(_met(_routed(members, router)), "part")
    found = runs.mapInArrow(rank, f"key bigint, score double, id {id_type}, own boolean")
    # Entries of one query: k + 1 from each block that it met.
    best = Window.partitionBy("key").orderBy(F.desc("score"), "id", "own")
    kept = found.withColumn("_rank", F.row_number().over(best)).filter(F.col("_rank") <= k + 1)
    entry = F.struct("_rank", "score", "id", "own")
    return kept.groupBy("key").agg(F.sort_array(F.collect_list(entry)).alias("near"))


def nearest(vectors: DataFrame, k: int = NEAREST, every: int = EVERY, part_rows: int = PART_ROWS) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k nearest rows of every row of ``vectors`` (``vec_id``, ``embedding``) whose
    vec_id is divisible by ``every``, among all rows but itself."""
    ship(vectors.sparkSession)
    members, rows = members_of(vectors, k, every)
    router = learn(members, k, part_rows)
    lists = stored(search(members, router, k), "vector-neighbours")
    identities = members.filter("asked").select("key", "identity")
    asking = rows.filter("asks").select(F.col("vec_id").alias("query_id"), "identity")
    listed = asking.join(identities.join(lists, "key"), "identity")
    others = F.filter("near", lambda x: ~(x["own"] & (x["id"] == F.col("query_id"))))
    return (
        listed.select("query_id", F.posexplode(F.slice(others, 1, k)).alias("_at", "_near"))
        .select("query_id", (F.col("_at") + 1).alias("rank"), F.col("_near.id").alias("vec_id"), F.col("_near.score").alias("score"))
    )
