"""Mixing sources to target weights by a Pfair schedule.

A source's rows are dealt into blocks of ``BLOCK_ROWS``. Block j (from 0) of a source with weight w is released at slot
floor(j / w) and due by slot ceil((j + 1) / w); of the released blocks the one due first gets the next slot. As the weights
sum to 1, every block meets its time, so that after any number of slots each source is less than one block away from its
weight. Weights are multiples of 2 ** -64, so this holds over inputs of any size.

The slots are worked out in segments of ``PERIOD``, each by itself and in any task: which blocks are done before a segment
follows from the weights alone (``done_before``). When a source has no rows left, a phase of the schedule ends: the
others share its weight in the proportion of theirs, and start anew. So the slots are hardly more than the blocks, also where a
source with most rows has next to no weight.

No row is dropped or repeated: the result is an order. ``weight`` is a source's share in the phase that a row is in (in a band, its part of the band's).

The ``MAX_SOURCES`` sources with most rows are entries of the schedule by themselves. All others, however many, keep their weights
too: they are put in at most ``BANDS`` bands by the time at which they end (rows by weight, a band up to twice its least, the last band
all above), each an entry with the sum of its sources' weights. In a band, row k of a source with weight w is due at (k + u) / w, so that at any time
t a source has placed its weight times t, to the row, until it ends. The offsets u in [0, 1) are dealt by the golden ratio over sources in
the order of weight, so that many small sources do not come at once. What a source of a band leaves when it ends goes to the band's
others first, and to all when the band ends.

Rows of a source are numbered by doc_id; a null source counts as the empty name; rows that are equal in source and
doc_id get numbers of their own. A source without a given weight gets 1 / ``PERIOD`` (of n > ``PERIOD`` / 2 sources, 1 / 2n), and the
others share the rest. An empty table
gives an empty table; other columns are not read.
"""

from __future__ import annotations

import bisect
import heapq
import itertools
from collections.abc import Iterator, Mapping
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pedalflow.llm.scratch import stored
from pedalflow.llm.ship import ship
from pedalflow.operators.numbering import number_rows
from pedalflow.session import checkpoint

BLOCK_ROWS, PERIOD = 8, 16_384
# Sources that are entries by themselves, those with most rows; all others are scheduled by their weights in bands.
MAX_SOURCES, BANDS = 512, 64
_GOLDEN = (5**0.5 - 1) / 2
_WHOLE = 1 << 64  # weights are parts of this
MAX_TASKS = 4096
_SCAN = 1 << 20  # numbers looked at at once
# Default target weights: proportional to a source's rows to this power, which brings small sources forward.
FLATTEN = 0.7
_ROW_BITS = 33  # monotonically_increasing_id keeps the row within its partition in the low 33 bits


def flattened_weights(sizes: Mapping[str, int], power: float = FLATTEN) -> dict[str, float]:
    return {source: n**power for source, n in sizes.items()}


def parts_of(sources: list[str], weights: Mapping[str, float], period: int = PERIOD) -> list[int]:
    """The weights of the sources in parts of 2 ** 64, which they sum to."""
    if len(sources) > period:
        raise ValueError(f"{len(sources)} sources; at most {period} can be mixed")
    if not sources:
        return []
    given = [Fraction(weights.get(s, 0)) for s in sources]
    total, least = sum(given), Fraction(1, max(period, 2 * len(sources)))
    rest = 1 - least * given.count(0)
    shares = [g / total * rest if g else least for g in given] if total else [Fraction(1, len(sources))] * len(sources)
    parts = [max(int(x * _WHOLE), 1) for x in shares]
    parts[parts.index(max(parts))] += _WHOLE - sum(parts)
    return parts


def done_before(parts: list[int], slot: int) -> list[int]:
    """How many blocks of each source earliest deadline first has placed before ``slot``, from the weights alone.

    Blocks due by then are done. Of the blocks released before ``slot`` and due after it, one at most of each source, some
    are late: as many as the slots leave over. From no slot a on can more blocks be placed than there are slots, that is, of the
    blocks released before a at most sum(ceil(w * a) - w * a) are late. Of all sets within these nested bounds earliest
    deadline first leaves the one with the latest deadlines, which a greedy choice finds.
    """
    done = [p * slot // _WHOLE for p in parts]
    open_ = [s for s, p in enumerate(parts) if p * slot % _WHOLE]
    n_late = len(open_) - (slot - sum(done))
    release = {s: done[s] * _WHOLE // parts[s] for s in open_}
    late: set[int] = set()
    if n_late:
        starts = np.array(sorted(set(release.values())), np.int64)
        room = np.full(len(starts), len(open_), np.int64)
        each = np.array([parts[s] % _WHOLE for s in range(len(parts))], np.uint64)
        step = max(_SCAN // len(parts), 1)
        for low in range(int(starts[0]) + 1, slot + 1, step):
            at = np.arange(low, min(low + step, slot + 1))
            # Modulo 2 ** 64, as unsigned numbers are.
            short = (np.uint64(0) - at.astype(np.uint64)[:, None] * each).astype(np.float64).sum(axis=1) / float(_WHOLE)
            np.minimum.at(room, np.searchsorted(starts, at) - 1, np.rint(short).astype(np.int64))
        for s in sorted(open_, key=lambda s: (-(-(done[s] + 1) * _WHOLE // parts[s]), s), reverse=True):
            i = int(np.searchsorted(starts, release[s]))
            if len(late) < n_late and room[i:].min() > 0:
                room[i:] -= 1
                late.add(s)
    for s in open_:
        done[s] += s not in late
    return done


def segment(parts: list[int], done: list[int], first: int, slots: int) -> Iterator[tuple[int, int, int, int, int]]:
    """``(source, block, release, deadline, slot)`` of ``slots`` slots from ``first`` on, earliest deadline first."""
    whole, done = sum(parts), list(done)
    released: list[list[int]] = [[] for _ in range(slots)]

    def wait(source: int, least: int) -> None:
        at = max(done[source] * whole // parts[source] - first, least)
        if at < slots:
            released[at].append(source)

    for source in range(len(parts)):
        wait(source, 0)
    ready: list[tuple[int, int]] = []
    for slot in range(slots):
        for source in released[slot]:
            heapq.heappush(ready, (-(-(done[source] + 1) * whole // parts[source]), source))
        deadline, source = heapq.heappop(ready)
        block = done[source]
        yield source, block, block * whole // parts[source], deadline, first + slot
        done[source] += 1
        wait(source, slot + 1)


class Phase(NamedTuple):
    """A stretch of slots in which the same sources have rows: these, their parts, the blocks that each has placed before, the
    first slot and how many there are."""

    sources: list[int]
    parts: list[int]
    placed: list[int]
    first: int
    slots: int


def phases(parts: list[int], blocks: list[int]) -> list[Phase]:
    """The whole schedule: each phase ends when a source has placed its last block, and the rest share its part.

    So there are hardly more slots than blocks, whatever the weights, and no more phases than sources.
    """
    found: list[Phase] = []
    placed, first = [0] * len(blocks), 0
    active = [s for s, n in enumerate(blocks) if n]
    while active:
        whole = sum(parts[s] for s in active)
        own = [parts[s] * _WHOLE // whole for s in active]
        own[own.index(max(own))] += _WHOLE - sum(own)
        slots = min(-(-(blocks[s] - placed[s]) * _WHOLE // p) for s, p in zip(active, own))
        found.append(Phase(active, own, [placed[s] for s in active], first, slots))
        for s, n in zip(active, done_before(own, slots)):
            placed[s] = min(placed[s] + n, blocks[s])
        first += slots
        active = [s for s in active if placed[s] < blocks[s]]
    return found


_PLACED = "entry string, weight double, block bigint, release bigint, deadline bigint, slot bigint"


def schedule(spark: SparkSession, names: list[str], parts: list[int], blocks: list[int], period: int = PERIOD) -> DataFrame:
    """``(entry, weight, block, release, deadline, slot)`` of all blocks that have rows, ``blocks`` of each entry of ``names``."""
    ship(spark)
    planned = phases(parts, blocks)
    segments = list(itertools.accumulate((-(-p.slots // period) for p in planned), initial=0))
    shared = spark.sparkContext.broadcast((names, blocks, planned, segments))  # at most MAX_SOURCES + BANDS entries and phases

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, blocks, planned, segments = shared.value
        for batch in batches:
            for k in batch.column("id").to_pylist():
                of = bisect.bisect_right(segments, k) - 1
                phase, begin = planned[of], (k - segments[of]) * period
                slots = segment(phase.parts, done_before(phase.parts, begin), begin, min(period, phase.slots - begin))
                rows = [
                    (names[phase.sources[s]], phase.parts[s] / _WHOLE, phase.placed[s] + block, *(phase.first + x for x in times))
                    for s, block, *times in slots
                    if phase.placed[s] + block < blocks[phase.sources[s]]
                ]
                columns = zip(*rows) if rows else [()] * 6
                kinds = (pa.string(), pa.float64(), *[pa.int64()] * 4)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind) for c, kind in zip(columns, kinds)], names=["entry", "weight", "block", "release", "deadline", "slot"]
                )

    tasks = max(min(segments[-1], MAX_TASKS), 1)
    return spark.range(0, segments[-1], 1, tasks).mapInArrow(place, _PLACED)


def numbered_in_source(docs: DataFrame) -> DataFrame:
    """``(doc_id, source, rank)``: the rows of a source numbered from 0, a hot source in many tasks at once."""
    named = docs.select("doc_id", F.coalesce(F.col("source"), F.lit("")).alias("source"))
    ordered = named.repartitionByRange("source", "doc_id").sortWithinPartitions("source", "doc_id")
    written = checkpoint(ordered.withColumn("_place", F.monotonically_increasing_id()))
    placed = written.withColumn("_part", F.shiftright("_place", _ROW_BITS)).withColumn(
        "_row", F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    )
    # A source's rows lie in neighbouring partitions: this has at most one row per partition and one per source.
    pieces = placed.groupBy("_part", "source").agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    before = Window.partitionBy("source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select("_part", "source", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return placed.join(F.broadcast(offsets), ["_part", "source"]).select(
        "doc_id", "source", (F.col("_before") + F.col("_row") - F.col("_first")).alias("rank")
    )


def _weighted(counts: DataFrame, weights: Mapping[str, float] | None, period: int) -> DataFrame:
    """``(source, n, w)``: the weight of every source, by the rule of ``parts_of``."""
    if weights is None:
        return counts.withColumn("w", F.pow("n", F.lit(FLATTEN)))
    given = counts.sparkSession.createDataFrame([(s, float(w)) for s, w in weights.items()], "source string, g double")
    known = counts.join(given, "source", "left").withColumn("g", F.coalesce("g", F.lit(0.0)))
    total, free, sources = known.agg(F.sum("g"), F.sum((F.col("g") == 0).cast("bigint")), F.count("*")).first()
    least = 1 / max(period, 2 * sources)
    share = F.when(F.col("g") > 0, F.col("g") / F.lit(total) * (1 - least * free)).otherwise(least) if total else F.lit(1 / sources)
    return known.select("source", "n", share.alias("w"))


def _bands(rest: DataFrame, pool: str) -> tuple[DataFrame, dict[str, tuple[int, float]]]:
    """``(source, w, u, entry, start, own)`` of the sources of ``rest``, and the rows and weight of each band by its entry's name,
    which starts with ``pool``; ``start``: the rows of the bands before; ``own``: the source's part of the band's weight."""
    end = F.col("n") / F.col("w")
    first = rest.agg(F.min(end)).first()[0]
    banded = rest.withColumn("band", F.least(F.floor(F.log2(end / F.lit(first))), F.lit(BANDS - 1)).cast("int"))
    ordered = number_rows(banded.withColumn("_key", F.struct("band", "w", "source")), "_key", "_i").drop("_key")
    found = banded.groupBy("band").agg(F.sum("n").alias("n"), F.sum("w").alias("w")).orderBy("band").collect()  # at most ``BANDS``
    starts = itertools.accumulate((r["n"] for r in found), initial=0)
    rows = [(r["band"], f"{pool}{r['band']:02d}", start, r["w"]) for r, start in zip(found, starts)]
    of_band = rest.sparkSession.createDataFrame(rows, "band int, entry string, start bigint, band_w double")
    u = F.col("_i") * F.lit(_GOLDEN) % 1
    placed = ordered.join(F.broadcast(of_band), "band").select("source", "w", u.alias("u"), "entry", "start", (F.col("w") / F.col("band_w")).alias("own"))
    return placed, {entry: (r["n"], r["w"]) for r, (_, entry, _, _) in zip(found, rows)}


def _with_entries(ranked: DataFrame, names: list[str], banded: DataFrame) -> DataFrame:
    """``(doc_id, source, entry, rank, own)``: rows of the sources in ``names`` by these, all others by their band, in which they are
    numbered in the order of the times at which they are due."""
    listed = ranked.sparkSession.createDataFrame([(s,) for s in names], "source string")  # at most MAX_SOURCES names
    own = ranked.join(F.broadcast(listed), "source").withColumns({"entry": F.col("source"), "own": F.lit(1.0)})
    due = F.struct("start", ((F.col("rank") + F.col("u")) / F.col("w")).alias("due"), "source", "rank")
    pooled = ranked.join(banded, "source").withColumn("_due", due).drop("rank", "u", "w")
    numbered = number_rows(pooled, "_due", "_number").withColumn("rank", F.col("_number") - F.col("start")).drop("_due", "_number", "start")
    return own.unionByName(numbered)


def mix(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    block_rows: int = BLOCK_ROWS,
    period: int = PERIOD,
    max_sources: int = MAX_SOURCES,
) -> DataFrame:
    """``(doc_id, source, weight, block, release, deadline, slot, position)``: rows in the order of ``position``, 0 .. n-1."""
    spark = docs.sparkSession
    ranked = numbered_in_source(docs)
    counts = stored(ranked.groupBy("source").agg(F.count("*").alias("n")), "source-sizes")
    largest = counts.orderBy(F.desc("n"), "source").limit(max_sources).collect()
    sizes = {r["source"]: r["n"] for r in sorted(largest, key=lambda r: r["source"])}
    names = list(sizes)
    given = flattened_weights(sizes) if weights is None else {s: weights.get(s, 0) for s in names}
    entries = ranked.withColumns({"entry": F.col("source"), "own": F.lit(1.0)})
    if counts.count() > len(names):
        weighted = stored(_weighted(counts, weights, period), "source-weights")
        listed = F.col("source").isin(names)
        given = {r["source"]: r["w"] for r in weighted.filter(listed).collect()}
        # Names of no source that is listed, for they come after all of them.
        banded, bands = _bands(weighted.filter(~listed), (names[-1] if names else "") + "\0")
        entries = _with_entries(ranked, names, banded)
        for name, (rows, weight) in bands.items():
            sizes[name], given[name] = rows, weight
        names = [*names, *bands]
    blocks = [-(-sizes[s] // block_rows) for s in names]
    planned = schedule(spark, names, parts_of(names, given, max(period, len(names))), blocks, period)
    scheduled = (
        entries.withColumn("block", F.floor(F.col("rank") / block_rows))
        .join(planned, ["entry", "block"])
        .select(
            *("doc_id", "source", (F.col("weight") * F.col("own")).alias("weight"), "block", "release", "deadline", "slot"),
            (F.col("slot") * block_rows + F.col("rank") % block_rows).alias("_order"),
        )
    )
    return number_rows(scheduled, "_order", "position").drop("_order")


def in_mixed_order(docs: DataFrame, weights: Mapping[str, float] | None = None) -> DataFrame:
    """The rows of ``docs`` with all their columns, files and rows in the mixed order."""
    # Rows that share a doc_id share the first position of these.
    places = mix(docs, weights).groupBy(F.col("doc_id").alias("placed_id")).agg(F.min("position").alias("position"))
    # Columns of any name may come along, so they are packed away from those of the join.
    packed = docs.select(F.struct("*").alias("row"))
    joined = packed.join(places, F.col("row.doc_id").eqNullSafe(F.col("placed_id")))
    return joined.repartitionByRange("position").sortWithinPartitions("position").select("row.*")
