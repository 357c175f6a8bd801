"""Comparing the members of many groups in tasks of bounded size, and joining what is linked.

A group (the documents that share a key, the members of a cluster) is cut into blocks of bounded weight. Every pair of
blocks is a task's run of rows, and a run holds one pair of blocks only, so a hot group is spread over many tasks and
none of its pairs is lost. What a run gives is a star per component found in it, never its pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pedalflow.operators.graph_loops import component_roots

PAIR = ["_low", "_high"]


def in_block_pairs(members: DataFrame, n_blocks: Column, by: str) -> DataFrame:
    """Repeat each member once for each block of its group, with the two blocks that meet: ``_low``, ``_high``.

    A group of one block is not repeated. ``by`` tells a member's block, ``_own``, by its hash.
    """
    own = F.pmod(F.xxhash64(by), F.col("_blocks")).cast("int")
    dealt = members.withColumn("_blocks", n_blocks.cast("int")).withColumn("_own", own)
    met = dealt.withColumn("_met", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return met.withColumns({"_low": F.least("_own", "_met"), "_high": F.greatest("_own", "_met")}).drop("_blocks", "_met")


def by_runs(rows: DataFrame, group: str) -> DataFrame:
    """Bring the rows of each block pair together, sorted."""
    return rows.repartition(group, *PAIR).sortWithinPartitions(group, *PAIR)


def whole_runs(batches: Iterator[pa.RecordBatch], group: str) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole runs of equal (group, block pair), with the offsets of the runs."""
    waiting: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (group, *PAIR)], 1)
        change = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
        fresh = last is not None and (keys[0] != last).any()
        cut = int(change[-1]) if len(change) else (0 if fresh else None)
        if cut is not None:
            table = pa.Table.from_batches([*waiting, batch.slice(0, cut)] if cut else waiting)
            yield table, _offsets(table, group)
            waiting = [batch.slice(cut)]
        else:
            waiting.append(batch)
        last = keys[-1]
    if waiting:
        table = pa.Table.from_batches(waiting)
        yield table, _offsets(table, group)


def _offsets(table: pa.Table, group: str) -> np.ndarray:
    keys = np.stack([table.column(c).to_numpy().astype(np.int64) for c in (group, *PAIR)], 1)
    change = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
    return np.concatenate([[0], change, [len(keys)]])


def components_within(n: int, near: Callable[[int, np.ndarray], np.ndarray]) -> np.ndarray:
    """The component of each of ``n`` members; ``near(i, others)`` tells which others member i is linked with.

    A search that compares each member with those not reached yet only.
    """
    label = np.full(n, -1)
    rest = np.arange(n)
    while len(rest):
        root, rest = rest[0], rest[1:]
        label[root] = root
        frontier = [root]
        while frontier and len(rest):
            hit = near(int(frontier.pop()), rest)
            label[rest[hit]] = root
            frontier.extend(rest[hit].tolist())
            rest = rest[~hit]
    return label


def stars(ids: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each id but the lowest of its component, and that lowest one."""
    order = np.lexsort((ids, label))
    ids, label = ids[order], label[order]
    first = np.concatenate([[True], label[1:] != label[:-1]])
    lowest = ids[np.flatnonzero(first)][np.cumsum(first) - 1]
    other = ids != lowest
    return ids[other], lowest[other]


def roots(edges: DataFrame) -> DataFrame:
    """``(id, root)`` of every id in ``edges`` (``src``, ``dst``): the lowest id that it is connected with."""
    ids = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    return component_roots(ids, edges)
