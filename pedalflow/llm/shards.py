"""Sharding by fixed virtual slots and a stored, versioned slot-to-shard map.

A record's slot is a hash of its id and its text's checksum, one of ``SLOTS``, for ever. Of records that repeat both, such as
those without id and text, the second and later ones hash the number of the copy as well, so no slot holds them all. Bytes
are summed per slot; the map gives each slot a shard so that the shards' bytes are nearly equal. To rebalance, a new version of the map is
stored in which a few slots have moved; no record is hashed anew. Only DataFrame functions touch the records. The
driver sees one row per slot, ``SLOTS`` in all, whatever the data.

Law ``bytes``: the largest and the smallest shard differ by no more than the largest slot. A record's size is its
UTF-8 bytes (null: none) plus 8. Within a shard records are numbered from 0 without gaps: slot by slot, in a slot by
doc_id. Rows that are equal get numbers of their own. Equal texts are not kept together: each record is placed by itself, so
that a text with a third of all rows is spread over all shards. A null doc_id is hashed like a value of its own. An empty table
gives an empty table; other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pedalflow.llm.scratch import stored
from pedalflow.operators.numbering import number_rows
from pedalflow.session import scratch_path

SHARDS, SLOTS, RECORD_BYTES = 24, 8192, 8


def records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``(doc_id, size, text_crc32, virtual_slot)`` of every row, kept in the shared folder."""
    text = F.coalesce(F.col("text"), F.lit(""))
    measured = stored(
        docs.select(
            "doc_id",
            (F.octet_length(text) + RECORD_BYTES).cast("bigint").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.monotonically_increasing_id().alias("_record"),
        ),
        "measured-records",
    )
    alone, later = F.xxhash64("doc_id", "text_crc32"), F.xxhash64("doc_id", "text_crc32", "_copy")
    slot = F.pmod(F.when(F.col("_copy") > 0, later).otherwise(alone), F.lit(slots)).cast("int")
    copies = measured.join(copy_numbers(measured), "_record", "left")
    return stored(copies.withColumn("virtual_slot", slot).drop("_record", "_copy"), "shard-records")


def copy_numbers(measured: DataFrame) -> DataFrame:
    """``(_row, _copy)`` of the records whose id and checksum are repeated: they are numbered from 0, in range partitions that
    no key, however often it is repeated, has to itself."""
    keys = measured.groupBy("doc_id", "text_crc32").agg(F.count("*").alias("n")).filter("n > 1")
    keys = stored(keys.select(F.col("doc_id").alias("_id"), F.col("text_crc32").alias("_crc")), "repeated-records")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_crc32") == F.col("_crc"))
    repeated = measured.join(keys, same).select("_id", "_crc", "_record", F.struct("_id", "_crc", "_record").alias("_order"))
    numbered = number_rows(repeated, "_order", "_number").drop("_order")
    first = stored(
        numbered.groupBy("_id", "_crc").agg(F.min("_number").alias("_first")).withColumnsRenamed({"_id": "_a", "_crc": "_b"}),
        "first-records",
    )
    of_key = F.col("_id").eqNullSafe(F.col("_a")) & (F.col("_crc") == F.col("_b"))
    return numbered.join(first, of_key).select("_record", (F.col("_number") - F.col("_first")).alias("_copy"))


def slot_loads(recs: DataFrame, slots: int = SLOTS) -> tuple[list[int], list[int]]:
    """Bytes and records of each slot."""
    n_bytes, n_records = [0] * slots, [0] * slots
    per_slot = recs.groupBy("virtual_slot").agg(F.sum("size").alias("b"), F.count("*").alias("n"))
    for row in per_slot.collect():  # one row per slot
        n_bytes[row["virtual_slot"]], n_records[row["virtual_slot"]] = row["b"], row["n"]
    return n_bytes, n_records


def first_map(loads: Sequence[int], n_shards: int = SHARDS) -> list[int]:
    """A shard for each slot: the heaviest slot first, each to the lightest shard."""
    shard_of = [0] * len(loads)
    heap = [(0, shard) for shard in range(n_shards)]
    for slot in sorted(range(len(loads)), key=lambda s: (-loads[s], s)):
        load, shard = heap[0]
        shard_of[slot] = shard
        heapq.heapreplace(heap, (load + loads[slot], shard))
    return shard_of


def rebalanced(shard_of: Sequence[int], loads: Sequence[int], n_shards: int) -> list[int]:
    """The map edited for new loads or more shards: slots move from the heaviest shard to the lightest while that
    narrows the gap between the two."""
    edited = list(shard_of)
    total = [0] * n_shards
    slots_of: list[list[tuple[int, int]]] = [[] for _ in range(n_shards)]
    for slot, shard in enumerate(edited):
        total[shard] += loads[slot]
        slots_of[shard].append((loads[slot], slot))
    for held in slots_of:
        held.sort()
    for _ in range(len(edited)):
        high, low = max(range(n_shards), key=total.__getitem__), min(range(n_shards), key=total.__getitem__)
        gap = total[high] - total[low]
        # The heaviest slot that does not simply turn the two shards round.
        fitting = [x for x in slots_of[high] if 0 < x[0] < gap]
        if not fitting:
            break
        best = min(fitting, key=lambda x: (abs(gap - 2 * x[0]), x[1]))
        slots_of[high].remove(best)
        slots_of[low].append(best)
        edited[best[1]] = low
        total[high] -= best[0]
        total[low] += best[0]
    return edited


def store_map(
    spark: SparkSession, folder: str, version: int, shard_of: Sequence[int], counts: Sequence[int]
) -> DataFrame:
    """Add a version of the map to ``folder``: slot, shard, and the number of the slot's first record in its shard."""
    first, filled = [0] * len(shard_of), {}
    for slot, shard in enumerate(shard_of):
        first[slot] = filled.get(shard, 0)
        filled[shard] = first[slot] + counts[slot]

    def looked_up(values: Sequence[int], kind: str) -> F.Column:
        return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")[F.col("id").cast("int")]

    spark.range(0, len(shard_of), 1, 1).select(
        F.lit(version).alias("version"),
        F.col("id").cast("int").alias("virtual_slot"),
        looked_up(shard_of, "int").alias("shard"),
        looked_up(first, "bigint").alias("first_slot"),
    ).write.mode("append").parquet(folder)
    return read_map(spark, folder, version)


def read_map(spark: SparkSession, folder: str, version: int) -> DataFrame:
    """A version of the map, one row per slot."""
    return spark.read.parquet(folder).filter(F.col("version") == version).drop("version")


def place(recs: DataFrame, slot_map: DataFrame) -> DataFrame:
    """The records with their shard and their number in it."""
    in_slot = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")) - 1
    return (
        recs.withColumn("_in_slot", in_slot)
        .join(F.broadcast(slot_map), "virtual_slot")  # one row per virtual slot, whatever the data
        .withColumn("slot", F.col("first_slot") + F.col("_in_slot"))
        .drop("_in_slot", "first_slot")
    )


def shard(docs: DataFrame, n_shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """Put every row of ``docs`` into a shard and store version 1 of the map in the shared folder."""
    spark = docs.sparkSession
    recs = records(docs, slots)
    loads, counts = slot_loads(recs, slots)
    slot_map = store_map(spark, scratch_path(spark, "slot-map"), 1, first_map(loads, n_shards), counts)
    return place(recs, slot_map).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
    )
