"""Joins that stay balanced when one key holds a large share of the rows.

One-shot joins of raw tables are left to adaptive execution, which splits an oversized join
partition by itself. It cannot do so where one side of the join was aggregated on the join key
or is kept between the rounds of a loop; those joins use ``salted_join``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pedalflow.session import checkpoint

# Rows of one key that a task takes at most; a key with more is dealt over several.
TARGET_ROWS = 1_000_000
# A list of hot keys up to this length (some 20 MB) is broadcast; a longer one is joined like any table.
MAX_BROADCAST_KEYS = 1_000_000


def hot_keys(counts: DataFrame, key: str, n: str = "n", target_rows: int = TARGET_ROWS) -> DataFrame:
    """``(key, slots)`` of the keys with more than ``target_rows`` rows among pre-aggregated ``(key, n)`` counts.

    The number of slots follows the rows of the key alone, whatever the size of the table. The list is written
    once, and marked for broadcast if its length allows it.
    """
    slots = F.ceil(F.col(n) / F.lit(target_rows)).cast("int").alias("slots")
    hot = checkpoint(counts.filter(F.col(key).isNotNull() & (F.col(n) > target_rows)).select(key, slots))
    return F.broadcast(hot) if hot.count() <= MAX_BROADCAST_KEYS else hot


def spread(fact: DataFrame, hot: DataFrame, key: str, by: Column) -> DataFrame:
    """Add ``slot``: rows of a hot key are dealt over its slots by ``by``, all others get 0."""
    return (
        fact.join(hot, key, "left")
        .withColumn("slot", F.coalesce(F.pmod(F.xxhash64(by), F.col("slots")).cast("int"), F.lit(0)))
        .drop("slots")
    )


def replicate(dim: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """Repeat the rows of hot keys once per slot."""
    slots = F.coalesce(F.col("slots"), F.lit(1))
    return (
        dim.join(hot, key, "left")
        .withColumn("slot", F.explode(F.sequence(F.lit(0), slots - 1)))
        .drop("slots")
    )


def salted_join(fact: DataFrame, dim: DataFrame, hot: DataFrame | None, key: str, by: Column) -> DataFrame:
    """Inner join of ``fact`` with ``dim`` (unique on ``key``) in which no task gets a whole hot key.

    ``hot`` is None where the caller has counted that no key has more than TARGET_ROWS.
    """
    if hot is None:
        return fact.join(dim, key)
    return spread(fact, hot, key, by).join(replicate(dim, hot, key), [key, "slot"]).drop("slot")
