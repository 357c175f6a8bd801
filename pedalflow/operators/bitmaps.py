"""Exact distinct counts by bitmaps, and semi joins that shuffle only rows with a chance of a partner.

Distinct numbers are counted in words of 64 neighbouring ones, made where the rows are and merged by OR, so a number that
comes a million times is one bit in every task. A word is as wide as an id: where a group's ids lie far apart, there are no more
words than rows. The keys of a semi join, which are hashed and fill their bitmap, are in pages of 4 KB that cover 32,768 places.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pedalflow.session import in_session

WORD_BITS, WORD_SHIFT = 64, 6  # a long
PAGE_BITS = 1 << 15  # of bitmap_construct_agg
BITS_PER_KEY = 16  # one row in 16 without a partner passes
MAX_BITS = 1 << 28  # 32 MB to broadcast


def distinct_counts(df: DataFrame, by: str, columns: dict[str, str]) -> DataFrame:
    """``by`` and the number of different values of each integer column, null not counted; ``columns`` names the results.

    One pass, whose result is written, makes a word of every column for each group and each combination of word numbers; the rows that are merged after
    it are words, at most as many as the rows. No row is repeated for a second column. Words and counts are longs, which hash
    aggregates keep in place and spill by the row.
    """
    longs = {c: F.col(c).cast("bigint") for c in columns}
    words = {c: F.shiftright(n, WORD_SHIFT).alias(f"_word_{c}") for c, n in longs.items()}
    one, at = F.lit(1).cast("bigint"), {c: n.bitwiseAND(F.lit(WORD_BITS - 1)).cast("int") for c, n in longs.items()}
    bits = [F.bit_or(F.call_function("shiftleft", one, n)).alias(f"_bits_{c}") for c, n in at.items()]
    made = df.select(F.col(by), *columns, *words.values()).groupBy(by, *[f"_word_{c}" for c in columns]).agg(*bits)
    made = in_session(df.sparkSession, made, "words")  # else each column would have the rows of ``df`` made anew
    counted = []
    for c, name in columns.items():
        merged = made.groupBy(F.col(by).alias("_by"), f"_word_{c}").agg(F.bit_or(f"_bits_{c}").alias("_bits"))
        counted.append(merged.groupBy("_by").agg(F.coalesce(F.sum(F.bit_count("_bits")), F.lit(0)).alias(name)))
    joined = reduce(lambda a, b: a.join(b.withColumnRenamed("_by", "_other"), F.col("_by").eqNullSafe(F.col("_other"))).drop("_other"), counted)
    return joined.withColumnRenamed("_by", by)


def _place(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits))


def key_pages(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """The bitmap of the hashes of ``key``: at most ``bits`` / 32,768 rows of 4 KB."""
    place = _place(F.col(key), bits)
    marked = keys.select(F.floor(place / PAGE_BITS).alias("_page"), (place % PAGE_BITS).alias("_at"))
    return marked.groupBy("_page").agg(F.bitmap_construct_agg("_at").alias("_bits"))


def bits_for(n: int) -> int | None:
    """Bits of a bitmap for ``n`` keys, a power of two; None where it would be so full that it sorts out too little."""
    bits = PAGE_BITS
    while bits < BITS_PER_KEY * n and bits < MAX_BITS:
        bits *= 2
    return bits if 4 * n <= bits else None


def with_a_chance(rows: DataFrame, key: str, pages: DataFrame, bits: int) -> DataFrame:
    """The rows whose key may be among those of the bitmap; it is tested where the rows are read."""
    marked = rows.withColumn("_place", _place(F.col(key), bits))
    joined = marked.join(F.broadcast(pages), F.floor(F.col("_place") / PAGE_BITS) == F.col("_page"))
    at = F.col("_place") % PAGE_BITS
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_set = byte.bitwiseAND(F.expr("shiftleft(1, cast(_place % 8 AS INT))")) > 0
    return joined.filter(is_set).drop("_place", "_page", "_bits")


def semi_join(rows: DataFrame, keys: DataFrame, key: str, n_keys: int) -> DataFrame:
    """``rows`` whose ``key`` is among ``keys``, a table of that column alone with ``n_keys`` different values and no other rows.

    Rows that the bitmap rules out are not shuffled; the join decides on the others. With too many keys for
    a bitmap of 32 MB all rows go to the join. An inner join, which gives the same here, for Spark moves a semi join
    below the test.
    """
    bits = bits_for(n_keys)
    if bits is not None:
        rows = with_a_chance(rows, key, key_pages(keys, key, bits), bits)
    return rows.join(keys, key)
