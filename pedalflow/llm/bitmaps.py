"""A bitmap of the keys on one side of a join, so that rows of the other side without a partner are not shuffled.

The bitmap has ``BITS`` bits whatever the data, one for each value of a key's hash: 4 MB that may be broadcast. A clear bit
proves that a key is absent. Where there are so many keys that most bits are set it lets everything pass, and costs only
the test; the join that follows decides in any case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 25
_PAGE_BITS = 1 << 15  # of bitmap_construct_agg


def _bit(key: list[Column]) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(BITS))


def pages(keys: DataFrame) -> DataFrame:
    """The bitmap of all rows of ``keys``, as pages of 4 KB; at most ``BITS`` / 32768 rows."""
    bit = _bit([F.col(f"`{c}`") for c in keys.columns])
    set_bits = keys.select(F.floor(bit / _PAGE_BITS).alias("_page"), (bit % _PAGE_BITS).alias("_place"))
    return set_bits.groupBy("_page").agg(F.bitmap_construct_agg("_place").alias("_bits"))


def with_chance(rows: DataFrame, key: list[Column], bitmap: DataFrame, into: str) -> DataFrame:
    """Add ``into``: false where the key is in no row that the bitmap was made of.

    The key's columns must have the types and the order of those. ``rows`` must have no column of the bitmap's.
    """
    marked = rows.withColumn("_at", _bit(key))
    joined = marked.join(F.broadcast(bitmap), F.floor(F.col("_at") / _PAGE_BITS) == F.col("_page"), "left")
    place = F.col("_at") % _PAGE_BITS
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_set = byte.bitwiseAND(F.expr("shiftleft(1, cast(_at % 8 AS INT))")) > 0
    return joined.withColumn(into, F.coalesce(is_set, F.lit(False))).drop("_at", "_page", "_bits")
