"""Tables whose rows of one key are found by reading next to nothing.

A keyed table is a folder of buckets, ``bucket=<n>``, where a row's bucket is the checksum of its key as text. The number of
buckets follows the rows, so a bucket stays small however large the table is, and a search by key lists and opens that one
folder. Inside it rows are sorted by key in row groups of a few hundred KB with Bloom filters on the key: of the
bucket only the row groups that hold the key are read, all of them where one key fills many. A hot key's rows are
written by many tasks, as files of one folder.
"""

from __future__ import annotations

import json
import zlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pedalflow.sources.folders import size

BUCKET_ROWS = 1_000_000
ROW_GROUP_BYTES = 256 << 10
BLOOM_ROWS = 20_000  # different keys in a row group at most, to size its filter
ONE_TASK_BYTES = 32 << 20
BUCKET, LAYOUT = "bucket", "_layout"


def _bucket(key: str, buckets: int) -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % buckets, F.lit(0)).cast("int")


@dataclass(frozen=True)
class KeyedTable:
    """A written keyed table; its rows without the bucket."""

    spark: SparkSession
    folder: str
    key: str
    buckets: int
    schema: T.StructType

    def rows_of(self, value: int | str) -> DataFrame:
        """The rows whose key is ``value``, from its bucket alone.

        A bucket of up to ``ONE_TASK_BYTES`` is read by one task, so that what is grouped, joined or sorted after it is not
        shuffled; a larger one, where a hot key lies, by many.
        """
        bucket = zlib.crc32(str(value).encode()) % self.buckets
        path = f"{self.folder}/{BUCKET}={bucket}"
        found = size(self.spark, path)
        if not found:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self.schema).parquet(path).filter(F.col(self.key) == F.lit(value))
        return rows.coalesce(1) if found <= ONE_TASK_BYTES else rows

    def rows(self) -> DataFrame:
        """All rows, those without a key included."""
        return self.spark.read.schema(self.schema).parquet(self.folder).select(self.schema.names)


def write_keyed(df: DataFrame, key: str, folder: str, bucket_rows: int = BUCKET_ROWS) -> KeyedTable:
    """Replace ``folder`` with all rows of ``df`` laid out by ``key``, an integer or a text."""
    spark = df.sparkSession
    buckets = max(1, -(-df.count() // bucket_rows))
    row = F.xxhash64(*df.columns)  # parts the rows of a hot key
    # A range partitioning has no large partitions, also where one key holds most rows; a bucket may lie in several.
    placed = df.withColumn(BUCKET, _bucket(key, buckets)).repartitionByRange(BUCKET, key, row).sortWithinPartitions(BUCKET, key)
    (
        placed.write.mode("overwrite")
        .partitionBy(BUCKET)
        .option("parquet.block.size", ROW_GROUP_BYTES)
        .option("parquet.page.size", ROW_GROUP_BYTES // 4)
        .option("parquet.block.size.row.check.min", 100)
        .option("parquet.bloom.filter.enabled#" + key, "true")
        .option("parquet.bloom.filter.expected.ndv#" + key, BLOOM_ROWS)
        .parquet(folder)
    )
    layout = spark.createDataFrame([(key, buckets, df.schema.json())], "key string, buckets int, fields string")
    layout.coalesce(1).write.mode("overwrite").json(f"{folder}/{LAYOUT}")
    return KeyedTable(spark, folder, key, buckets, df.schema)


def open_keyed(spark: SparkSession, folder: str) -> KeyedTable:
    """A keyed table written before."""
    layout = spark.read.schema("key string, buckets int, fields string").json(f"{folder}/{LAYOUT}").first()
    return KeyedTable(spark, folder, layout.key, layout.buckets, T.StructType.fromJson(json.loads(layout.fields)))
