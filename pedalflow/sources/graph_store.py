"""A property graph kept in folders, into which batches are merged at the cost of the batch.

Each label's vertices, and all relationships, are a folder of ``BUCKETS`` parts by the hash of all properties. A merged row
equals a stored one in every property or is added, so it is enough to look into its own part: a batch reads
the parts that it has rows for, and adds files to those that get some. Stored rows are never shuffled while a batch has at most
``BATCH_ROWS`` rows; they are tested where they are read against the batch, which is broadcast. A larger batch is grouped with
the rows of its parts, which finds copies and known rows in one shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pedalflow.session import scratch_path
from pedalflow.sources.folders import exists

BUCKETS = 64
BATCH_ROWS = 200_000  # of some 100 bytes
PART, EDGES = "part", "relationships"


def _part(columns: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in columns]), F.lit(buckets)).cast("int")


def read_rows(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """The stored rows of a label or of the relationships."""
    if not exists(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(T.StructType([*schema, T.StructField(PART, T.IntegerType())])).parquet(folder).drop(PART)


def stored_matches(spark: SparkSession, folder: str, batch: DataFrame, touched: list[int], batch_rows: int) -> DataFrame:
    """The stored rows that equal one of ``batch``, once or more each, from its parts alone."""
    stored = spark.read.schema(batch.schema).parquet(folder).filter(F.col(PART).isin(touched)).alias("old")
    small = batch.count() <= batch_rows
    new = (F.broadcast(batch) if small else batch).alias("new")
    same = [F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in batch.columns]
    return stored.join(new, same, "left_semi")


def new_rows(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """The rows of ``batch`` that equal none of ``stored``, each once; both tables are shuffled once and not sorted."""
    names = [f"`{c}`" for c in batch.columns]
    both = stored.select(*names, F.lit(True).alias("_known")).unionByName(batch.select(*names, F.lit(False).alias("_known")))
    return both.groupBy(*names).agg(F.max("_known").alias("_known")).filter(~F.col("_known")).drop("_known")


def merge_rows(spark: SparkSession, folder: str, incoming: DataFrame, buckets: int = BUCKETS, batch_rows: int = BATCH_ROWS) -> int:
    """Add the rows of ``incoming`` that equal none stored in ``folder``, each once; gives how many. Merging them again writes
    nothing. ``buckets`` must be the same for all merges into a folder."""
    names, schema = incoming.columns, T.StructType([*incoming.schema, T.StructField(PART, T.IntegerType())])
    path = scratch_path(spark, "batch")
    incoming.withColumn(PART, _part(names, buckets)).write.parquet(path)
    batch = spark.read.schema(schema).parquet(path)
    rows = batch.count()
    if not rows:
        return 0
    if not exists(spark, folder):
        _append(batch.distinct(), folder)
        return spark.read.schema(schema).parquet(folder).count()
    touched = [r[0] for r in batch.select(PART).distinct().collect()]  # at most ``buckets`` numbers
    if rows <= batch_rows:
        batch = batch.distinct()
        present = stored_matches(spark, folder, batch, touched, batch_rows).distinct().alias("present")
        same = [F.col(f"batch.{c}").eqNullSafe(F.col(f"present.{c}")) for c in batch.columns]
        new = batch.alias("batch").join(present, same, "left_anti")
    else:
        new = new_rows(spark.read.schema(schema).parquet(folder).filter(F.col(PART).isin(touched)), batch)
    # Written first, so that the rows to add are counted and added as found once.
    added = scratch_path(spark, "added")
    new.write.parquet(added)
    new = spark.read.schema(schema).parquet(added)
    n = new.count()
    if n:
        _append(new, folder)
    return n


def _append(rows: DataFrame, folder: str) -> None:
    """A part's rows go to one file; the batch alone is shuffled."""
    rows.repartition(PART).write.mode("append").partitionBy(PART).parquet(folder)


def merge_stored(
    spark: SparkSession, folder: str, labelled: dict[str, DataFrame], edges: DataFrame, buckets: int = BUCKETS
) -> dict[str, int]:
    """Merge the vertices of every label and the relationships into the graph in ``folder``; gives the rows added to each.

    Relationships come last, so that a run that ends early leaves none without its vertices; running it again completes it.
    """
    added = {label: merge_rows(spark, f"{folder}/{label}", df, buckets) for label, df in labelled.items()}
    added[EDGES] = merge_rows(spark, f"{folder}/{EDGES}", edges, buckets)
    return added
