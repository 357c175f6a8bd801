"""Writing and reading the dataset: typed tables, nested documents, CSV and bucketed layouts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pedalflow.operators.skew import TARGET_ROWS, hot_keys
from pedalflow.schemas import ELEMENT, TABLES, Mobility, trip_docs
from pedalflow.session import checkpoint

SALT = "salt"


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` in its order and types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def write_tables(data: Mobility, folder: str, schemas: dict[str, T.StructType] = TABLES) -> None:
    """Replace the four tables with ``data``."""
    for name, df in data._asdict().items():
        conform(df, schemas[name]).write.mode("overwrite").parquet(f"{folder}/{name}")


def read_tables(spark: SparkSession, folder: str, schemas: dict[str, T.StructType] = TABLES) -> Mobility:
    return Mobility(*(spark.read.schema(schemas[n]).parquet(f"{folder}/{n}") for n in Mobility._fields))


def write_docs(docs: DataFrame, folder: str, file_format: str = "parquet") -> None:
    """Replace the trip documents; ``json`` writes one document per line."""
    docs.write.mode("overwrite").format(file_format).save(folder)


def read_docs(
    spark: SparkSession, folder: str, file_format: str = "parquet", element: T.StructType = ELEMENT
) -> DataFrame:
    """The documents; a field of ``element`` that older files lack is null."""
    return spark.read.format(file_format).schema(trip_docs(element)).load(folder)


def write_csv(df: DataFrame, folder: str) -> None:
    """Replace ``folder`` with ``df`` as CSV files that start with a header."""
    df.write.mode("overwrite").option("header", True).csv(folder)


def read_csv(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(folder)


def buckets_for(rows: int, target_rows: int = TARGET_ROWS) -> int:
    """Buckets of a table, each what a task can work on."""
    return max(1, -(-rows // target_rows))


def write_by_key(
    df: DataFrame, key: str, table: str, path: str, buckets: int, unique: bool = False, target_rows: int = TARGET_ROWS
) -> None:
    """Lay all of ``df`` out by ``key`` in the bucketed table ``table``, so that grouping and joining need no shuffle.

    The table has a column ``salt`` more, and its buckets go by key and salt. It is 0 for the rows of ordinary keys,
    which therefore lie together. Rows of a key with more than ``target_rows``, and those without a key, are dealt
    over salts from 1 on by a number of their own, equal rows too, for they would make one bucket as large as all others
    together. ``unique``: no key has two rows, so there is nothing to look for. ``buckets_for`` tells how many buckets to take.
    """
    if unique:
        salted = df.withColumn(SALT, F.lit(0))
    else:
        counts = df.groupBy(key).agg(F.count("*").alias("n"))
        with_slots = df.join(hot_keys(counts, key, target_rows=target_rows), key, "left")
        slots = F.when(F.col(key).isNull(), F.lit(buckets)).otherwise(F.col("slots"))
        ordinary = with_slots.filter(slots.isNull()).select(*df.columns, F.lit(0).alias(SALT))
        # Numbers are written before they are used, so a task that runs again deals its rows as before.
        hot = checkpoint(with_slots.filter(slots.isNotNull()).withColumns({"slots": slots, "_row": F.monotonically_increasing_id()}))
        salt = (F.pmod(F.xxhash64("_row"), F.col("slots")) + 1).cast("int")
        salted = ordinary.unionByName(hot.select(*df.columns, salt.alias(SALT)))
    (
        salted.repartition(buckets, key, SALT)
        .write.mode("overwrite")
        .option("path", f"{path}/{table}")
        .bucketBy(buckets, key, SALT)
        .sortBy(key, SALT)
        .saveAsTable(table)
    )
