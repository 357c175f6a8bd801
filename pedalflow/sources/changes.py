"""Changes to stored tables that leave alone what they need not touch: new columns, and updates of some rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pedalflow.schemas import struct


def write_parts(df: DataFrame, folder: str, by: str) -> None:
    """Replace ``folder`` with ``df``, one folder for each value of the column ``by``; many rows of one value are several files."""
    df.repartitionByRange(by, F.xxhash64(*df.columns)).write.mode("overwrite").partitionBy(by).parquet(folder)


def read_parts(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(folder)


def update_where(spark: SparkSession, folder: str, schema: T.StructType, by: str, where: Column, values: dict[str, Column]) -> list:
    """UPDATE the rows of a table stored in parts that meet ``where``; gives the parts that were written anew.

    A first pass reads the columns of ``where`` only and finds the parts with such a row. These are read and written again with
    dynamic partition overwrite, each replaced when the whole job has succeeded; all other files stay as they are. Where no row
    meets the condition nothing is written, so an update whose rows no longer meet their own condition can be run again. A
    condition that is null for a row does not hold for it. ``by`` must not be among ``values``.

    The list of parts that comes to the driver is a list of folders, which it holds for reading the table anyway.
    """
    if by in values:
        raise ValueError(f"rows cannot move to another part: {by}")
    table = read_parts(spark, folder, schema)
    hit = F.coalesce(where, F.lit(False))
    parts = [r[0] for r in table.filter(hit).select(by).distinct().collect()]
    if not parts:
        return []
    known = [p for p in parts if p is not None]
    inside = F.col(by).isin(known) if known else F.lit(False)
    if len(known) < len(parts):
        inside = inside | F.col(by).isNull()
    kinds = {f.name: f.dataType for f in schema}
    changed = {c: F.when(hit, value).otherwise(F.col(c)).cast(kinds[c]) for c, value in values.items()}
    rewritten = table.filter(inside).withColumns(changed).select(schema.names)
    # Rows of one part may be many, so they are not brought together.
    rewritten.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(folder)
    return sorted(parts, key=lambda p: (p is not None, p))


def add_stored_column(spark: SparkSession, folder: str, name: str, kind: T.DataType) -> None:
    """ADD COLUMN: the folder gets one more file, without rows, that has the column; all files before stay as they are.

    A folder that has the column stays as it is; one that has it with another type is refused.
    """
    schema = read_versions(spark, folder).schema
    if name in schema.names:
        if schema[name].dataType != kind:
            raise ValueError(f"{name} is {schema[name].dataType.simpleString()}")
        return
    spark.createDataFrame([], schema.add(T.StructField(name, kind))).write.mode("append").parquet(folder)


def append_version(df: DataFrame, folder: str) -> None:
    """Add rows, which may have more columns than the files before or lack some, to a folder without parts."""
    df.write.mode("append").parquet(folder)


def read_versions(spark: SparkSession, folder: str) -> DataFrame:
    """All rows of files of different versions; a column that a file lacks is null in its rows."""
    return spark.read.option("mergeSchema", "true").parquet(folder)


def with_month(df: DataFrame, time: str, into: str) -> DataFrame:
    """Add ``into``: the month of ``time`` as 202403, by which a table of events is kept in parts."""
    return df.withColumn(into, (F.year(time) * 100 + F.month(time)).cast("int"))


def with_field(schema: T.StructType, name: str, kind: T.DataType) -> T.StructType:
    return struct(**{f.name: f.dataType for f in schema}, **{name: kind})
