"""Documents whose elements differ in their fields, kept as VARIANT.

An element holds the fields that it has and no others: no null stands for a field that is missing, and a field that nobody
declared comes back as it was. Fields are read by path; what is in a column can be asked of the column itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "trip_id BIGINT, event VARIANT"


def event_texts(events: DataFrame, **more: Column) -> DataFrame:
    """``(trip_id, event)``: each event as JSON of the fields that it has; ``more`` are fields that are null for some."""
    fields = [F.col("timestamp").cast("string").alias("timestamp"), F.col("type"), F.col("value")]
    return events.select("trip_id", F.to_json(F.struct(*fields, *[c.alias(name) for name, c in more.items()])).alias("event"))


def write_variants(texts: DataFrame, folder: str) -> None:
    """Replace ``folder`` with ``(trip_id, event)``, the JSON text as VARIANT. Text that is no JSON fails the write."""
    texts.select("trip_id", F.parse_json("event").alias("event")).write.mode("overwrite").parquet(folder)


def read_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(folder)


def fields_of(docs: DataFrame, **paths: str) -> DataFrame:
    """``trip_id`` and one column for each field, null where an element lacks it or holds another type."""
    return docs.select("trip_id", *[F.try_variant_get("event", f"$.{name}", kind).alias(name) for name, kind in paths.items()])


def field_names(docs: DataFrame) -> DataFrame:
    """``(type, fields)``: what the elements of each type hold, as a schema."""
    kind = F.variant_get("event", "$.type", "string").alias("type")
    return docs.groupBy(kind).agg(F.schema_of_variant_agg("event").alias("fields"))
