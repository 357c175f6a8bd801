"""Trips kept in folders by their start station, of which a join with few stations reads a few."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pedalflow.schemas import INT

BUCKETS = 64
STATION_BUCKET = "station_bucket"


def station_bucket(station: str, buckets: int = BUCKETS) -> Column:
    """A bounded number of folders, whatever the number of stations; no station is in bucket -1."""
    return F.coalesce(F.pmod(F.col(station), F.lit(buckets)), F.lit(-1)).cast("int")


def write_by_station(trips: DataFrame, folder: str, buckets: int = BUCKETS) -> None:
    """Replace ``folder`` with ``trips`` by the bucket of their start station, sorted by it in files of similar size; the trips
    of a busy station are several files."""
    placed = trips.withColumn(STATION_BUCKET, station_bucket("start_station_id", buckets))
    order = [STATION_BUCKET, "start_station_id", "trip_id"]
    placed.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").partitionBy(STATION_BUCKET).parquet(folder)


def trips_from_city(
    spark: SparkSession, folder: str, schema: T.StructType, stations: DataFrame, city: str, buckets: int = BUCKETS
) -> DataFrame:
    """The trips that start in a city, with the ``station`` names; the folders to read are found when the query runs, from the
    stations of that city."""
    trips = spark.read.schema(T.StructType([*schema, T.StructField(STATION_BUCKET, INT)])).parquet(folder)
    there = stations.filter(F.col("city") == city).select(
        F.col("station_id").alias("start_station_id"),
        F.col("name").alias("station"),
        station_bucket("station_id", buckets).alias(STATION_BUCKET),
    )
    return trips.join(there, [STATION_BUCKET, "start_station_id"]).drop(STATION_BUCKET)
