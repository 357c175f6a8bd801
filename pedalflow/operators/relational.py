"""The analytics on the relational form.

Trips are reduced before they meet another table wherever the result allows it, so the joins
see one row per user or station. Every ordering ends in the id, which makes it total.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pedalflow.functions.scalars import mean_minutes, or_default

ERROR = "ERROR"


def station_names(stations: DataFrame, end: str) -> DataFrame:
    """Station names keyed for one end of a trip: ``start`` or ``end``."""
    return stations.select(
        F.col("station_id").alias(f"{end}_station_id"), F.col("name").alias(f"{end}_station")
    )


def join_two_roles(trips: DataFrame, stations: DataFrame) -> DataFrame:
    """Trips with the names of both their stations; drops trips whose stations are unknown."""
    return trips.join(station_names(stations, "start"), "start_station_id").join(
        station_names(stations, "end"), "end_station_id"
    )


def trip_details(trips: DataFrame, users: DataFrame, stations: DataFrame) -> DataFrame:
    """Every trip with its user and the names of its stations."""
    named = trips.join(users.select("user_id", "name", "surname", "country"), "user_id")
    return join_two_roles(named, stations).select(
        "trip_id", "name", "surname", "country", "start_station", "end_station", "start_time", "end_time", "total_cost"
    )


def trip_stats(trips: DataFrame) -> DataFrame:
    """Trips and mean minutes per user id; the null id is a group of its own."""
    return trips.groupBy("user_id").agg(
        F.count("*").alias("total_trips"), mean_minutes("start_time", "end_time").alias("avg_duration_minutes")
    )


def user_stats(users: DataFrame, trips: DataFrame) -> DataFrame:
    """All users, most trips first; a user without trips has 0 trips and no average."""
    return (
        _stats_of_all_users(users, trip_stats(trips))
        .withColumn("total_trips", or_default("total_trips", 0))
        .orderBy(F.desc("total_trips"), "user_id")
    )


def user_stats_nullable(users: DataFrame, trips: DataFrame) -> DataFrame:
    """As ``user_stats``, but a user without trips has no trip count either and comes last."""
    return _stats_of_all_users(users, trip_stats(trips)).orderBy(F.desc_nulls_last("total_trips"), "user_id")


def _stats_of_all_users(users: DataFrame, stats: DataFrame) -> DataFrame:
    return users.join(stats, "user_id", "left").select(
        "user_id", "name", "surname", "total_trips", "avg_duration_minutes"
    )


def station_traffic(trips: DataFrame) -> DataFrame:
    """Trips starting and ending per station id, from one scan and one shuffle of partial sums."""
    ends = F.array(
        F.struct(F.col("start_station_id").alias("station_id"), F.lit(1).alias("s"), F.lit(0).alias("e")),
        F.struct(F.col("end_station_id").alias("station_id"), F.lit(0).alias("s"), F.lit(1).alias("e")),
    )
    return (
        trips.select(F.inline(ends))
        .groupBy("station_id")
        .agg(F.sum("s").alias("trips_starting"), F.sum("e").alias("trips_ending"))
    )


def station_counts(stations: DataFrame, trips: DataFrame) -> DataFrame:
    """All stations, busiest first, with the trips starting and ending there."""
    return (
        stations.join(station_traffic(trips), "station_id", "left")
        .select(
            "station_id",
            "name",
            "city",
            or_default("trips_starting", 0).alias("trips_starting"),
            or_default("trips_ending", 0).alias("trips_ending"),
        )
        .orderBy(F.desc(F.col("trips_starting") + F.col("trips_ending")), "station_id")
    )


def trips_with_event(trips: DataFrame, events: DataFrame, event_type: str) -> DataFrame:
    """Trips with at least one event of the type; their ids are reduced before the shuffle."""
    hits = events.filter(F.col("type") == event_type).select("trip_id").distinct()
    return trips.join(hits, "trip_id", "left_semi")


def error_trips(trips: DataFrame, users: DataFrame, events: DataFrame) -> DataFrame:
    """Trips with an ERROR event and their users. A trip id is unique, so no DISTINCT is needed."""
    return (
        trips_with_event(trips, events, ERROR)
        .join(users.select("user_id", "name", "surname"), "user_id")
        .select("trip_id", "name", "surname", "start_time", "end_time", "total_cost")
    )


def trips_per_station(stations: DataFrame, trips: DataFrame) -> DataFrame:
    """Left join and aggregate: trips starting at each station, 0 where there are none."""
    starts = trips.groupBy(F.col("start_station_id").alias("station_id")).agg(F.count("trip_id").alias("trips"))
    return stations.join(starts, "station_id", "left").select(
        "station_id", "name", or_default("trips", 0).alias("trips")
    )


def merge_counts(trips: DataFrame) -> DataFrame:
    """Two keyed counts merged on the station id; a count missing on one side is 0. The null id is a key like others."""
    return station_traffic(trips).select(
        "station_id", F.col("trips_starting").alias("starts"), F.col("trips_ending").alias("ends")
    )


def visited_station_ids(trips: DataFrame) -> DataFrame:
    """The distinct ids of stations where a trip starts or ends, the null id included."""
    return trips.select(F.explode(F.array("start_station_id", "end_station_id")).alias("station_id")).distinct()


def distinct_ends(trips: DataFrame) -> DataFrame:
    """Two distinct counts in one group: different users and different destinations per start station."""
    return trips.groupBy("start_station_id").agg(
        F.countDistinct("user_id").alias("users"), F.countDistinct("end_station_id").alias("destinations")
    )


def top_users(users: DataFrame, trips: DataFrame, k: int) -> DataFrame:
    """The k users with the most trips; ties go to the lower id."""
    return user_stats(users, trips).limit(k)


def preview(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """The first n rows by key."""
    return df.orderBy(key).limit(n)


def max_ids(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """The highest key per table as text, 1 for an empty one."""
    parts = [
        df.agg(F.coalesce(F.max(key).cast("string"), F.lit("1")).alias("max_id")).select(F.lit(name).alias("table_name"), "max_id")
        for name, (df, key) in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
