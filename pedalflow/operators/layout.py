"""Queries on tables laid out by ``storage.write_by_key``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pedalflow.functions.scalars import duration_seconds, or_default


def user_stats(spark: SparkSession, users_table: str, trips_table: str) -> DataFrame:
    """``relational.user_stats`` without its order, on users and trips laid out by ``user_id``.

    Grouping and joining the trips of ordinary users (salt 0) shuffles nothing. Those of hot users are first reduced
    where they lie, to one row for each of a user's salts; only these rows move.
    """
    trips = spark.table(trips_table)
    sums = [F.count("*").alias("n"), F.sum(duration_seconds("start_time", "end_time")).alias("s"),
            F.count(duration_seconds("start_time", "end_time")).alias("timed")]
    ordinary = trips.filter("salt = 0").groupBy("user_id", "salt").agg(*sums)
    per_salt = trips.filter("salt > 0").groupBy("user_id", "salt").agg(*sums)
    hot = per_salt.groupBy("user_id").agg(*[F.sum(c).alias(f"hot_{c}") for c in ("n", "s", "timed")])
    known = spark.table(users_table).join(ordinary, ["user_id", "salt"], "left").join(hot, "user_id", "left")
    seconds, timed = F.coalesce("hot_s", "s"), F.coalesce("hot_timed", "timed")
    return known.select(
        "user_id",
        "name",
        "surname",
        or_default(F.coalesce("hot_n", "n"), 0).alias("total_trips"),
        F.when(timed > 0, seconds.cast("double") / timed / F.lit(60.0)).alias("avg_duration_minutes"),
    )
