"""One key with a third of all rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from helpers import plan_of, rows
from pedalflow.operators import graph, relational, skew
from pedalflow.operators.skew import hot_keys, replicate, salted_join, spread
from pedalflow.sources import generate

HOT = 5


@pytest.fixture(scope="module")
def fact(spark):
    hot = F.when(F.col("id") % 3 == 0, HOT).when(F.col("id") % 100 == 1, None).otherwise(F.col("id") % 50)
    return spark.range(3000).select(F.col("id"), hot.alias("k"))


@pytest.fixture(scope="module")
def dim(spark):
    return spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 10).alias("x"))


def test_a_key_is_hot_by_its_own_rows(fact):
    counts = fact.groupBy("k").agg(F.count("*").alias("n"))
    assert rows(hot_keys(counts, "k", target_rows=100)) == [(HOT, 11)]
    assert rows(hot_keys(counts, "k")) == []
    # However large the rest of the table is: this key has less than 0.05 % of the rows.
    more = counts.unionByName(counts.sparkSession.createDataFrame([(77, 3_000_000)], "k long, n long"))
    assert sorted(rows(hot_keys(more, "k", target_rows=1000))) == [(HOT, 2), (77, 3000)]


def test_a_long_list_of_hot_keys_is_not_broadcast(fact, dim, conf, monkeypatch):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    counts = fact.groupBy("k").agg(F.count("*").alias("n"))
    joined = salted_join(fact, dim, hot_keys(counts, "k", target_rows=20), "k", F.col("id"))
    assert "BroadcastHashJoin" in plan_of(joined)
    monkeypatch.setattr(skew, "MAX_BROADCAST_KEYS", 3)
    apart = salted_join(fact, dim, hot_keys(counts, "k", target_rows=20), "k", F.col("id"))
    assert "BroadcastHashJoin" not in plan_of(apart)
    assert sorted(rows(apart.select("id", "x"))) == sorted(rows(joined.select("id", "x")))


def test_salted_join_equals_the_join_and_splits_the_hot_key(fact, dim):
    counts = fact.groupBy("k").agg(F.count("*").alias("n"))
    hot = hot_keys(counts, "k", target_rows=100)
    plain = sorted(rows(fact.join(dim, "k").select("id", "k", "x")))
    for chosen in (hot, None):
        assert sorted(rows(salted_join(fact, dim, chosen, "k", F.col("id")).select("id", "k", "x"))) == plain
    sizes = spread(fact, hot, "k", F.col("id")).filter(F.col("k") == HOT).groupBy("slot").count().collect()
    assert len(sizes) >= 9 and max(s["count"] for s in sizes) < 200
    assert replicate(dim, hot, "k").count() == 49 + len(sizes)


def test_a_join_of_raw_tables_is_split_at_run_time(spark, conf, tmp_path):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="40KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
    )
    data = generate.generate_dataset(spark, 300, 30_000, 1, 40)
    hot = F.when(F.col("trip_id") % 3 == 0, HOT)
    trips = data.trips.withColumn("user_id", F.coalesce(hot, "user_id")).repartition(6)
    trips.write.parquet(str(tmp_path / "trips"))
    trips = spark.read.schema(data.trips.schema).parquet(str(tmp_path / "trips"))

    details = relational.trip_details(trips, data.users, data.stations)
    assert "skew=true" in plan_of(details)
    linked = graph.linked_trips(trips, data.users, data.stations)
    assert "skew=true" in plan_of(linked)
    assert details.count() == linked.count() == 30_000


def test_aggregates_shrink_before_they_shuffle(spark, city):
    """Per-key results are combined on the map side; no raw trip is shuffled to its user or station."""
    for df in (
        relational.trip_stats(city.trips),
        relational.station_traffic(city.trips),
        relational.trips_with_event(city.trips, city.events, "ERROR").select("trip_id"),
    ):
        plan = plan_of(df).split("== Initial Plan ==")[-1]
        assert "Window" not in plan and "collect_list" not in plan
        below = plan.index("Exchange hashpartitioning")
        assert "HashAggregate" in plan[below:], plan
