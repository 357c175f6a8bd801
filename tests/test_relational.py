from __future__ import annotations

from pyspark.sql import functions as F

from helpers import rows
from pedalflow.operators import relational as r


def test_trip_details_needs_user_and_both_stations(city):
    out = rows(r.trip_details(city.trips, city.users, city.stations).orderBy("trip_id"))
    assert [(t[0], t[1], t[4], t[5]) for t in out] == [
        (100, "Ann", "North", "South"),
        (101, "Ann", "South", "North"),
        (102, "Ben", "North", "North"),
    ]


def test_user_stats_keeps_users_without_trips_in_order(city):
    assert rows(r.user_stats(city.users, city.trips)) == [
        (2, "Ben", "B", 3, 2 / 3),
        (1, "Ann", "A", 2, 20.0),
        (3, "Cy", "C", 0, None),
    ]


def test_user_stats_nullable_has_no_count_and_sorts_it_last(city):
    assert rows(r.user_stats_nullable(city.users, city.trips))[-1] == (3, "Cy", "C", None, None)


def test_station_counts_all_stations_busiest_first(city):
    assert rows(r.station_counts(city.stations, city.trips)) == [
        (20, "South", "Rome", 2, 3),
        (10, "North", "Rome", 2, 2),
        (30, "East", "Bari", 1, 2),
        (40, "Far", "Turin", 0, 0),
    ]


def test_station_counts_equal_the_join_of_both_ends(city):
    """The double left join with COUNT DISTINCT gives the same, at the price of starts x ends rows."""
    s, t1, t2 = city.stations, city.trips.alias("t1"), city.trips.alias("t2")
    naive = (
        s.join(t1, s.station_id == F.col("t1.start_station_id"), "left")
        .join(t2, s.station_id == F.col("t2.end_station_id"), "left")
        .groupBy("station_id", s.name, "city")
        .agg(F.countDistinct("t1.trip_id"), F.countDistinct("t2.trip_id"))
    )
    assert sorted(rows(naive)) == sorted(rows(r.station_counts(s, city.trips)))


def test_station_traffic_counts_every_known_end_once(city):
    starts, ends = r.station_traffic(city.trips).filter("station_id IS NOT NULL").agg(
        F.sum("trips_starting"), F.sum("trips_ending")
    ).first()
    assert (starts, ends) == (6, 7)


def test_error_trips(city):
    assert [t[0] for t in rows(r.error_trips(city.trips, city.users, city.events))] == [100]
    assert sorted(t.trip_id for t in r.trips_with_event(city.trips, city.events, "ERROR").collect()) == [100, 104]


def test_merge_counts_fills_the_missing_side(city):
    counts = {t[0]: t[1:] for t in rows(r.merge_counts(city.trips))}
    assert counts[99] == (1, 0) and counts[30] == (1, 2)


def test_the_null_id_is_one_key(city):
    trips = city.trips.unionByName(city.trips.filter("trip_id = 100").withColumn("end_station_id", F.lit(None).cast("bigint")))
    merged = rows(r.merge_counts(trips))
    assert [t for t in merged if t[0] is None] == [(None, 1, 1)] and len(merged) == 5


def test_max_ids_of_an_empty_table_is_one(city):
    empty = city.trips.filter("false")
    given = {"trips": (city.trips, "trip_id"), "none": (empty, "trip_id"), "texts": (city.users, "name")}
    assert rows(r.max_ids(given)) == [("trips", "106"), ("none", "1"), ("texts", "Cy")]


def test_top_users_breaks_ties_by_id(city):
    one_each = city.trips.filter("trip_id IN (100, 102)")
    assert [t[0] for t in rows(r.top_users(city.users, one_each, 1))] == [1]


def test_other_small_operators(city):
    assert {t[0]: t[2] for t in rows(r.trips_per_station(city.stations, city.trips))} == {10: 2, 20: 2, 30: 1, 40: 0}
    assert {t[0] for t in rows(r.visited_station_ids(city.trips))} == {None, 10, 20, 30, 99}
    assert {t[0]: t[1:] for t in rows(r.distinct_ends(city.trips))}[20] == (1, 2)
    assert [t[0] for t in rows(r.preview(city.trips, "trip_id", 2))] == [100, 101]
