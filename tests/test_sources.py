from __future__ import annotations

import datetime
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from helpers import plan_of, planned, rows
from pedalflow.operators import documents, layout, relational
from pedalflow.plans import timing
from pedalflow.schemas import EVENTS, STATIONS, TABLES, TRIPS, USERS
from pedalflow.sources import generate as g
from pedalflow.sources import given, storage


def test_tables_come_back_as_written(spark, city, tmp_path):
    storage.write_tables(city, str(tmp_path))
    stored = storage.read_tables(spark, str(tmp_path))
    for name, df in stored._asdict().items():
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in TABLES[name]]
        assert sorted(map(str, rows(df))) == sorted(map(str, rows(getattr(city, name))))
    storage.write_tables(city._replace(trips=city.trips.filter("trip_id = 100")), str(tmp_path))
    assert storage.read_tables(spark, str(tmp_path)).trips.count() == 1


@pytest.mark.parametrize("file_format", ["json", "parquet"])
def test_documents_come_back_as_written(spark, city, tmp_path, file_format):
    docs = documents.embed_events(city.trips, city.events, part_events=2)
    storage.write_docs(docs, str(tmp_path), file_format)
    back = storage.read_docs(spark, str(tmp_path), file_format)
    assert sorted(map(str, rows(docs))) == sorted(map(str, rows(back.select(docs.columns)))) and docs.count() == 8


def test_a_json_document_holds_its_events(city, tmp_path):
    storage.write_docs(documents.embed_events(city.trips, city.events), str(tmp_path), "json")
    lines = [json.loads(x) for f in Path(tmp_path).glob("*.json") for x in f.read_text().splitlines()]
    by_id = {doc["trip_id"]: doc for doc in lines}
    assert by_id[101]["events"] == [{"timestamp": "2024-03-10 02:05:00", "type": "GPS", "value": "45.0,9.1"}]
    assert by_id[102]["events"] == [] and by_id[102]["start_time"] == "2024-03-10 03:00:00"


def test_csv_has_a_header(spark, city, tmp_path):
    stats = relational.user_stats(city.users, city.trips)
    storage.write_csv(stats, str(tmp_path / "out"))
    first = next(f for f in Path(tmp_path, "out").glob("*.csv") if f.stat().st_size).read_text().splitlines()[0]
    assert first == "user_id,name,surname,total_trips,avg_duration_minutes"
    back = storage.read_csv(spark, str(tmp_path / "out"), stats.schema)
    assert sorted(rows(back), key=str) == sorted(rows(stats), key=str)


def test_layout_by_user_needs_no_shuffle_and_splits_the_hot_user(spark, conf, tmp_path):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    n = 3000
    users = g.generate_users(spark, 200)
    trips = g.generate_trips(spark, n, 200, 20).withColumn(
        "user_id", F.when(F.col("trip_id") % 3 == 0, 5).when(F.col("trip_id") % 50 == 1, None).otherwise(F.col("user_id"))
    )
    storage.write_by_key(trips, "user_id", "t_trips", str(tmp_path), buckets=4, target_rows=100)
    storage.write_by_key(users, "user_id", "t_users", str(tmp_path), buckets=4, unique=True)
    whole = spark.table("t_trips")
    assert sorted(rows(whole.drop("salt"))) == sorted(rows(trips))
    salts = whole.groupBy("user_id").agg(F.countDistinct("salt").alias("n"), F.min("salt").alias("low")).collect()
    assert {s.user_id: s.n for s in salts if s.low > 0}.keys() == {5, None} and all(s.n == 1 for s in salts if s.low == 0)
    assert {s.user_id: s.n for s in salts}[5] > 8

    stats = layout.user_stats(spark, "t_users", "t_trips")
    expected = relational.user_stats(users, trips)
    assert sorted(rows(stats), key=str) == sorted(rows(expected), key=str)
    ordinary = spark.table("t_users").join(
        whole.filter("salt = 0").groupBy("user_id", "salt").agg(F.count("*").alias("n")), ["user_id", "salt"], "left"
    )
    assert "Exchange" not in planned(ordinary)
    for table in ("t_trips", "t_users"):
        spark.sql(f"DROP TABLE {table}")


def test_generated_data_keeps_its_rules(spark):
    data = g.generate_dataset(spark, n_users=300, n_trips=2000, events_per_trip=3, n_stations=40)
    for df, schema in zip(data, (USERS, STATIONS, TRIPS, EVENTS)):
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schema]
    assert [df.count() for df in data] == [300, 40, 2000, 6000]
    names = [s.name for s in data.stations.collect()]
    assert len(set(names)) == 40
    cities = {s.city for s in data.stations.collect()}
    assert cities <= set(g.CITIES) and all(any(n.startswith(c) for c in cities) for n in names)

    trips = data.trips.collect()
    assert len({t.user_id for t in trips}) > 290 and {t.user_id for t in trips} <= set(range(1, 301))
    assert {t.start_station_id for t in trips} == {t.end_station_id for t in trips} == set(range(1, 41))
    for t in trips:
        assert t.start_station_id != t.end_station_id
        minutes = (t.end_time - t.start_time).total_seconds() / 60
        assert 5 <= minutes <= 120 and 6 <= t.start_time.hour <= 22 and t.start_time.year == 2024
        assert 0.99 <= round(t.total_cost - 0.15 * minutes, 6) <= 3.01
        assert t.total_cost == round(t.total_cost, 2)
    by_id = {t.trip_id: t for t in trips}
    events = data.events.collect()
    assert sorted(e.event_id for e in events) == list(range(1, 6001))
    for e in events:
        assert by_id[e.trip_id].start_time <= e.timestamp <= by_id[e.trip_id].end_time
        assert e.value in g.EVENT_VALUES[e.type] and e.timestamp.microsecond == 0
    assert {e.type for e in events} == set(g.EVENT_TYPES)
    born = [u.birthdate for u in data.users.collect()]
    assert min(born) >= datetime.date(1960, 1, 1) and max(born) <= datetime.date(1999, 12, 31)


def test_generator_edges(spark):
    trips = g.generate_trips(spark, 10, 3, 2)
    none = g.generate_events(trips, 0)
    assert none.count() == 0 and none.columns == [f.name for f in EVENTS]
    assert g.generate_stations(spark, 400).select("name").distinct().count() == 400
    with pytest.raises(ValueError):
        g.generate_trips(spark, 10, 3, 1)
    assert rows(g.generate_trips(spark, 10, 3, 2)) == rows(trips.repartition(3).orderBy("trip_id"))


def test_sizes_of_the_sweep():
    assert len(timing.all_sizes()) == 36 and set(timing.QUICK) <= set(timing.all_sizes())


def test_sweep_keeps_one_row_per_size(spark, tmp_path):
    table = timing.sweep(spark, [(20, 50, 0), (20, 50, 2)], str(tmp_path / "csv"))
    got = sorted(rows(table))
    assert [r[:3] for r in got] == [(20, 50, 0.0), (20, 50, 2.0)]
    assert all(s > 0 for r in got for s in r[3:])


def test_winners(spark):
    timings = "a_Q1 double, a_Q2 double, b_Q1 double, b_Q2 double"
    table = spark.createDataFrame(
        [(1, 10, 2.0, 0.5, 4.0, 2.0, 1.0)], f"n_users long, n_trips long, events_per_trip double, {timings}"
    )
    got = {r["query"]: (r.winner, r.seconds, r.speedup) for r in timing.winners(table).collect()}
    assert got == {"Q1": ("a", 0.5, 4.0), "Q2": ("b", 1.0, 4.0)}


def test_time_does_not_depend_on_the_session_zone(spark, conf, city):
    conf(spark__sql__session__timeZone="America/New_York")
    # On 2024-03-10 the hour from 2 to 3 does not exist there.
    docs = documents.embed_events(city.trips, city.events)
    parsed = documents.parsed_times(documents.one_per_trip(docs))
    assert {t.user_id: t.avg_duration_minutes for t in relational.trip_stats(parsed).collect()}[1] == 20.0
    assert {t.user_id: t.avg_duration_minutes for t in relational.trip_stats(city.trips).collect()}[1] == 20.0
    assert {t.trip_id: t.start_time for t in docs.collect()}[101] == "2024-03-10 02:00:00"


def test_filters_and_columns_reach_the_scan(spark, conf, city, tmp_path):
    conf(spark__sql__maxMetadataStringLength="1000")
    storage.write_tables(city, str(tmp_path))
    storage.write_docs(documents.embed_events(city.trips, city.events), str(tmp_path / "docs"))
    stored, docs = storage.read_tables(spark, str(tmp_path)), storage.read_docs(spark, str(tmp_path / "docs"))
    plan = plan_of(relational.error_trips(stored.trips, stored.users, stored.events))
    assert "EqualTo(type,ERROR)" in plan and "ReadSchema: struct<trip_id:bigint,type:string>" in plan
    plan = plan_of(documents.error_trips(docs))
    assert "events:array<struct<type:string>>" in plan
    plan = plan_of(documents.user_stats(docs, stored.users))
    assert "events" not in plan and "EqualTo(part,0)" in plan


def line_items(spark, rows, folder):
    """Given tables of one order with these shipments (line, supplier, time)."""
    schema = given.GIVEN["lineitem"]
    lines = [(1, 7, supplier, line, 5.0, 1.0, 0.0, 0.0, "N", "O", time) for line, supplier, time in rows]
    spark.createDataFrame(lines, schema).write.parquet(f"{folder}/lineitem.parquet")
    orders = [(1, 1, "O", 9.5, datetime.datetime(2024, 1, 1), "LOW")]
    spark.createDataFrame(orders, given.GIVEN["orders"]).write.parquet(f"{folder}/orders.parquet")


def test_a_trip_keeps_full_ids_and_times(spark, conf, tmp_path):
    conf(spark__sql__session__timeZone="America/New_York")
    day = datetime.datetime(2024, 3, 10)
    morning, evening = day.replace(hour=2, minute=30, second=1, microsecond=5), day.replace(hour=20)
    line_items(spark, [(1, 9, morning), (2, 4, evening)], tmp_path / "a")
    assert rows(given.trips(spark, str(tmp_path / "a"))) == [(1, 1, 9, 4, morning, evening, 9.5)]
    assert len({e.event_id for e in given.trip_events(spark, str(tmp_path / "a")).collect()}) == 2

    far = [(1, 2**62 + 5, day), (2, -3, day), (3, 2**40 + 5, datetime.datetime(1901, 12, 13, 20, 45, 52, 999999)), (4, -(2**63), day)]
    line_items(spark, far, tmp_path / "b")
    assert rows(given.trips(spark, str(tmp_path / "b"))) == [(1, 1, 2**40 + 5, 2**62 + 5, far[2][2], day, 9.5)]
    plan = planned(given.trips(spark, str(tmp_path / "b")))
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_lines_of_one_order_that_differ_in_time_only_are_two_events(spark, tmp_path):
    day = datetime.datetime(2024, 3, 10)
    line_items(spark, [(1, 9, day), (1, 9, day.replace(microsecond=1))], tmp_path)
    assert given.trip_events(spark, str(tmp_path)).select("event_id").distinct().count() == 2
