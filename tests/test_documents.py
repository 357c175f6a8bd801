from __future__ import annotations

import pytest

from pyspark.sql import functions as F

from helpers import at, plan_of, rows
from pedalflow.operators import documents as d
from pedalflow.operators import evolution, relational
from pedalflow.schemas import EVENTS, TRIPS


@pytest.fixture(scope="module")
def docs(city):
    return d.embed_events(city.trips, city.events)


def arrays(trip_docs):
    return {t.trip_id: [tuple(e) for e in t.events] for t in trip_docs.filter("part = 0").collect()}


def test_embed_sorts_by_time_and_gives_empty_arrays(docs):
    got = arrays(docs)
    assert got[100] == [
        ("2024-03-10 01:10:00", "BATTERY", "85%"),
        ("2024-03-10 01:15:00", "ERROR", "Brake fault detected"),
        ("2024-03-10 01:20:00", "ERROR", "Sensor failure"),
    ]
    assert got[102] == [] and len(got) == 7
    assert docs.count() == 7


def test_unembed_is_the_inverse(docs, city):
    there = sorted(rows(d.unembed_events(docs).select("trip_id", "type", "value")))
    known = city.events.join(city.trips, "trip_id", "left_semi").select("trip_id", "type", "value")
    assert there == sorted(rows(known))


def hot_data(spark):
    """One trip with a third of all events, and one that is unknown with as many."""
    n = 900
    trips = [(i, 1, 1, 2, None, None, 1.0) for i in range(60)]
    events = [(i, 7 if i % 3 == 0 else 99 if i % 3 == 1 else i % 60, at(i % 24, i % 60), "ERROR" if i == 3 else "GPS", str(i)) for i in range(n)]
    return spark.createDataFrame(trips, TRIPS), spark.createDataFrame(events, EVENTS)


def test_a_trip_with_many_events_has_several_documents(spark):
    trips, events = hot_data(spark)
    docs = d.embed_events(trips, events, part_events=40)
    parts = {(t.trip_id, t.part): t.events for t in docs.collect()}
    assert {p for i, p in parts if i == 7} == set(range(8)) and {p for i, p in parts if i != 7} == {0}
    assert [len(parts[7, p]) for p in range(8)] == [40] * 7 + [20]
    in_order = [tuple(e) for p in range(8) for e in parts[7, p]]
    assert in_order == sorted(in_order) and len(set(in_order)) == 300
    assert all(i != 99 for i, _ in parts) and len({i for i, _ in parts}) == 60


def test_the_size_of_parts_changes_no_answer(spark, city):
    """Two events to a document or a million, with a large trip and a large unknown one."""
    trips, events = hot_data(spark)
    trips, events = trips.unionByName(city.trips), events.unionByName(city.events)
    small, large = (d.embed_events(trips, events, part_events=n) for n in (2, 1_000_000))
    assert large.filter("part > 0").isEmpty() and not small.filter("part > 0").isEmpty()

    def answers(docs):
        return {
            "fields": docs.schema.simpleString(),
            "unembed": d.unembed_events(docs),
            "error trips": d.error_trips(docs),
            "with GPS": d.docs_with_event(docs, "GPS"),
            "details": d.trip_details(docs, city.users, city.stations),
            "users": d.user_stats(docs, city.users),
            "stations": d.station_counts(docs, city.stations),
            "unwind": d.unwind_events(docs),
            "unwind, empty kept": d.unwind_events(docs, keep_empty=True),
            "unwind errors": d.unwind_events(docs, lambda e: e["type"] == "ERROR"),
            "unwind errors, empty kept": d.unwind_events(docs, lambda e: e["type"] == "ERROR", keep_empty=True),
            "evolved": d.unembed_events(evolution.add_battery_level_docs(docs)),
            "counts": evolution.evolve_counts_docs(docs),
            "sample": evolution.evolve_sample_docs(docs),
        }

    def plain(answer):
        return answer if isinstance(answer, str) else sorted(map(str, answer.collect()))

    expected = {name: plain(a) for name, a in answers(large).items()}
    assert {name: plain(a) for name, a in answers(small).items()} == expected
    assert len(expected["unwind errors, empty kept"]) == 68 and len(expected["unembed"]) == 606


def test_document_queries_agree_with_the_relational_ones(docs, city):
    detail = sorted(rows(relational.trip_details(city.trips, city.users, city.stations).drop("start_time", "end_time")))
    assert sorted(rows(d.trip_details(docs, city.users, city.stations).drop("start_time", "end_time"))) == detail
    ids = {t.trip_id for t in relational.trips_with_event(city.trips, city.events, "ERROR").collect()}
    assert {t.trip_id for t in d.error_trips(docs).collect()} == ids


def test_user_stats_keeps_ids_without_a_user(docs, city):
    assert rows(d.user_stats(docs, city.users)) == [
        (2, "Ben", "B", 3, 2 / 3),
        (1, "Ann", "A", 2, 20.0),
        (None, None, None, 1, 20.0),
        (9, None, None, 1, 5.0),
    ]


def test_station_counts_names_unknown_ids(docs, city):
    got = {t[0]: t[1:] for t in rows(d.station_counts(docs, city.stations))}
    assert got == {
        20: ("South", "Rome", 2, 3),
        10: ("North", "Rome", 2, 2),
        30: ("East", "Bari", 1, 2),
        99: ("unknown", "unknown", 1, 0),
        None: ("unknown", "unknown", 1, 0),
    }


def test_lookup_and_unwind(docs, city):
    trips = docs.select("trip_id", "user_id")
    found = d.lookup(trips, city.users, "user_id", "user_id", "user")
    sizes = {t.trip_id: len(t.user) for t in found.collect()}
    assert sizes == {100: 1, 101: 1, 102: 1, 103: 0, 104: 0, 105: 1, 106: 1}
    assert d.unwind(found, "user").count() == 5
    kept = d.unwind(found, "user", keep_empty=True)
    assert {t.trip_id for t in kept.collect() if t.user is None} == {103, 104}
    fused = d.lookup_one(trips, city.users, "user_id", "user_id", "user", keep_missing=True)
    assert sorted(map(str, rows(fused))) == sorted(map(str, rows(kept)))


def test_lookup_gives_all_matches_in_one_array(docs, city):
    twice = city.users.unionByName(city.users.filter("user_id = 1").withColumn("name", F.lit("Anna")))
    twice = twice.unionByName(city.users.filter("user_id = 3").withColumn("user_id", F.lit(None).cast("bigint")))
    found = d.lookup(docs.select("trip_id", "user_id"), twice, "user_id", "user_id", "user").collect()
    assert {t.trip_id: [u.name for u in t.user] for t in found} == {
        100: ["Ann", "Anna"], 101: ["Ann", "Anna"], 102: ["Ben"], 103: ["Cy"], 104: [], 105: ["Ben"], 106: ["Ben"]
    }
    with pytest.raises(ValueError, match="more than 1 rows"):
        d.lookup(docs, twice, "user_id", "user_id", "user", max_matches=1)


def test_an_embedding_without_large_trips_shuffles_events_once(city):
    plan = plan_of(d.error_trips(d.embed_events(city.trips, city.events))).split("== Initial Plan ==")[0]
    assert plan.count("partial_collect_list") == 1 and "Union" not in plan and "LeftAnti" not in plan


def test_queries_that_ignore_events_do_not_embed_them(city, docs):
    for df in (
        d.trip_details(docs, city.users, city.stations),
        d.user_stats(docs, city.users),
        d.station_counts(docs, city.stations),
    ):
        assert "collect_list" not in plan_of(df)


def test_questions_about_trips_read_no_event(spark, city, tmp_path):
    """The heads of documents come from the trips alone, and no job runs before the question is asked."""
    city.events.write.parquet(str(tmp_path / "events"))
    events = spark.read.schema(EVENTS).parquet(str(tmp_path / "events"))
    docs, heads = d.embed_events(city.trips, events), d.trip_heads(city.trips)
    for question in (
        lambda x: d.trip_details(x, city.users, city.stations),
        lambda x: d.user_stats(x, city.users),
        lambda x: d.station_counts(x, city.stations),
        d.one_per_trip,
    ):
        assert sorted(rows(question(heads)), key=str) == sorted(rows(question(docs)), key=str)
        assert "parquet" not in plan_of(question(heads)).lower()


def test_documents_know_their_number(city):
    small = d.embed_events(city.trips, city.events, part_events=1)
    parts = {}
    for r in small.collect():
        parts.setdefault(r.trip_id, []).append((r.part, r.parts))
    assert all(sorted(p) == [(i, len(p)) for i in range(len(p))] for p in parts.values()) and len(parts[100]) == 3
    assert {(r.part, r.parts) for r in d.embed_events(city.trips, city.events).collect()} == {(0, 1)}


def test_trips_of_one_document_are_found_without_a_shuffle(spark, city, tmp_path):
    for part_events in (1, 100):
        folder = str(tmp_path / str(part_events))
        d.embed_events(city.trips, city.events, part_events).write.parquet(folder)
        found = d.error_trips(spark.read.parquet(folder))
        assert sorted(r.trip_id for r in found.collect()) == [100, 104]
    plan = plan_of(found)
    assert plan.count("Exchange") <= 2 and "EqualTo(parts,1)" in plan and "GreaterThan(parts,1)" in plan
