from __future__ import annotations

import pytest

from helpers import rows
from pedalflow.operators import documents as d
from pedalflow.operators import evolution as e
from pedalflow.schemas import EVOLVED_ELEMENT, EVOLVED_EVENTS, trip_docs
from pedalflow.sources import storage


@pytest.fixture(scope="module")
def docs(city):
    return d.embed_events(city.trips, city.events)


def levels(events):
    return {t.event_id: t.battery_level for t in events.collect()}


def test_only_battery_events_without_a_level_are_filled(city):
    first = e.add_battery_level(city.events)
    assert {k: v for k, v in levels(first).items() if v is not None} == {2: 50, 6: 50}
    measured = first.withColumn("battery_level", e.F.when(first.event_id == 2, 7))
    assert levels(e.add_battery_level(measured))[2] == 7
    assert levels(e.add_battery_level(first)) == levels(first)


def test_add_column_twice_is_once(city):
    once = e.add_column(city.events)
    assert e.add_column(once).columns == once.columns == [*city.events.columns, "battery_level"]
    assert once.schema["battery_level"].nullable


def test_range_rule(city):
    bad = city.events.withColumn("battery_level", e.F.when(e.F.col("event_id") == 2, 101).otherwise(e.F.lit(0)))
    assert [t.event_id for t in e.out_of_range(bad).collect()] == [2]
    assert e.out_of_range(e.add_column(city.events)).count() == 0
    with pytest.raises(Exception, match="battery_level out of range: 101"):
        e.checked(bad).collect()


def test_documents_overwrite_and_leave_other_elements_alone(docs):
    once = e.add_battery_level_docs(docs)
    got = {(t.trip_id, t.value): t.battery_level for t in d.unembed_events(once).collect()}
    assert got[100, "85%"] == 50 and got[103, "20%"] == 50 and got[101, "45.0,9.1"] is None
    lowered = once.withColumn(
        "events", e.F.transform("events", lambda x: x.withField("battery_level", e.F.lit(9)))
    )
    again = e.add_battery_level_docs(lowered)
    got = {(t.trip_id, t.value): t.battery_level for t in d.unembed_events(again).collect()}
    assert got[100, "85%"] == 50 and got[101, "45.0,9.1"] == 9


def test_evolved_documents_are_documents(docs):
    evolved = e.add_battery_level_docs(docs)
    assert evolved.schema.simpleString() == trip_docs(EVOLVED_ELEMENT).simpleString()
    fields = [c for c in docs.columns if c != "events"]
    assert sorted(map(str, rows(evolved.select(fields)))) == sorted(map(str, rows(docs.select(fields))))
    assert evolved.filter("size(events) = 0").count() == docs.filter("size(events) = 0").count() == 3


def test_counts(city, docs):
    assert rows(e.evolve_counts(city.events)) == [(2, 2, 8)]
    assert rows(e.evolve_counts(e.add_battery_level(city.events))) == [(2, 0, 8)]
    assert rows(e.evolve_counts_docs(docs)) == [(2, 2)]
    assert rows(e.evolve_counts_docs(e.add_battery_level_docs(docs))) == [(2, 0)]


def test_samples(city, docs):
    assert rows(e.evolve_sample(city.events, 1)) == [(2, 100, "BATTERY", "85%", 50)]
    assert rows(e.evolve_sample_docs(docs, 1)) == [(100, "2024-03-10 01:10:00", "BATTERY", "85%", 50)]


def test_files_of_both_versions_read_as_one(spark, city, tmp_path):
    path = str(tmp_path / "events")
    city.events.write.parquet(f"{path}/v=1")
    e.add_battery_level(city.events).write.parquet(f"{path}/v=2")
    both = spark.read.option("mergeSchema", True).parquet(path)
    assert e.evolve_counts(both.drop("v")).first() == (4, 2, 16)


@pytest.mark.parametrize("file_format", ["json", "parquet"])
def test_documents_of_both_versions_are_read_by_the_new_schema(spark, docs, tmp_path, file_format):
    for name, version in (("old", docs), ("new", e.add_battery_level_docs(docs))):
        storage.write_docs(version, str(tmp_path / name), file_format)
        back = storage.read_docs(spark, str(tmp_path / name), file_format, EVOLVED_ELEMENT)
        filled = d.unembed_events(back).filter("battery_level = 50").count()
        assert filled == (2 if name == "new" else 0)
        assert back.filter("size(events) = 0").count() == 3


def test_evolved_schema(city):
    assert e.add_battery_level(city.events).schema.simpleString() == EVOLVED_EVENTS.simpleString()
