"""Stored tables: access by key, updates and new columns in place, merged graphs, rules on write, layouts, VARIANT documents."""

from __future__ import annotations

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import at, plan_of, planned, rows, scan_metrics
from pedalflow.operators import bitmaps, evolution, graph, quality, relational
from pedalflow.plans import queries
from pedalflow.schemas import EVENTS, EVOLVED_EVENTS, INT, TABLES, TRIPS
from pedalflow.sources import changes, checked, generate, graph_store, keyed, layouts, storage, variant_docs


def files(folder) -> dict[str, int]:
    """Data files with their times of change."""
    return {str(f.relative_to(folder)): f.stat().st_mtime_ns for f in Path(folder).rglob("*.parquet")}


# --- access by key ---


@pytest.fixture(scope="module")
def trips_by_user(spark, tmp_path_factory):
    """User 5 has a third of 60,000 trips; 2,000 others share the rest, some have no user."""
    trips = generate.generate_trips(spark, 60_000, 2_000, 50).withColumn(
        "user_id", F.when(F.col("trip_id") % 3 == 0, 5).when(F.col("trip_id") % 500 == 1, None).otherwise(F.col("user_id"))
    )
    trips = spark.createDataFrame(trips.collect(), trips.schema)
    folder = str(tmp_path_factory.mktemp("keyed") / "trips")
    return trips, keyed.write_keyed(trips, "user_id", folder, bucket_rows=10_000)


@pytest.mark.parametrize("user", [5, 1, 1999, -4])
def test_rows_of_a_key(spark, trips_by_user, user):
    trips, table = trips_by_user
    assert sorted(rows(table.rows_of(user))) == sorted(rows(trips.filter(F.col("user_id") == user)))
    again = keyed.open_keyed(spark, table.folder)
    assert again == table and sorted(rows(again.rows()), key=str) == sorted(rows(trips), key=str)


def test_a_key_reads_a_few_row_groups_of_one_bucket(trips_by_user):
    trips, table = trips_by_user
    assert table.buckets == 6
    one = table.rows_of(77)
    wanted = one.count()
    metrics = scan_metrics(one)
    assert metrics["numFiles"] <= 3
    bucket_size = sum(f.stat().st_size for f in Path(table.folder).rglob("*.parquet")) / 6
    assert metrics["filesSize"] <= 3 * bucket_size
    assert wanted <= metrics["numOutputRows"] <= 12_000 < trips.count() / 4
    assert "PushedFilters: [IsNotNull(user_id), EqualTo(user_id,77)]" in plan_of(one)


def test_a_hot_key_lies_in_several_files(trips_by_user):
    _, table = trips_by_user
    sizes = table.rows_of(5).groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n")).collect()
    assert len(sizes) > 1 and max(s.n for s in sizes) < 20_000


def test_reachable_stations_on_a_keyed_table(spark, trips_by_user, tmp_path):
    trips, table = trips_by_user
    users = generate.generate_users(spark, 2_000)
    stations = generate.generate_stations(spark, 50)
    people = keyed.write_keyed(users, "user_id", str(tmp_path / "users"))
    got = graph.reachable_stations_stored(table, people, stations, 1)
    assert rows(got) == rows(graph.reachable_stations(trips, users, stations, 1))
    assert rows(graph.reachable_stations_stored(table, people, stations, 123_456)) == []


def test_a_small_bucket_is_one_task_and_a_large_one_is_not(spark, trips_by_user, monkeypatch):
    trips, table = trips_by_user
    stations = generate.generate_stations(spark, 50)
    users = generate.generate_users(spark, 2_000)
    few = graph.reachable_stations(table.rows_of(77), users.filter("user_id = 77"), stations, 77)
    assert "Exchange hash" not in planned(few) and "Exchange range" not in planned(few)
    monkeypatch.setattr(keyed, "ONE_TASK_BYTES", 1000)
    many = graph.reachable_stations(table.rows_of(77), users.filter("user_id = 77"), stations, 77)
    assert "Exchange hash" in planned(many) and rows(many) == rows(few)


def test_texts_and_odd_keys(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("", 2), ("é", 3), (None, 4), ("a", 5)], "k string, n int")
    table = keyed.write_keyed(df, "k", str(tmp_path / "t"), bucket_rows=1)
    assert sorted(rows(table.rows_of("a"))) == [("a", 1), ("a", 5)] and rows(table.rows_of("é")) == [("é", 3)]
    assert rows(table.rows_of("")) == [("", 2)] and rows(table.rows_of("none")) == [] and table.rows().count() == 5
    none = keyed.write_keyed(df.filter("false"), "k", str(tmp_path / "empty"))
    assert rows(none.rows_of("a")) == []


# --- updates and columns ---

MONTHLY = changes.with_field(EVOLVED_EVENTS, "month", INT)


def battery_events(spark):
    march, may = at(1), at(1).replace(month=5)
    data = [
        (1, 1, march, "BATTERY", "20%", None), (2, 1, march, "GPS", "x", None), (3, 2, may, "BATTERY", "30%", 70),
        (4, 2, may, "GPS", "y", None), (5, 3, None, "GPS", "z", None), (6, 3, at(1).replace(month=7), "BATTERY", "9%", None),
    ]
    return changes.with_month(spark.createDataFrame(data, EVOLVED_EVENTS), "timestamp", "month")


def fill(spark, folder):
    return evolution.update_stored(spark, folder, MONTHLY, "month")


def test_an_update_rewrites_only_the_parts_with_a_row_to_fill(spark, tmp_path):
    folder = str(tmp_path / "events")
    events = battery_events(spark)
    changes.write_parts(events, folder, "month")
    before = files(folder)
    assert fill(spark, folder) == [202403, 202407]
    after = files(folder)
    same = {f for f in before if after.get(f) == before[f]}
    assert {f.split("/")[0] for f in same} == {"month=202405", "month=__HIVE_DEFAULT_PARTITION__"}
    stored = changes.read_parts(spark, folder, MONTHLY).select(events.columns)
    expected = evolution.add_battery_level(events.drop("month")).collect()
    assert sorted(rows(stored.drop("month")), key=str) == sorted(map(tuple, expected), key=str)
    assert fill(spark, folder) == [] and files(folder) == after


def test_an_update_of_rows_without_a_part(spark, tmp_path):
    folder = str(tmp_path / "events")
    changes.write_parts(battery_events(spark), folder, "month")
    assert changes.update_where(spark, folder, MONTHLY, "month", F.col("trip_id") == 3, {"value": F.lit("new")}) == [None, 202407]
    assert changes.read_parts(spark, folder, MONTHLY).filter("value = 'new'").count() == 2
    with pytest.raises(ValueError, match="another part"):
        changes.update_where(spark, folder, MONTHLY, "month", F.lit(True), {"month": F.lit(1)})


def test_the_search_for_parts_reads_the_columns_of_the_condition_only(spark, tmp_path):
    folder = str(tmp_path / "events")
    changes.write_parts(battery_events(spark), folder, "month")
    hit = evolution.missing_level(changes.read_parts(spark, folder, MONTHLY)).select("month").distinct()
    assert "ReadSchema: struct<type:string,battery_level:int>" in plan_of(hit)


def test_a_column_is_added_without_touching_old_files(spark, tmp_path):
    folder = str(tmp_path / "events")
    old = battery_events(spark).select(EVENTS.names)
    changes.append_version(old, folder)
    before = files(folder)
    changes.add_stored_column(spark, folder, evolution.FIELD, INT)
    assert changes.read_versions(spark, folder).schema.names == EVOLVED_EVENTS.names
    assert changes.read_versions(spark, folder).filter(f"{evolution.FIELD} IS NULL").count() == 6
    again = files(folder)
    changes.add_stored_column(spark, folder, evolution.FIELD, INT)
    assert files(folder) == again and before.items() <= again.items()
    new = spark.createDataFrame([(7, 3, at(2), "BATTERY", "80%", 80)], EVOLVED_EVENTS)
    changes.append_version(new, folder)
    both = changes.read_versions(spark, folder)
    assert sorted(rows(both), key=str) == sorted([(*r, None) for r in rows(old)] + rows(new), key=str)
    with pytest.raises(ValueError, match="is int"):
        changes.add_stored_column(spark, folder, evolution.FIELD, T.StringType())


# --- merged graphs ---


def parts_of(m):
    return graph.vertices(m.users, m.stations, m.trips), graph.trip_edges(graph.linked_trips(m.trips, m.users, m.stations))


def test_merging_into_a_stored_graph(spark, city, tmp_path):
    folder = str(tmp_path / "graph")
    first = city._replace(trips=city.trips.filter("trip_id = 100"), stations=city.stations.filter("station_id < 30"))
    assert graph_store.merge_stored(spark, folder, *parts_of(first)) == {"User": 3, "Station": 2, "Trip": 1, "relationships": 3}
    before = files(folder)
    labelled, edges = parts_of(city)
    assert graph_store.merge_stored(spark, folder, labelled, edges) == {"User": 0, "Station": 2, "Trip": 6, "relationships": 6}
    after = files(folder)
    assert before.items() <= after.items()
    for label, df in labelled.items():
        assert sorted(rows(graph_store.read_rows(spark, f"{folder}/{label}", df.schema)), key=str) == sorted(rows(df), key=str)
    assert sorted(rows(graph_store.read_rows(spark, f"{folder}/relationships", edges.schema))) == sorted(rows(edges))
    assert set(graph_store.merge_stored(spark, folder, labelled, edges).values()) == {0} and files(folder) == after


def test_a_row_with_a_known_key_and_other_properties_is_added(spark, tmp_path):
    folder = str(tmp_path / "users")
    users = spark.createDataFrame([(1, "Ann", None, "Italy"), (1, "Ann", None, "Italy"), (2, None, None, None)], "user_id bigint, name string, surname string, country string")
    assert graph_store.merge_rows(spark, folder, users) == 2
    more = spark.createDataFrame([(1, "Ann", None, "France"), (2, None, None, None)], users.schema)
    assert graph_store.merge_rows(spark, folder, more) == 1 == 1 + graph_store.merge_rows(spark, folder, more)
    assert graph_store.merge_rows(spark, folder, more.filter("false")) == 0
    assert rows(quality.duplicate_keys(graph_store.read_rows(spark, folder, users.schema), "user_id")) == [(1, 2)]


def test_stored_rows_are_not_shuffled_and_other_parts_not_read(spark, tmp_path):
    folder = str(tmp_path / "trips")
    schema = "src bigint, dst bigint, rel string"
    stored = spark.range(20_000).selectExpr("id AS src", "id * 7 AS dst", "'PERFORMED' AS rel")
    graph_store.merge_rows(spark, folder, stored, buckets=16)
    batch = spark.createDataFrame([(1, 7, "PERFORMED"), (99_999, 1, "PERFORMED")], schema)
    marked = batch.withColumn("part", graph_store._part(batch.columns, 16))
    touched = [r.part for r in marked.collect()]
    found = graph_store.stored_matches(spark, folder, marked, touched, 100)
    assert found.count() == 1
    assert "Exchange hash" not in planned(found) and "BroadcastHashJoin" in planned(found)
    assert scan_metrics(found)["numOutputRows"] < 20_000 / 16 * 2 * 1.3
    large = graph_store.stored_matches(spark, folder, marked, touched, 1)
    assert large.count() == 1
    assert graph_store.merge_rows(spark, folder, batch, buckets=16, batch_rows=1) == 1


def test_a_large_batch_is_grouped_with_its_parts_in_one_shuffle(spark, tmp_path):
    """Copies and rows with nulls come once; stored rows and the batch are neither sorted nor joined."""
    folder, schema = str(tmp_path / "edges"), "src bigint, dst bigint, rel string"
    first = spark.createDataFrame([(1, None, "a"), (1, None, "a"), (2, 5, None), (None, None, None)], schema)
    assert graph_store.merge_rows(spark, folder, first, buckets=4, batch_rows=1) == 3
    more = spark.createDataFrame([(1, None, "a"), (1, None, "b"), (1, None, "b"), (2, 5, None), (None, None, None), (None, 7, None)], schema)
    assert graph_store.merge_rows(spark, folder, more, buckets=4, batch_rows=1) == 2
    before = files(folder)
    assert graph_store.merge_rows(spark, folder, more, buckets=4, batch_rows=1) == 0 and files(folder) == before
    stored = graph_store.read_rows(spark, folder, first.schema)
    assert sorted(rows(stored), key=str) == sorted({*rows(first), *rows(more)}, key=str)
    new = graph_store.new_rows(stored, more)
    assert rows(new) == []
    assert planned(new).count("Exchange") == 1 and "Join" not in planned(new)


def test_trips_are_worked_out_once_for_all_merges(spark):
    c = queries.Context(spark, "/root/testdata/sf0.001")
    assert queries._merge_stored(c).count() > 0
    assert "lineitem" not in planned(c.trips) and "lineitem" not in planned(c.edges)


# --- rules on write ---


def test_each_kind_of_bad_row_fails_the_write_and_the_old_table_stays(spark, city, tmp_path):
    folder = str(tmp_path / "data")
    good = city._replace(
        trips=city.trips.filter("trip_id IN (100, 101, 102, 103)"), events=city.events.filter("trip_id IN (100, 101)")
    )
    assert checked.write_all_checked(good, folder) == {"users": 3, "stations": 4, "trips": 4, "events": 4}
    before = files(folder)
    user = good.users.filter("user_id = 1")
    bad = {
        "users": {
            "null_country": good.users.withColumn("country", F.lit(None).cast("string")),
            "long_name": good.users.withColumn("name", F.repeat(F.lit("x"), 51)),
            "duplicate_user_id": good.users.unionByName(user.withColumn("name", F.lit("Other"))),
        },
        "trips": {
            "null_start_time": good.trips.withColumn("start_time", F.lit(None).cast("timestamp_ntz")),
            "unknown_user_id": good.trips.withColumn("user_id", F.lit(9).cast("bigint")),
            "unknown_start_station_id": good.trips.withColumn("start_station_id", F.lit(99).cast("bigint")),
        },
        "events": {"unknown_trip_id": city.events, "long_type": good.events.withColumn("type", F.repeat(F.lit("T"), 21))},
    }
    for name, cases in bad.items():
        for rule, df in cases.items():
            with pytest.raises(checked.RuleError, match=rule) as failure:
                checked.write_all_checked(good._replace(**{name: df}), folder)
            assert set(failure.value.broken) == {rule}
            kept = files(f"{folder}/{name}")
            assert {f"{name}/{f}": t for f, t in kept.items()}.items() <= before.items() | files(folder).items()
            assert sorted(rows(checked.read_checked(spark, folder, name)), key=str) == sorted(rows(getattr(good, name)), key=str)
    assert not [p for p in Path(folder).iterdir() if p.suffix]  # nothing staged is left


def test_levels_out_of_range_are_refused(spark, tmp_path):
    events = battery_events(spark).drop("month").filter("timestamp IS NOT NULL")
    rules = checked.rules_of("events", EVOLVED_EVENTS)
    assert checked.write_checked(events, rules, str(tmp_path / "events")) == 5
    with pytest.raises(checked.RuleError, match="range_battery_level: 1"):
        checked.write_checked(events.withColumn(evolution.FIELD, F.col(evolution.FIELD) * 2), rules, str(tmp_path / "events"))
    report = {r.rule: r.broken for r in checked.rule_report(events.withColumn("event_id", F.lit(1)), "events", rules).collect()}
    assert report == {"null_event_id": 0, "null_timestamp": 0, "null_type": 0, "null_value": 0, "long_type": 0, "range_battery_level": 0, "duplicate_event_id": 1}


def test_rules_are_counted_in_the_pass_that_writes(spark, city, tmp_path):
    """The rows are computed once, whatever the number of rules."""
    computed = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            computed.add(b.num_rows)
            yield b

    users = city.users.mapInArrow(count, city.users.schema)
    checked.write_checked(users, checked.rules_of("users", TABLES["users"]), str(tmp_path / "users"))
    assert computed.value == 3


# --- bitmaps ---


def test_distinct_counts_are_exact_and_no_row_is_repeated(spark, city):
    trips = city.trips.unionByName(city.trips)
    got = bitmaps.distinct_counts(trips, "start_station_id", {"user_id": "users", "end_station_id": "destinations"})
    assert sorted(rows(got), key=str) == sorted(rows(relational.distinct_ends(trips)), key=str)
    plan = planned(got)
    assert "Expand" not in plan and "Generate" not in plan


def test_distinct_counts_of_ids_over_many_pages(spark):
    ids = spark.range(30_000).selectExpr("id % 7 AS g", "CASE WHEN id % 11 > 0 THEN (id * 7919) % 200003 - 50000 END AS a", "id % 13 AS b")
    got = bitmaps.distinct_counts(ids, "g", {"a": "n_a", "b": "n_b"})
    expected = ids.groupBy("g").agg(F.countDistinct("a").alias("n_a"), F.countDistinct("b").alias("n_b"))
    assert sorted(rows(got)) == sorted(rows(expected))
    assert rows(bitmaps.distinct_counts(ids.filter("false"), "g", {"a": "n_a"})) == []


def test_distinct_counts_of_scattered_ids_move_no_wide_rows(spark):
    """Ids far apart: a row that is merged stays a few longs, kept by hash aggregates, and is not a page of 4 KB."""
    ids = spark.range(4_000).selectExpr("id % 9 AS g", "(id % 1500) * 1000003 - 7 AS a", "CASE WHEN id % 9 <> 4 THEN id * 65536 END AS b")
    ids = ids.unionByName(spark.createDataFrame([(None, -(2**63), 2**63 - 1), (None, -(2**63), None)], ids.schema))
    got = bitmaps.distinct_counts(ids, "g", {"a": "n_a", "b": "n_b"})
    expected = ids.groupBy("g").agg(F.countDistinct("a").alias("n_a"), F.countDistinct("b").alias("n_b"))
    assert sorted(rows(got), key=str) == sorted(rows(expected), key=str)
    plan = planned(got)
    assert plan.count("HashAggregate") >= 8 and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    assert "bitmap_" not in plan and "Range" not in plan  # both columns read the words written by one pass


def test_rows_without_a_partner_are_not_shuffled(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    trips = spark.range(50_000).selectExpr("id AS trip_id", "id % 9 AS user_id")
    hits = spark.range(500).selectExpr("id * 100 AS trip_id")
    found = bitmaps.semi_join(trips, hits, "trip_id", 500)
    assert sorted(rows(found)) == sorted(rows(trips.join(hits, "trip_id", "left_semi")))
    passing = bitmaps.with_a_chance(trips, "trip_id", bitmaps.key_pages(hits, "trip_id", bitmaps.bits_for(500)), bitmaps.bits_for(500))
    assert 500 <= passing.count() < 7_000
    plan = planned(found)
    assert plan.index("SortMergeJoin") < plan.index("Exchange") < plan.index("BroadcastHashJoin")  # below the exchange
    assert bitmaps.bits_for(1 << 27) is None
    assert sorted(rows(bitmaps.semi_join(trips, hits, "trip_id", 1 << 27))) == sorted(rows(found))


# --- layout by station ---


def test_a_city_reads_the_folders_of_its_stations(spark, tmp_path):
    stations = spark.range(64).selectExpr("id AS station_id", "concat('s', id) AS name", "concat('c', id % 32) AS city")
    trips = generate.generate_trips(spark, 5_000, 100, 64).withColumn("start_station_id", F.col("trip_id") % 66)
    layouts.write_by_station(trips, str(tmp_path / "trips"), buckets=16)
    found = layouts.trips_from_city(spark, str(tmp_path / "trips"), TRIPS, stations, "c3", buckets=16)
    expected = trips.join(stations.filter("city = 'c3'").withColumnRenamed("station_id", "start_station_id"), "start_station_id")
    assert sorted(rows(found.select(TRIPS.names))) == sorted(rows(expected.select(TRIPS.names)))
    assert "dynamicpruning" in planned(found)
    read = scan_metrics(found, "start_station_id")
    assert read["numPartitions"] == 1 and read["numOutputRows"] < 5_000 / 8


def test_a_hot_station_lies_in_several_files(spark, conf, tmp_path):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    trips = generate.generate_trips(spark, 6_000, 100, 64).withColumn("start_station_id", F.when(F.col("trip_id") % 3 == 0, 7).otherwise(F.col("start_station_id")))
    layouts.write_by_station(trips, str(tmp_path / "trips"), buckets=4)
    assert len([f for f in files(tmp_path / "trips") if "station_bucket=3" in f]) > 1


# --- documents of varying fields ---


def test_elements_keep_the_fields_that_they_have(spark, city, tmp_path):
    level = F.when(F.col("type") == "BATTERY", F.regexp_replace("value", "%", "").cast("int"))
    texts = variant_docs.event_texts(city.events, battery_level=level)
    odd = spark.createDataFrame([(100, '{"type":"NEW","value":7,"sensor":{"id":"s1","axes":[1,2.5]}}')], "trip_id bigint, event string")
    folder = str(tmp_path / "docs")
    variant_docs.write_variants(texts.unionByName(odd), folder)
    docs = variant_docs.read_variants(spark, folder)
    back = {r.event for r in docs.select(F.to_json("event").alias("event")).collect()}
    assert '{"sensor":{"axes":[1,2.5],"id":"s1"},"type":"NEW","value":7}' in back
    assert sum("battery_level" in e for e in back) == 2 and len(back) == 8
    read = variant_docs.fields_of(docs, type="string", value="string", battery_level="int", sensor="struct<id:string>")
    by_type = {r.type: r for r in read.filter("trip_id = 100 OR trip_id = 103").collect()}
    assert by_type["BATTERY"].battery_level in (85, 20) and by_type["NEW"].sensor.id == "s1" and by_type["ERROR"].battery_level is None
    fields = {r.type: r.fields for r in variant_docs.field_names(docs).collect()}
    assert "battery_level: BIGINT" in fields["BATTERY"] and "battery_level" not in fields["GPS"] and "axes" in fields["NEW"]


def test_text_that_is_no_json_fails_the_write(spark, tmp_path):
    bad = spark.createDataFrame([(1, "{not json")], "trip_id bigint, event string")
    with pytest.raises(Exception, match="(?i)json"):
        variant_docs.write_variants(bad, str(tmp_path / "docs"))


def test_empty_tables(spark, tmp_path):
    none = spark.range(5).selectExpr("id AS user_id", "'a' AS name", "'b' AS surname", "date'2020-01-01' AS birthdate", "'c' AS country").filter("user_id < 0")
    folder = str(tmp_path / "users")
    for _ in range(2):
        assert checked.write_checked(none, checked.rules_of("users", TABLES["users"]), folder) == 0
    assert spark.read.schema(TABLES["users"]).parquet(folder).isEmpty()
    assert bitmaps.semi_join(none, none.select("user_id"), "user_id", 0).isEmpty()


def test_a_key_is_found_fast(spark, trips_by_user):
    """No exchange, one small folder: a search by key is one short job. A generous bound, for busy machines."""
    _, table = trips_by_user
    table.rows_of(3).collect()
    begun = time.perf_counter()
    table.rows_of(77).collect()
    assert time.perf_counter() - begun < 2 and "Exchange" not in planned(table.rows_of(77))


def test_a_checked_write_replaces_the_table(spark, city, tmp_path):
    folder, rules = str(tmp_path / "users"), checked.rules_of("users", TABLES["users"])
    checked.write_checked(city.users, rules, folder)
    checked.write_checked(city.users.filter("user_id = 2"), rules, folder)
    assert [r[0] for r in rows(storage.conform(spark.read.parquet(folder), TABLES["users"]))] == [2]
