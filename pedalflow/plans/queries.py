"""Every query and operator by name, on the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pedalflow.functions import scalars
from pedalflow.operators import bitmaps, documents, evolution, graph, graph_loops, layout, quality, relational
from pedalflow.schemas import INT, TABLES, Mobility
from pedalflow.session import checkpoint, drop_at_exit, in_session, scratch_path
from pedalflow.sources import changes, checked, generate, given, graph_store, keyed, layouts, storage, variant_docs

USER_ID, CITY = 1, "FRANCE"

# The given events are keyed by text (see given.trip_events).
GIVEN_TABLES = TABLES | {
    "events": T.StructType([T.StructField("event_id", T.StringType()), *TABLES["events"].fields[1:]])
}


@dataclass
class Context:
    """The given tables in the forms the queries read; nothing runs until a query needs it."""

    spark: SparkSession
    folder: str

    @cached_property
    def data(self) -> Mobility:
        return given.load(self.spark, self.folder)

    users = property(lambda self: self.data.users)
    stations = property(lambda self: self.data.stations)
    trips = property(lambda self: self.data.trips)
    events = property(lambda self: self.data.events)

    @cached_property
    def docs(self) -> DataFrame:
        return documents.embed_events(self.trips, self.events)

    @cached_property
    def heads(self) -> DataFrame:
        """The documents without their events."""
        return documents.trip_heads(self.trips)

    @cached_property
    def leveled_events(self) -> DataFrame:
        """Events of which the BATTERY ones at 25% or less already report a level."""
        level = F.regexp_replace("value", "%", "").cast("int")
        return self.events.withColumn(
            evolution.FIELD, F.when((F.col("type") == evolution.BATTERY) & (level <= 25), level)
        )

    @cached_property
    def graph(self) -> tuple[DataFrame, DataFrame]:
        return graph.station_graph(self.stations, self.trips)

    @cached_property
    def edges(self) -> DataFrame:
        return graph.trip_edges(graph.linked_trips(self.trips, self.users, self.stations))


def _rounded(ranks: DataFrame) -> DataFrame:
    return ranks.withColumn("pagerank", F.round("pagerank", 6))


def _events_json(df: DataFrame) -> DataFrame:
    return df.withColumn("events", F.to_json("events", {"ignoreNullFields": "false"}))


def _unwound(c: Context, keep_empty: bool) -> DataFrame:
    """All events with fields of their trips."""
    unwound = documents.unwind_events(c.docs, keep_empty=keep_empty)
    return unwound.select("trip_id", "user_id", "event.timestamp", "event.type", "event.value")


def _write_tables(c: Context) -> DataFrame:
    folder = scratch_path(c.spark, "tables")
    storage.write_tables(c.data, folder, GIVEN_TABLES)
    stored = storage.read_tables(c.spark, folder, GIVEN_TABLES)
    per_trip = stored.events.groupBy("trip_id").agg(F.count("*").alias("n_events"))
    details = relational.trip_details(stored.trips, stored.users, stored.stations)
    return details.join(per_trip, "trip_id", "left").withColumn("n_events", scalars.or_default("n_events", 0))


def _write_docs(c: Context) -> DataFrame:
    folder = scratch_path(c.spark, "docs")
    storage.write_docs(c.docs, folder, "json")
    return _events_json(storage.read_docs(c.spark, folder, "json"))


def _csv_sink(c: Context) -> DataFrame:
    stats = relational.user_stats(c.users, c.trips)
    folder = scratch_path(c.spark, "csv")
    storage.write_csv(stats, folder)
    return storage.read_csv(c.spark, folder, stats.schema)


def _partition_layout(c: Context) -> DataFrame:
    path, suffix = scratch_path(c.spark, "layout"), uuid.uuid4().hex[:8]
    trips, users = f"trips_{suffix}", f"users_{suffix}"
    buckets = storage.buckets_for(c.trips.count())
    storage.write_by_key(c.trips, "user_id", trips, path, buckets)
    storage.write_by_key(c.users, "user_id", users, path, buckets, unique=True)
    for table in (trips, users):
        drop_at_exit(c.spark, table)
    return layout.user_stats(c.spark, users, trips)


def _scan_stations_edges(c: Context) -> DataFrame:
    none = F.lit(None)
    nodes = c.stations.select(
        F.lit("station").alias("kind"),
        F.col("station_id").alias("a"),
        none.cast("bigint").alias("b"),
        "name",
        "city",
    )
    ends = c.trips.select(
        F.lit("trip").alias("kind"),
        F.col("start_station_id").alias("a"),
        F.col("end_station_id").alias("b"),
        none.cast("string").alias("name"),
        none.cast("string").alias("city"),
    )
    return nodes.unionByName(ends)


def _merge_upsert(c: Context) -> DataFrame:
    """The trips of users in credit are loaded with their users and stations, then all of the graph: the rest is added
    and nothing doubled. Vertices and edges in one table."""
    part = _credit_part(c)
    labelled, edges = graph.merge_graph(
        graph.vertices(part.users, part.stations, part.trips),
        graph.trip_edges(graph.linked_trips(part.trips, part.users, part.stations)),
        graph.vertices(c.users, c.stations, c.trips),
        c.edges,
    )
    ends = edges.select(F.col("rel").alias("label"), F.col("src").alias("id"), "dst")
    return graph.vertex_list(labelled).unionByName(ends, allowMissingColumns=True)


def _credit_part(c: Context) -> Mobility:
    """The trips of users in credit, with these users and the stations where the trips start."""
    credit = given.table(c.spark, c.folder, "customer").filter("c_acctbal >= 0")
    users = c.users.join(credit.select(F.col("c_custkey").alias("user_id")), "user_id", "left_semi")
    trips = c.trips.join(users.select("user_id"), "user_id", "left_semi")
    stations = c.stations.join(trips.select(F.col("start_station_id").alias("station_id")), "station_id", "left_semi")
    return Mobility(users, stations, trips, c.events)


def _merge_stored(c: Context) -> DataFrame:
    """As ``_merge_upsert``, into folders; merging all once more adds nothing. The trips are worked out once, for all merges."""
    c.data = c.data._replace(trips=in_session(c.spark, c.trips, "trips"))
    folder, part = scratch_path(c.spark, "graph"), _credit_part(c)
    part = part._replace(trips=in_session(c.spark, part.trips, "part-trips"))
    first = graph.vertices(part.users, part.stations, part.trips)
    graph_store.merge_stored(c.spark, folder, first, graph.trip_edges(graph.linked_trips(part.trips, part.users, part.stations)))
    every = graph.vertices(c.users, c.stations, c.trips)
    for _ in range(2):
        added = graph_store.merge_stored(c.spark, folder, every, c.edges)
    if any(added.values()):
        raise RuntimeError(f"the second merge added {added}")
    labelled = {label: graph_store.read_rows(c.spark, f"{folder}/{label}", df.schema) for label, df in every.items()}
    edges = graph_store.read_rows(c.spark, f"{folder}/{graph_store.EDGES}", c.edges.schema)
    ends = edges.select(F.col("rel").alias("label"), F.col("src").alias("id"), "dst")
    return graph.vertex_list(labelled).unionByName(ends, allowMissingColumns=True)


def _keyed(c: Context, name: str) -> keyed.KeyedTable:
    return keyed.write_keyed(getattr(c, name), "user_id", scratch_path(c.spark, f"keyed-{name}"))


def _update_where(c: Context) -> DataFrame:
    """The events, by month, with the levels filled in place."""
    folder = scratch_path(c.spark, "monthly")
    events = changes.with_month(c.leveled_events, "timestamp", "month")
    changes.write_parts(events, folder, "month")
    evolution.update_stored(c.spark, folder, events.schema, "month")
    return changes.read_parts(c.spark, folder, events.schema).drop("month")


def _add_column_versions(c: Context) -> DataFrame:
    """Events of even trips from files without the column, those of odd ones from files with it, in one folder."""
    folder, even = scratch_path(c.spark, "versions"), F.col("trip_id") % 2 == 0
    changes.append_version(c.events.filter(even), folder)
    changes.add_stored_column(c.spark, folder, evolution.FIELD, INT)
    changes.append_version(c.leveled_events.filter(~even), folder)
    return changes.read_versions(c.spark, folder)


def _write_checked(c: Context) -> DataFrame:
    """The rows of the four tables that were written under their rules and read back, and what the rules say about events whose
    levels are three times too high, which are refused."""
    folder = scratch_path(c.spark, "checked")
    checked.write_all_checked(c.data, folder, GIVEN_TABLES)
    counts = [
        checked.read_checked(c.spark, folder, name, GIVEN_TABLES).agg(F.count("*").alias("broken")).select(
            F.lit(name).alias("table_name"), F.lit("rows").alias("rule"), "broken"
        )
        for name in GIVEN_TABLES
    ]
    high = c.leveled_events.withColumn(evolution.FIELD, F.col(evolution.FIELD) * 30)
    rules = checked.rules_of("events", high.schema)
    try:
        checked.write_checked(high, rules, f"{folder}/events")
    except checked.RuleError:
        return reduce(DataFrame.unionByName, counts).unionByName(checked.rule_report(high, "high_levels", rules))
    raise RuntimeError("levels out of range were written")


def _semi_join_bitmap(c: Context) -> DataFrame:
    hits = c.events.filter(F.col("type") == relational.ERROR).select("trip_id").distinct()
    hits = checkpoint(hits)
    return bitmaps.semi_join(c.trips, hits, "trip_id", hits.count()).select("trip_id", "user_id")


def _variants(c: Context) -> DataFrame:
    """The events as VARIANT: levels where there are some, and a field for errors that no schema declares."""
    folder = scratch_path(c.spark, "variants")
    fault = F.when(F.col("type") == relational.ERROR, F.struct(F.col("value").alias("code"), F.lit(True).alias("open")))
    variant_docs.write_variants(variant_docs.event_texts(c.leveled_events, battery_level=F.col(evolution.FIELD), fault=fault), folder)
    return variant_docs.read_variants(c.spark, folder)


def _trips_from_city(c: Context) -> DataFrame:
    folder = scratch_path(c.spark, "by-station")
    layouts.write_by_station(c.trips, folder)
    return layouts.trips_from_city(c.spark, folder, c.trips.schema, c.stations, CITY).select("trip_id", "start_station_id", "station")


def _filter_param(c: Context) -> DataFrame:
    return c.spark.sql(
        "SELECT trip_id, start_station_id, end_station_id FROM {trips} WHERE user_id = :user_id",
        args={"user_id": USER_ID},
        trips=c.trips,
    )


def _default_missing(c: Context) -> DataFrame:
    level = F.col(evolution.FIELD).cast("string")
    return documents.unembed_events(evolution.add_battery_level_docs(c.docs)).select(
        "trip_id", "type", scalars.or_default(level, "MISSING").alias(evolution.FIELD)
    )


def _check_range(c: Context) -> DataFrame:
    tripled = F.when(F.col("type") == evolution.BATTERY, F.regexp_replace("value", "%", "").cast("int") * 3)
    return evolution.out_of_range(c.events.withColumn(evolution.FIELD, tripled)).select("event_id", evolution.FIELD)


def _count_filtered(c: Context) -> DataFrame:
    events = c.events.filter(F.col("type") == evolution.BATTERY).agg(F.count("*").alias("battery_events"))
    trips = documents.docs_with_event(c.docs, evolution.BATTERY, ("trip_id",)).agg(F.count("*").alias("n"))
    return events.withColumn("battery_trips", trips.scalar())


def _graph_sizes(c: Context) -> DataFrame:
    nodes, edges = c.graph
    return nodes.agg(F.count("*").alias("vertices")).withColumn("edges", edges.agg(F.count("*").alias("n")).scalar())


def _evolve_counts(c: Context) -> DataFrame:
    docs = evolution.evolve_counts_docs(c.docs)
    return evolution.evolve_counts(c.leveled_events).withColumns(
        {name: docs.select(name).scalar() for name in ("matched", "modified")}
    )


QUERIES: dict[str, Callable[[Context], DataFrame]] = {
    # flagship queries
    "q1_trip_details": lambda c: relational.trip_details(c.trips, c.users, c.stations),
    "q1_trip_details_doc": lambda c: documents.trip_details(c.heads, c.users, c.stations),
    "q2_user_stats": lambda c: relational.user_stats(c.users, c.trips),
    "q2_user_stats_doc": lambda c: documents.user_stats(c.heads, c.users),
    "q2_user_stats_null": lambda c: relational.user_stats_nullable(c.users, documents.parsed_times(documents.one_per_trip(c.heads))),
    "q3_station_counts": lambda c: relational.station_counts(c.stations, c.trips),
    "q3_station_counts_doc": lambda c: documents.station_counts(c.heads, c.stations),
    "q4_error_trips": lambda c: relational.error_trips(c.trips, c.users, c.events),
    "q4_error_trips_doc": lambda c: documents.error_trips(c.docs),
    "g1_reachable_stations": lambda c: graph.reachable_stations(c.trips, c.users, c.stations, USER_ID),
    "g2_top3_stations": lambda c: graph.top_stations(c.stations, c.trips, c.users),
    "pagerank_top3": lambda c: _rounded(graph_loops.pagerank_top(*c.graph)),
    "connected_components": lambda c: graph_loops.connected_components(*c.graph),
    "evolve_battery_level": lambda c: evolution.add_battery_level(c.leveled_events),
    "evolve_battery_level_doc": lambda c: _events_json(evolution.add_battery_level_docs(c.docs)),
    # scans, sources, sinks, layout
    "scan_project": lambda c: c.trips.select("trip_id", "user_id", "start_time", "end_time"),
    "scan_stations_edges": _scan_stations_edges,
    "write_tables": _write_tables,
    "write_docs": _write_docs,
    "embed_events": lambda c: _events_json(c.docs.select("trip_id", "user_id", "part", "events")),
    "unembed_events": lambda c: documents.unembed_events(c.docs),
    "graph_vertices": lambda c: graph.vertex_list(graph.vertices(c.users, c.stations, c.trips)),
    "graph_edges": lambda c: c.edges,
    "merge_upsert": _merge_upsert,
    "unique_key_check": lambda c: quality.key_report(c.data),
    "fk_check": lambda c: quality.orphans(c.data),
    "csv_sink": _csv_sink,
    "preview": lambda c: relational.preview(
        c.trips.select("trip_id", "user_id", "start_time", "end_time", "total_cost"), "trip_id"
    ),
    "partition_layout": _partition_layout,
    # projection, filter, predicate
    "rename_vertices": lambda c: c.graph[0],
    "filter_eq": lambda c: c.events.filter(F.col("type") == evolution.BATTERY).select(
        "event_id", "trip_id", "type", "value"
    ),
    "filter_null_and": lambda c: evolution.missing_level(c.leveled_events).select("event_id", "trip_id", "value"),
    "array_any_eq": lambda c: documents.docs_with_event(c.docs, evolution.BATTERY, ("trip_id",)),
    "filter_param": _filter_param,
    "default_missing": _default_missing,
    "check_range": _check_range,
    # joins
    "join_inner_users": lambda c: c.trips.join(c.users, "user_id").select("trip_id", "name", "surname", "country"),
    "join_two_roles": lambda c: relational.join_two_roles(c.trips, c.stations).select(
        "trip_id", "start_station", "end_station"
    ),
    "join_left_agg": lambda c: relational.trips_per_station(c.stations, c.trips),
    "semi_exists": lambda c: relational.trips_with_event(c.trips, c.events, relational.ERROR).select(
        "trip_id", "user_id"
    ),
    "lookup": lambda c: documents.lookup(
        documents.one_per_trip(c.heads).select("trip_id", "user_id"), c.users.select("user_id", "name", "surname"), "user_id", "user_id", "user"
    ).withColumn("user", F.to_json("user")),
    "unwind_inner": lambda c: _unwound(c, keep_empty=False),
    "unwind_outer": lambda c: _unwound(c, keep_empty=True),
    "full_outer_counts": lambda c: relational.merge_counts(c.trips),
    "path_two_hop": lambda c: graph.two_hop_paths(c.trips, c.users, c.stations),
    "optional_match": lambda c: graph.optional_match(c.stations, c.trips, c.users),
    "edges_valid": lambda c: graph.with_known_ends(c.graph[1], c.graph[0]).select("src", "dst"),
    # aggregation
    "count_distinct": lambda c: relational.distinct_ends(c.trips),
    "group_count": lambda c: c.trips.groupBy("start_station_id").agg(F.count("*").alias("n")),
    "group_agg_df": lambda c: relational.trip_stats(c.trips),
    "count_filtered": _count_filtered,
    "graph_sizes": _graph_sizes,
    "max_coalesce": lambda c: relational.max_ids(
        {
            "users": (c.users, "user_id"),
            "stations": (c.stations, "station_id"),
            "trips": (c.trips, "trip_id"),
            "events": (c.events, "event_id"),
        }
    ),
    "components_count": lambda c: graph_loops.component_count(*c.graph),
    # sort, limit, distinct, set operations
    "topk": lambda c: relational.top_users(c.users, c.trips, 3),
    "distinct_rows": lambda c: c.trips.select("start_station_id", "end_station_id").distinct(),
    "union_keys": lambda c: relational.visited_station_ids(c.trips),
    "union_all_edges": lambda c: graph.station_edges(c.edges),
    # scalar functions
    "duration_minutes": lambda c: c.trips.select(
        "trip_id", scalars.duration_minutes("start_time", "end_time").alias("minutes")
    ),
    "parse_ts": lambda c: documents.parsed_times(documents.one_per_trip(c.heads)).select("trip_id", "start_time", "end_time"),
    "format_ts": lambda c: documents.one_per_trip(c.heads).select("trip_id", "start_time", "end_time"),
    "ts_add": lambda c: c.trips.select(
        "trip_id",
        scalars.add_time(
            F.col("start_time"), days=F.col("trip_id") % 365, hours=6, minutes=F.col("user_id") % 60, seconds=1
        ).alias("later"),
    ),
    "cost_round": lambda c: c.trips.select(
        "trip_id",
        scalars.trip_cost(scalars.duration_minutes("start_time", "end_time"), F.col("total_cost") / 1000000).alias("cost"),
    ),
    "greatest_one": lambda c: c.trips.select(
        "trip_id", scalars.at_least_one(scalars.duration_seconds("start_time", "end_time")).alias("seconds")
    ),
    "concat_name": lambda c: c.stations.select("station_id", scalars.full_name("city", "name").alias("full_name")),
    "pick_value": lambda c: c.events.select(
        "event_id", "type", generate.pick_value(F.col("type"), F.col("trip_id")).alias("picked")
    ),
    # schema evolution
    "add_column": lambda c: evolution.add_column(evolution.add_column(c.events)).select(
        "event_id", "trip_id", "type", evolution.FIELD
    ),
    "evolve_counts": _evolve_counts,
    "evolve_sample": lambda c: evolution.evolve_sample(c.leveled_events),
    "evolve_sample_doc": lambda c: evolution.evolve_sample_docs(c.docs),
    # graph
    "station_graph": lambda c: c.graph[1],
    "station_degrees": lambda c: graph.degrees(*c.graph),
    "pagerank": lambda c: _rounded(graph_loops.pagerank(*c.graph)),
    # stored tables: access by key, changes in place, rules, layouts, varying fields
    "key_lookup": lambda c: _keyed(c, "trips").rows_of(USER_ID).select("trip_id", "start_station_id", "end_station_id"),
    "g1_reachable_stored": lambda c: graph.reachable_stations_stored(_keyed(c, "trips"), _keyed(c, "users"), c.stations, USER_ID),
    "update_where": _update_where,
    "add_column_versions": _add_column_versions,
    "merge_stored": _merge_stored,
    "write_checked": _write_checked,
    "count_distinct_bitmaps": lambda c: bitmaps.distinct_counts(
        c.trips, "start_station_id", {"user_id": "users", "end_station_id": "destinations"}
    ),
    "semi_join_bitmap": _semi_join_bitmap,
    "variant_docs": lambda c: variant_docs.fields_of(
        _variants(c), type="string", value="string", battery_level="int", fault="struct<code: string, open: boolean>"
    ).select("trip_id", "type", "value", evolution.FIELD, F.col("fault.code").alias("code"), F.col("fault.open").alias("open")),
    "variant_fields": lambda c: variant_docs.field_names(_variants(c)),
    "trips_from_city": _trips_from_city,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def runner(query: Callable[[Context], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: query(Context(spark, folder))

    return {name: runner(query) for name, query in QUERIES.items()}
