"""The document form: trips that carry their events, and the analytics on it.

A document is one row: the fields of a trip, ``part``, ``parts`` and ``events``. A trip's events in time order are cut into
parts of ``PART_EVENTS``; a trip with more has several documents, numbered from 0, of which each knows how many there are, and a
trip without events one, whose array is empty. That rule is the whole form: it does not depend on how large the table or any
other trip is. Part 0 stands for the trip where its events do not matter; ``trip_heads`` makes these rows without the events.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pedalflow.functions.scalars import format_ts, or_default, parse_ts
from pedalflow.operators import relational
from pedalflow.operators.numbering import number_rows
from pedalflow.session import checkpoint

PART_EVENTS = 100_000  # about 10 MB of events
# Rows that ``lookup`` puts into one array at most.
MAX_MATCHES = 100_000

TRIP_FIELDS = (
    "trip_id", "user_id", "start_station_id", "end_station_id", "start_time", "end_time", "total_cost"
)


def embed_events(trips: DataFrame, events: DataFrame, part_events: int = PART_EVENTS) -> DataFrame:
    """The documents of all trips; events of unknown trips drop out.

    Where no trip has more than ``part_events`` events, they are shuffled once. Trips with more have their events numbered
    in a range partitioning, which no single task holds, and cut into parts by these numbers.
    """
    counts = events.groupBy("trip_id").agg(F.count("*").alias("_events"))
    large = checkpoint(counts.filter(F.col("trip_id").isNotNull() & (F.col("_events") > part_events)).select("trip_id"))
    element = F.struct(format_ts("timestamp").alias("timestamp"), "type", "value")
    embedded = F.sort_array(F.collect_list(element)).alias("events")
    fields = trip_heads(trips).drop("part")

    if large.isEmpty():
        return _documents(fields.join(events.groupBy("trip_id").agg(embedded), "trip_id", "left"))
    ordinary = events.join(large, "trip_id", "left_anti").groupBy("trip_id").agg(embedded)
    whole = _documents(fields.join(large, "trip_id", "left_anti").join(ordinary, "trip_id", "left"))
    order = F.struct("trip_id", format_ts("timestamp").alias("timestamp"), "type", "value", "event_id")
    numbered = number_rows(events.join(large, "trip_id").withColumn("_order", order), "_order", "_number").drop("_order")
    first = checkpoint(numbered.groupBy("trip_id").agg(F.min("_number").alias("_first")))
    part = F.floor((F.col("_number") - F.col("_first")) / part_events).alias("part")
    parts = checkpoint(numbered.join(first, "trip_id").groupBy("trip_id", part).agg(embedded))
    how_many = parts.groupBy("trip_id").agg(F.count("*").alias("parts"))
    return whole.unionByName(_documents(fields.join(parts.join(how_many, "trip_id"), "trip_id")))


def _documents(rows: DataFrame) -> DataFrame:
    part, parts = (F.col(c) if c in rows.columns else F.lit(n) for c, n in (("part", 0), ("parts", 1)))
    events = _or_empty(F.col("events"), rows, "events")
    return rows.select(*TRIP_FIELDS, part.cast("bigint").alias("part"), parts.cast("bigint").alias("parts"), events.alias("events"))


def trip_heads(trips: DataFrame) -> DataFrame:
    """The part 0 documents of all trips without their events: what queries read that do not ask for these. No event is read."""
    return trips.select(*[format_ts(c).alias(c) if c.endswith("_time") else F.col(c) for c in TRIP_FIELDS], F.lit(0).cast("bigint").alias("part"))


def _or_empty(array: Column, df: DataFrame, name: str) -> Column:
    return F.coalesce(array, F.array().cast(df.schema[name].dataType))


def one_per_trip(docs: DataFrame) -> DataFrame:
    """The trip fields, once per trip; the filter reaches the scan and the events are not read."""
    return docs.filter(F.col("part") == 0).select(*TRIP_FIELDS)


def unembed_events(docs: DataFrame) -> DataFrame:
    """One row per embedded event."""
    return docs.select("trip_id", F.inline("events"))


def has_event(event_type: str) -> Column:
    """True for a document with such an event; reads the ``type`` leaf of the array only."""
    return F.array_contains(F.col("events.type"), event_type)


def docs_with_event(docs: DataFrame, event_type: str, fields: tuple[str, ...] = TRIP_FIELDS) -> DataFrame:
    """These trip fields, ``trip_id`` among them, of trips with at least one event of the type, once per trip.

    Only trips of several documents can be found more than once; the others, nearly all, are not shuffled.
    """
    found = docs.filter(has_event(event_type))
    several = found.filter(F.col("parts") > 1).select(*fields).distinct()
    return found.filter(F.col("parts") == 1).select(*fields).unionByName(several)


def trip_details(docs: DataFrame, users: DataFrame, stations: DataFrame) -> DataFrame:
    """Every trip document with its user and station names; times stay text."""
    people = users.select("user_id", "name", "surname", "country")
    found = lookup_one(one_per_trip(docs), people, "user_id", "user_id", "user")
    names = stations.select("station_id", "name")
    for end in ("start", "end"):
        found = lookup_one(found, names, f"{end}_station_id", "station_id", f"{end}_st")
    return found.select(
        "trip_id",
        F.col("user.name").alias("user_name"),
        F.col("user.surname").alias("user_surname"),
        F.col("user.country").alias("user_country"),
        F.col("start_st.name").alias("start_station"),
        F.col("end_st.name").alias("end_station"),
        "start_time",
        "end_time",
        "total_cost",
    )


def parsed_times(docs: DataFrame) -> DataFrame:
    """Documents with their text times read as times."""
    return docs.withColumns({c: parse_ts(c) for c in ("start_time", "end_time")})


def user_stats(docs: DataFrame, users: DataFrame) -> DataFrame:
    """Users with trips, most trips first; an id without a user keeps its numbers and has no name."""
    stats = relational.trip_stats(parsed_times(one_per_trip(docs)))
    names = users.select("user_id", "name", "surname")
    return lookup_one(stats, names, "user_id", "user_id", "user", keep_missing=True).select(
        "user_id",
        F.col("user.name").alias("name"),
        F.col("user.surname").alias("surname"),
        "total_trips",
        "avg_duration_minutes",
    ).orderBy(F.desc("total_trips"), "user_id")


def station_counts(docs: DataFrame, stations: DataFrame) -> DataFrame:
    """Stations seen in a trip, busiest first; ids without a station are called 'unknown'."""
    return (
        relational.station_traffic(one_per_trip(docs))
        .join(stations, "station_id", "left")
        .select(
            "station_id",
            or_default("name", "unknown").alias("name"),
            or_default("city", "unknown").alias("city"),
            "trips_starting",
            "trips_ending",
        )
        .orderBy(F.desc(F.col("trips_starting") + F.col("trips_ending")), "station_id")
    )


def error_trips(docs: DataFrame) -> DataFrame:
    """Trips with an ERROR event, found without a join."""
    return docs_with_event(docs, relational.ERROR, ("trip_id", "user_id", "start_time", "end_time", "total_cost"))


def lookup(
    left: DataFrame, right: DataFrame, local: str, foreign: str, into: str, max_matches: int = MAX_MATCHES
) -> DataFrame:
    """Add ``into``: the array of all ``right`` rows whose ``foreign`` equals ``local``, empty if none.

    Null equals null. No array is built beyond ``max_matches`` rows: a key with more is an error, found by
    counting before anything is collected; ``lookup_one`` joins such a side row by row.
    """
    key = F.col(foreign).alias("_key")
    if not right.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") > max_matches).isEmpty():
        raise ValueError(f"a value of {foreign} has more than {max_matches} rows")
    matches = right.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*right.columns))).alias(into))
    joined = left.join(matches, F.col(local).eqNullSafe(F.col("_key")), "left")
    return joined.withColumn(into, _or_empty(F.col(into), joined, into)).drop("_key")


def lookup_one(
    left: DataFrame, right: DataFrame, local: str, foreign: str, into: str, keep_missing: bool = False
) -> DataFrame:
    """``lookup`` and ``unwind`` in one join: ``into`` is a matching row itself."""
    matches = right.select(F.col(foreign).alias("_key"), F.struct(*right.columns).alias(into))
    how = "left" if keep_missing else "inner"
    return left.join(matches, F.col(local) == F.col("_key"), how).drop("_key")


def unwind(df: DataFrame, array: str, keep_empty: bool = False) -> DataFrame:
    """One row per element; a row with an empty array is dropped, or kept with a null element."""
    exploded = F.explode_outer(array) if keep_empty else F.explode(array)
    return df.withColumn(array, exploded)


def unwind_events(
    docs: DataFrame, wanted: Callable[[Column], Column] | None = None, keep_empty: bool = False
) -> DataFrame:
    """The trip fields once per event, or per ``wanted`` event, in ``event``; a trip without one is dropped, or kept
    once with a null event."""
    events = F.col("events") if wanted is None else F.filter("events", wanted)
    rows = docs.select(*TRIP_FIELDS, "part", events.alias("event"))
    found = unwind(rows.drop("part"), "event")
    if not keep_empty:
        return found
    if wanted is None:  # only the one document of a trip without events is empty
        return unwind(rows.drop("part"), "event", keep_empty=True)
    with_one = rows.filter((F.size("event") > 0) & (F.col("part") > 0)).select("trip_id").distinct()
    none = rows.filter((F.col("part") == 0) & (F.size("event") == 0)).drop("part")
    return found.unionByName(unwind(none.join(with_one, "trip_id", "left_anti"), "event", keep_empty=True))
