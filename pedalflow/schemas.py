"""Declared schemas, keys and references of the four entities and their nested and graph forms."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import types as T


LONG, INT, TEXT, DOUBLE = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType()
DATE, TIME = T.DateType(), T.TimestampNTZType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


USERS = struct(user_id=LONG, name=TEXT, surname=TEXT, birthdate=DATE, country=TEXT)
STATIONS = struct(station_id=LONG, name=TEXT, city=TEXT, capacity=INT)
TRIPS = struct(
    trip_id=LONG, user_id=LONG, start_station_id=LONG, end_station_id=LONG, start_time=TIME, end_time=TIME, total_cost=DOUBLE
)
EVENTS = struct(event_id=LONG, trip_id=LONG, timestamp=TIME, type=TEXT, value=TEXT)
TABLES = {"users": USERS, "stations": STATIONS, "trips": TRIPS, "events": EVENTS}

# Events after the schema change.
EVOLVED_EVENTS = struct(**{f.name: f.dataType for f in EVENTS}, battery_level=INT)

# Documents keep times as text and carry their events.
ELEMENT = struct(timestamp=TEXT, type=TEXT, value=TEXT)
EVOLVED_ELEMENT = struct(timestamp=TEXT, type=TEXT, value=TEXT, battery_level=INT)


def trip_docs(element: T.StructType = ELEMENT) -> T.StructType:
    """Trip fields, the number of the document among those of its trip, how many these are, and a part of the trip's events."""
    fields = {f.name: TEXT if f.dataType == TIME else f.dataType for f in TRIPS}
    return struct(**fields, part=LONG, parts=LONG, events=T.ArrayType(element))


PRIMARY_KEYS = {"users": "user_id", "stations": "station_id", "trips": "trip_id", "events": "event_id"}

# (table, column) -> referenced table
FOREIGN_KEYS = {
    ("trips", "user_id"): "users",
    ("trips", "start_station_id"): "stations",
    ("trips", "end_station_id"): "stations",
    ("events", "trip_id"): "trips",
}


class Mobility(NamedTuple):
    """The relational form of the dataset."""

    users: DataFrame
    stations: DataFrame
    trips: DataFrame
    events: DataFrame
