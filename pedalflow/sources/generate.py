"""Synthetic users, stations, trips and events of any size, made in parallel.

Every value is a function of the row number, so the same call gives the same rows on any
number of executors and a lost task is simply run again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pedalflow.functions.scalars import add_time, at_least_one, duration_seconds, full_name
from pedalflow.schemas import EVENTS, STATIONS, TRIPS, USERS, Mobility
from pedalflow.sources.storage import conform

# --- fixed values: the value domains of the data ---
NAMES = [
    "Luca", "Marco", "Andrea", "Giuseppe", "Antonio", "Francesco", "Matteo",
    "Davide", "Lorenzo", "Simone", "Sara", "Giulia", "Martina", "Chiara",
    "Valentina", "Federica", "Alessia", "Elena", "Maria", "Laura",
    "Rahim", "Karim", "Ameet", "Sofia", "Emma", "Fatima", "Yusuf",
]
SURNAMES = [
    "Rossi", "Ferrari", "Esposito", "Bianchi", "Romano", "Colombo", "Ricci",
    "Marino", "Greco", "Bruno", "Gallo", "Conti", "De Luca", "Costa", "Mancini",
    "Das", "Khan", "Ali", "Hasan", "Schmidt", "Dupont", "Garcia", "Nguyen",
]
COUNTRIES = [
    "Italy", "Germany", "France", "Spain", "Poland", "Romania", "Portugal",
    "Greece", "Netherlands", "Belgium", "Bangladesh", "India", "Morocco", "Vietnam",
]
CITIES = [
    "Milan", "Rome", "Naples", "Turin", "Palermo", "Genoa", "Bologna",
    "Florence", "Bari", "Catania", "Venice", "Verona", "Messina", "Padua", "Trieste",
]
STATION_SUFFIXES = [
    "Centrale", "Nord", "Sud", "Est", "Ovest", "Piazza",
    "Universita", "Aeroporto", "Porto", "Stadio", "Parco", "Duomo",
]
EVENT_VALUES = {
    "GPS": ["45.4654,9.1859", "41.9028,12.4964", "43.7696,11.2558",
            "40.8518,14.2681", "45.0703,7.6869", "44.4949,11.3426"],
    "ERROR": ["Low battery warning", "GPS signal lost", "Network timeout",
              "Sensor failure", "Communication error", "Brake fault detected"],
    "BATTERY": ["85%", "60%", "45%", "30%", "20%", "10%", "95%", "75%"],
    "DELAY": ["2 min delay", "5 min delay", "10 min delay",
              "Traffic congestion", "Road works", "Weather conditions"],
}
EVENT_TYPES = ["GPS", "ERROR", "BATTERY", "DELAY"]
FIRST_BIRTHDATE, BIRTH_DAYS = "1960-01-01", 14600
FIRST_DAY, DAYS = "2024-01-01", 364
FIRST_HOUR, LAST_HOUR = 6, 22
MIN_MINUTES, MAX_MINUTES = 5, 120
MIN_CAPACITY, MAX_CAPACITY = 10, 50
N_STATIONS = 50
# --- end of fixed values ---

# Parameters of the number stream: a prime modulus keeps every product within a BIGINT.
MODULUS = 2147483647
STREAM_STEP, BLOCK_STEP = 104729, 7919
LINEAR, OFFSET = 48271, 12345


def draw(row: Column, stream: int, n: Column | int) -> Column:
    """A whole number in 0..n-1 for a row number; streams are independent of one another."""
    p = F.lit(MODULUS)
    x = (row % p + F.shiftright(row, 31) * F.lit(BLOCK_STEP) + F.lit(stream * STREAM_STEP)) % p
    for _ in range(2):
        x = (x * x % p + x * F.lit(LINEAR) + F.lit(OFFSET)) % p
    return x % (F.lit(n) if isinstance(n, int) else n)


def pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def pick_value(event_type: Column, number: Column) -> Column:
    """A value from the list of the event's type."""
    value = F.lit(None).cast("string")
    for name, values in EVENT_VALUES.items():
        value = F.when(event_type == name, pick(values, number % len(values))).otherwise(value)
    return value


def _rows(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(1, n + 1).withColumnRenamed("id", "i")


def generate_users(spark: SparkSession, n_users: int) -> DataFrame:
    i = F.col("i")
    born = F.date_add(F.lit(FIRST_BIRTHDATE).cast("date"), draw(i, 1, BIRTH_DAYS + 1).cast("int"))
    return conform(
        _rows(spark, n_users).select(
            i.alias("user_id"),
            pick(NAMES, draw(i, 2, len(NAMES))).alias("name"),
            pick(SURNAMES, draw(i, 3, len(SURNAMES))).alias("surname"),
            born.alias("birthdate"),
            pick(COUNTRIES, draw(i, 4, len(COUNTRIES))).alias("country"),
        ),
        USERS,
    )


def generate_stations(spark: SparkSession, n_stations: int = N_STATIONS) -> DataFrame:
    """Stations with different names: a step through all city-suffix pairs that meets each once.

    From the second time round a name ends in a running number.
    """
    i, names = F.col("i"), len(CITIES) * len(STATION_SUFFIXES)
    place = (i * 77 + 13) % names  # 77 has no divisor in common with the number of names
    city = pick(CITIES, F.floor(place / len(STATION_SUFFIXES)))
    name = full_name(city, pick(STATION_SUFFIXES, place % len(STATION_SUFFIXES)))
    lap = F.floor((i - 1) / names)
    return conform(
        _rows(spark, n_stations).select(
            i.alias("station_id"),
            F.when(lap == 0, name).otherwise(F.concat_ws(" ", name, (lap + 1).cast("string"))).alias("name"),
            city.alias("city"),
            (draw(i, 5, MAX_CAPACITY - MIN_CAPACITY + 1) + MIN_CAPACITY).alias("capacity"),
        ),
        STATIONS,
    )


def generate_trips(spark: SparkSession, n_trips: int, n_users: int, n_stations: int) -> DataFrame:
    """Trips that end at another station than they start; cost is 1.00 + 0.15 a minute + up to 2.00."""
    if n_stations < 2:
        raise ValueError("a trip needs two stations")
    i = F.col("i")
    start = draw(i, 11, n_stations)
    end = (start + 1 + draw(i, 12, n_stations - 1)) % n_stations
    hours = draw(i, 14, LAST_HOUR - FIRST_HOUR + 1) + FIRST_HOUR
    begin = add_time(F.lit(FIRST_DAY).cast("timestamp_ntz"), draw(i, 13, DAYS + 1), hours, draw(i, 15, 60))
    minutes = draw(i, 16, MAX_MINUTES - MIN_MINUTES + 1) + MIN_MINUTES
    # In hundredths of a cent, rounded half up in whole numbers.
    cents = F.floor((F.lit(10000) + minutes * 1500 + draw(i, 17, 20001) + 50) / 100)
    return conform(
        _rows(spark, n_trips)
        .select(
            i.alias("trip_id"),
            (draw(i, 10, n_users) + 1).alias("user_id"),
            (start + 1).alias("start_station_id"),
            (end + 1).alias("end_station_id"),
            begin.alias("start_time"),
            minutes.alias("minutes"),
            (cents / 100).alias("total_cost"),
        )
        .withColumn("end_time", add_time(F.col("start_time"), minutes=F.col("minutes"))),
        TRIPS,
    )


def generate_events(trips: DataFrame, events_per_trip: int) -> DataFrame:
    """``events_per_trip`` events within each trip, at whole seconds; none gives an empty table."""
    i, k = F.col("event_id"), events_per_trip
    numbered = (
        trips.select("trip_id", "start_time", at_least_one(duration_seconds("start_time", "end_time")).alias("seconds"))
        .withColumn("j", F.explode(F.sequence(F.lit(1), F.lit(max(k, 1)))))
        .filter(F.col("j") <= k)
        .withColumn("event_id", (F.col("trip_id") - 1) * k + F.col("j"))
    )
    typed = numbered.withColumn("type", pick(EVENT_TYPES, draw(i, 21, len(EVENT_TYPES))))
    return conform(
        typed.select(
            "event_id",
            "trip_id",
            add_time(F.col("start_time"), seconds=draw(i, 20, F.col("seconds"))).alias("timestamp"),
            "type",
            pick_value(F.col("type"), draw(i, 22, MODULUS)).alias("value"),
        ),
        EVENTS,
    )


def generate_dataset(
    spark: SparkSession, n_users: int, n_trips: int, events_per_trip: int, n_stations: int = N_STATIONS
) -> Mobility:
    trips = generate_trips(spark, n_trips, n_users, n_stations)
    return Mobility(
        generate_users(spark, n_users),
        generate_stations(spark, n_stations),
        trips,
        generate_events(trips, events_per_trip),
    )
