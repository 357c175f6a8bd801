"""The size sweep: both forms loaded, Q1 to Q4 timed on each, one row per size."""

from __future__ import annotations

import itertools
import time
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pedalflow.operators import documents, relational
from pedalflow.schemas import Mobility
from pedalflow.session import scratch_path
from pedalflow.sources import generate, storage

# --- fixed values: the sizes of the sweep ---
USERS = [1_000, 10_000, 50_000]
TRIPS = [10_000, 50_000, 100_000]
EVENTS_PER_TRIP = [0, 2, 5, 10]
QUICK = [(1_000, 10_000, 2), (10_000, 50_000, 5), (50_000, 100_000, 10)]
# --- end of fixed values ---

SIZES = ("n_users", "n_trips", "events_per_trip")
FORMS = ("relational", "document")
QUERIES = ("Q1", "Q2", "Q3", "Q4")
BENCH_SCHEMA = T.StructType(
    [T.StructField(n, T.LongType()) for n in SIZES[:2]]
    + [T.StructField(SIZES[2], T.DoubleType())]
    + [T.StructField(f"{form}_{q}", T.DoubleType()) for form in FORMS for q in QUERIES]
)


def all_sizes() -> list[tuple[int, int, int]]:
    return list(itertools.product(USERS, TRIPS, EVENTS_PER_TRIP))


def relational_queries(data: Mobility) -> dict[str, Callable[[], DataFrame]]:
    return {
        "Q1": lambda: relational.trip_details(data.trips, data.users, data.stations),
        "Q2": lambda: relational.user_stats(data.users, data.trips),
        "Q3": lambda: relational.station_counts(data.stations, data.trips),
        "Q4": lambda: relational.error_trips(data.trips, data.users, data.events),
    }


def document_queries(docs: DataFrame, data: Mobility) -> dict[str, Callable[[], DataFrame]]:
    return {
        "Q1": lambda: documents.trip_details(docs, data.users, data.stations),
        "Q2": lambda: documents.user_stats(docs, data.users),
        "Q3": lambda: documents.station_counts(docs, data.stations),
        "Q4": lambda: documents.error_trips(docs),
    }


def run_to_end(df: DataFrame) -> float:
    """Seconds to compute every row and column of ``df``; nothing is kept."""
    begun = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begun


def stage(spark: SparkSession, data: Mobility, folder: str) -> tuple[Mobility, DataFrame]:
    """Load both forms, so that a query is timed on stored tables."""
    schemas = {name: df.schema for name, df in data._asdict().items()}
    storage.write_tables(data, f"{folder}/tables", schemas)
    stored = storage.read_tables(spark, f"{folder}/tables", schemas)
    storage.write_docs(documents.embed_events(stored.trips, stored.events), f"{folder}/docs")
    return stored, storage.read_docs(spark, f"{folder}/docs")


def bench_row(spark: SparkSession, data: Mobility) -> tuple:
    """Sizes and seconds for one dataset."""
    stored, docs = stage(spark, data, scratch_path(spark, "bench"))
    users, trips, events = (df.count() for df in (stored.users, stored.trips, stored.events))
    runs = [relational_queries(stored), document_queries(docs, stored)]
    seconds = [round(run_to_end(run[q]()), 4) for run in runs for q in QUERIES]
    return (users, trips, events / max(trips, 1), *seconds)


def bench_table(spark: SparkSession, *datasets: Mobility) -> DataFrame:
    """One row of sizes and seconds per dataset."""
    return spark.createDataFrame([bench_row(spark, data) for data in datasets], BENCH_SCHEMA)


def sweep(spark: SparkSession, sizes: Iterable[tuple[int, int, int]], csv_folder: str) -> DataFrame:
    """Generate, load and time every size, and keep the table as CSV."""
    table = bench_table(spark, *(generate.generate_dataset(spark, *size) for size in sizes))
    storage.write_csv(table, csv_folder)
    return storage.read_csv(spark, csv_folder, BENCH_SCHEMA)


def winners(table: DataFrame, sizes: tuple[str, ...] = SIZES) -> DataFrame:
    """Per size and query the fastest system and how many times faster it is than the slowest.

    Every column that is not a size is named ``<system>_<query>`` and holds seconds.
    """
    timings = [c for c in table.columns if c not in sizes]
    named = table.unpivot(list(sizes), timings, "timing", "seconds").select(
        *sizes,
        F.substring_index("timing", "_", 1).alias("system"),
        F.substring_index("timing", "_", -1).alias("query"),
        "seconds",
    )
    return named.groupBy(*sizes, "query").agg(
        F.min_by("system", "seconds").alias("winner"),
        F.min("seconds").alias("seconds"),
        (F.max("seconds") / F.min("seconds")).alias("speedup"),
    )
