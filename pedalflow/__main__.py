"""Run the jobs on a folder that all executors can reach.

  python -m pedalflow setup FOLDER [USERS TRIPS EVENTS_PER_TRIP]   generate and load both forms (1000 10000 2)
  python -m pedalflow queries FOLDER [USER_ID]                     Q1 to Q4 on both forms, the two graph walks
  python -m pedalflow spark FOLDER                                 trips and mean duration of every user
  python -m pedalflow graph FOLDER                                 PageRank and connected components
  python -m pedalflow evolve FOLDER                                add battery_level to both forms
  python -m pedalflow benchmark FOLDER [--quick]                   the size sweep, as CSV

Start it with spark-submit on a cluster; without a master it runs on the local cores.
"""

from __future__ import annotations

import sys
import time

from pyspark.sql import DataFrame, SparkSession

from pedalflow.operators import documents, evolution, graph, graph_loops, relational
from pedalflow.plans import timing
from pedalflow.schemas import Mobility
from pedalflow.session import get_spark
from pedalflow.sources import generate, storage

DEFAULT_SIZES = (1000, 10000, 2)
SHOWN = 5


def _load(spark: SparkSession, folder: str) -> tuple[Mobility, DataFrame]:
    return storage.read_tables(spark, f"{folder}/tables"), storage.read_docs(spark, f"{folder}/docs")


def _report(name: str, df: DataFrame) -> None:
    print(f"{name}: computed in {timing.run_to_end(df):.3f}s")
    df.show(SHOWN, truncate=False)


def setup(spark: SparkSession, folder: str, *sizes: str) -> None:
    data = generate.generate_dataset(spark, *(map(int, sizes) if sizes else DEFAULT_SIZES))
    timing.stage(spark, data, folder)


def queries(spark: SparkSession, folder: str, user_id: str = "1") -> None:
    data, docs = _load(spark, folder)
    for form, jobs in (
        ("relational", timing.relational_queries(data)),
        ("document", timing.document_queries(docs, data)),
    ):
        for name, job in jobs.items():
            _report(f"{form} {name}", job())
    _report("reachable stations", graph.reachable_stations(data.trips, data.users, data.stations, int(user_id)))
    _report("top stations", graph.top_stations(data.stations, data.trips, data.users))


def spark_stats(spark: SparkSession, folder: str) -> None:
    data, docs = _load(spark, folder)
    _report("user stats", relational.user_stats_nullable(data.users, documents.parsed_times(documents.one_per_trip(docs))))


def graph_jobs(spark: SparkSession, folder: str) -> None:
    data, _ = _load(spark, folder)
    nodes, edges = graph.station_graph(data.stations, data.trips)
    for name, job in (("pagerank", graph_loops.pagerank_top), ("components", graph_loops.connected_components)):
        begun = time.perf_counter()
        result = job(nodes, edges)
        print(f"{name}: rounds took {time.perf_counter() - begun:.3f}s")
        _report(name, result)


def evolve(spark: SparkSession, folder: str) -> None:
    """The evolved events and documents go to new folders; a reader moves to them when they are complete."""
    data, docs = _load(spark, folder)
    evolution.evolve_counts(data.events).show()
    evolution.evolve_counts_docs(docs).show()
    evolution.add_battery_level(data.events).write.mode("overwrite").parquet(f"{folder}/evolved/events")
    storage.write_docs(evolution.add_battery_level_docs(docs), f"{folder}/evolved/docs")
    evolution.evolve_sample(data.events).show(truncate=False)
    evolution.evolve_sample_docs(docs).show(truncate=False)


def benchmark(spark: SparkSession, folder: str, *options: str) -> None:
    sizes = timing.QUICK if "--quick" in options else timing.all_sizes()
    table = timing.sweep(spark, sizes, f"{folder}/benchmark")
    table.show(len(sizes), truncate=False)
    timing.winners(table).orderBy(*timing.SIZES, "query").show(len(sizes) * len(timing.QUERIES), truncate=False)


COMMANDS = {
    "setup": setup,
    "queries": queries,
    "spark": spark_stats,
    "graph": graph_jobs,
    "evolve": evolve,
    "benchmark": benchmark,
}


def main(arguments: list[str]) -> int:
    if len(arguments) < 2 or arguments[0] not in COMMANDS:
        print(__doc__)
        return 1
    spark = get_spark()
    spark.sparkContext.setLogLevel("ERROR")
    COMMANDS[arguments[0]](spark, *arguments[1:])
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
