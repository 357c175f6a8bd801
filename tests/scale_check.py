"""Q1 to Q4 and the graph loops on generated data in which one user, station and trip hold a third of the rows.

python tests/scale_check.py [trips ...]   joins are never broadcast, so they run as they would on large tables
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from pedalflow.operators import evolution, graph, graph_loops  # noqa: E402
from pedalflow.plans import timing  # noqa: E402
from pedalflow.schemas import Mobility  # noqa: E402
from pedalflow.session import get_spark, scratch_path  # noqa: E402
from pedalflow.sources import generate  # noqa: E402

EVENTS_PER_TRIP = 5


def skewed(spark, n_trips: int) -> Mobility:
    data = generate.generate_dataset(spark, n_trips // 20, n_trips, EVENTS_PER_TRIP, max(50, n_trips // 500))
    trip, event = F.col("trip_id"), F.col("event_id")
    trips = data.trips.withColumns(
        {
            "user_id": F.when(trip % 3 == 0, 5).otherwise(F.col("user_id")),
            "start_station_id": F.when(trip % 3 == 1, 7).otherwise(F.col("start_station_id")),
        }
    )
    events = data.events.withColumn("trip_id", F.when(event % 3 == 0, 11).otherwise(trip))
    return data._replace(trips=trips, events=events)


def main() -> None:
    spark = get_spark(
        "pedalflow-scale",
        "local[8]",
        spark__driver__memory="16g",
        spark__sql__shuffle__partitions="32",
        spark__sql__autoBroadcastJoinThreshold="-1",
    )
    spark.sparkContext.setLogLevel("ERROR")
    for n_trips in map(int, sys.argv[1:] or ["100000", "1000000"]):
        begun = time.perf_counter()
        data, docs = timing.stage(spark, skewed(spark, n_trips), scratch_path(spark, "scale"))
        print(f"{n_trips} trips, loaded in {time.perf_counter() - begun:.1f}s", flush=True)
        print(f"  continuation documents: {docs.filter("part > 0").count()}", flush=True)
        nodes, edges = graph.station_graph(data.stations, data.trips)
        jobs = {f"relational {q}": job for q, job in timing.relational_queries(data).items()}
        jobs |= {f"document {q}": job for q, job in timing.document_queries(docs, data).items()}
        jobs |= {
            "reachable": lambda: graph.reachable_stations(data.trips, data.users, data.stations, 5),
            "edges": lambda: graph.trip_edges(graph.linked_trips(data.trips, data.users, data.stations)),
            "pagerank": lambda: graph_loops.pagerank(nodes, edges),
            "components": lambda: graph_loops.connected_components(nodes, edges),
            "evolve": lambda: evolution.add_battery_level(data.events),
        }
        for name, job in jobs.items():
            begun = time.perf_counter()
            timing.run_to_end(job())
            print(f"  {name:16s} {time.perf_counter() - begun:7.2f}s", flush=True)


if __name__ == "__main__":
    main()
