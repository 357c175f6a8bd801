"""Headline queries on stored tables, timed; prints one JSON line.

The tables of $BENCH_SF_DIR are loaded once into both forms (``load_sec``, not part of the
total), then all queries are run to the end several times over: two rounds to warm up, then the
median of three.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pedalflow.operators import evolution, graph, graph_loops  # noqa: E402
from pedalflow.plans import timing  # noqa: E402
from pedalflow.session import get_spark, scratch_path  # noqa: E402
from pedalflow.sources import given, keyed  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
WARM_UPS, RUNS = 2, int(os.environ.get("BENCH_RUNS", "3"))


def main() -> None:
    spark = get_spark("pedalflow-bench", f"local[{CPUS}]", spark__sql__shuffle__partitions=CPUS)
    spark.sparkContext.setLogLevel("ERROR")
    begun = time.perf_counter()
    data, docs = timing.stage(spark, given.load(spark, FOLDER), scratch_path(spark, "bench"))
    by_user = {name: keyed.write_keyed(getattr(data, name), "user_id", scratch_path(spark, name)) for name in ("trips", "users")}
    load_sec = time.perf_counter() - begun

    nodes, edges = graph.station_graph(data.stations, data.trips)
    jobs = {f"relational_{q}": job for q, job in timing.relational_queries(data).items()}
    jobs |= {f"document_{q}": job for q, job in timing.document_queries(docs, data).items()}
    jobs |= {
        "graph_reachable": lambda: graph.reachable_stations(data.trips, data.users, data.stations),
        "graph_reachable_stored": lambda: graph.reachable_stations_stored(by_user["trips"], by_user["users"], data.stations),
        "graph_top3": lambda: graph.top_stations(data.stations, data.trips, data.users),
        "pagerank": lambda: graph_loops.pagerank_top(nodes, edges),
        "components": lambda: graph_loops.connected_components(nodes, edges),
        "evolve_relational": lambda: evolution.add_battery_level(data.events),
        "evolve_document": lambda: evolution.add_battery_level_docs(docs),
    }
    times = {name: [] for name in jobs}
    for _ in range(WARM_UPS + RUNS):
        for name, job in jobs.items():
            begun = time.perf_counter()
            timing.run_to_end(job())  # a graph loop runs while it is built, so building is timed too
            times[name].append(time.perf_counter() - begun)
    seconds = {name: round(statistics.median(t[WARM_UPS:]), 4) for name, t in times.items()}
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": float(os.path.basename(FOLDER.rstrip("/")).removeprefix("sf") or 0),
                "load_sec": round(load_sec, 2),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
