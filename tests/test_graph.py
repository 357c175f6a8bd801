from __future__ import annotations

import random

import pytest

from helpers import planned, rows
from pedalflow.operators import documents, graph, graph_loops, quality, relational
from pedalflow.operators.numbering import number_rows
from pedalflow.schemas import Mobility


def test_edges_need_user_and_both_stations(city):
    edges = graph.trip_edges(graph.linked_trips(city.trips, city.users, city.stations))
    assert sorted(rows(edges)) == sorted(
        [(1, 100, "PERFORMED"), (1, 101, "PERFORMED"), (2, 102, "PERFORMED")]
        + [(100, 10, "STARTS_AT"), (101, 20, "STARTS_AT"), (102, 10, "STARTS_AT")]
        + [(100, 20, "ENDS_AT"), (101, 10, "ENDS_AT"), (102, 10, "ENDS_AT")]
    )
    assert graph.station_edges(edges).count() == 6
    assert sorted(rows(graph.two_hop_paths(city.trips, city.users, city.stations).select("user_id", "station_id"))) == [
        (1, 10), (1, 20), (2, 10)
    ]


def test_vertices(city):
    labelled = graph.vertices(city.users, city.stations, city.trips)
    assert {label: df.count() for label, df in labelled.items()} == {"User": 3, "Station": 4, "Trip": 7}
    listed = {(v.label, v.id): v for v in graph.vertex_list(labelled).collect()}
    far, trip = listed["Station", 40], listed["Trip", 100]
    assert (far.name, far.city, far.surname, far.total_cost) == ("Far", "Turin", None, None)
    assert (trip.start_time, trip.total_cost, trip.name) == ("2024-03-10 01:00:00", 3.5, None)


def test_merge_upsert_adds_each_new_row_once(spark, city):
    loaded = graph.vertices(city.users, city.stations, city.trips)["User"]
    assert sorted(rows(graph.merge_upsert(loaded, loaded))) == sorted(rows(loaded))
    more = spark.createDataFrame([(4, "Di", None, "Peru")] * 2 + [(1, "Ann", "A", "France")], loaded.schema)
    merged = graph.merge_upsert(loaded, more)
    assert merged.count() == 5
    assert sorted(rows(graph.merge_upsert(merged, more)), key=str) == sorted(rows(merged), key=str)
    assert rows(quality.duplicate_keys(merged, "user_id")) == [(1, 2)]


def test_merging_the_graph_adds_all_labels_and_relationships_once(city):
    first = city._replace(trips=city.trips.filter("trip_id = 100"), stations=city.stations.filter("station_id < 30"))
    parts = [
        (graph.vertices(m.users, m.stations, m.trips), graph.trip_edges(graph.linked_trips(m.trips, m.users, m.stations)))
        for m in (first, city)
    ]
    (old, old_edges), (new, new_edges) = parts
    labelled, edges = graph.merge_graph(old, old_edges, new, new_edges)
    for label, df in new.items():
        assert sorted(rows(labelled[label]), key=str) == sorted(rows(df), key=str)
    assert sorted(rows(edges)) == sorted(rows(new_edges)) and old_edges.count() == 3
    again, same_edges = graph.merge_graph(labelled, edges, new, new_edges)
    assert same_edges.count() == edges.count() and again["Trip"].count() == 7


def test_reachable_stations(city):
    got = rows(graph.reachable_stations(city.trips, city.users, city.stations, 1))
    assert got == [(10, "North", "Rome"), (20, "South", "Rome")]
    assert rows(graph.reachable_stations(city.trips, city.users, city.stations, 9)) == []


def test_top_stations_count_the_trips_that_have_edges(city):
    """Of the raw trips only three have a known user and two known stations."""
    assert rows(graph.top_stations(city.stations, city.trips, city.users, 2)) == [
        (10, "North", "Rome", 2, 2, 4),
        (20, "South", "Rome", 1, 1, 2),
    ]
    matched = {t[0]: t[3:] for t in rows(graph.optional_match(city.stations, city.trips, city.users))}
    assert matched == {10: (2, 2), 20: (1, 1), 30: (0, 0), 40: (0, 0)}
    whole = city.trips.filter("user_id = 1")
    top = [(t[0], t[5]) for t in rows(graph.top_stations(city.stations, whole, city.users))]
    counts = [(t[0], t[3] + t[4]) for t in rows(relational.station_counts(city.stations, whole))]
    assert top == counts[:3]


def test_degrees_and_known_ends(city):
    nodes, edges = graph.station_graph(city.stations, city.trips)
    assert edges.count() == 7
    known = graph.with_known_ends(edges, nodes)
    assert sorted(rows(known)) == [(10, 10), (10, 20), (20, 10), (20, 30), (30, 20)]
    # An isolated station has degree 0; null and unknown ends are no vertices.
    assert sorted(rows(graph.degrees(nodes, edges))) == [(10, 2, 2, 4), (20, 3, 2, 5), (30, 2, 1, 3), (40, 0, 0, 0)]


def test_walks_join_each_end_once(spark, conf, city, tmp_path):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    stored = city._replace(**{n: _stored(spark, getattr(city, n), tmp_path / n) for n in ("trips", "users", "stations")})
    for walk in (
        graph.two_hop_paths(stored.trips, stored.users, stored.stations),
        graph.reachable_stations(stored.trips, stored.users, stored.stations),
    ):
        plan = planned(walk)
        assert plan.count("Join") == 3 and plan.count("FileScan") == 4, plan


def _stored(spark, df, path):
    df.write.parquet(str(path))
    return spark.read.schema(df.schema).parquet(str(path))


def test_key_and_reference_reports(city):
    keys = {t[0]: t[1:] for t in rows(quality.key_report(city))}
    assert keys["trips"] == (7, 7, 0, 0)
    doubled = city._replace(users=city.users.unionByName(city.users.filter("user_id = 1")))
    assert rows(quality.key_report(doubled))[0] == ("users", 4, 3, 1, 0)
    assert dict(rows(quality.orphans(city))) == {
        "trips.user_id": 1,
        "trips.start_station_id": 1,
        "trips.end_station_id": 0,
        "events.trip_id": 1,
    }


def make_graph(spark, n: int, edges: list[tuple[int, int]]):
    nodes = spark.createDataFrame([(i, f"s{i}", "c") for i in range(n)], "id long, name string, city string")
    return nodes, spark.createDataFrame(edges, "src long, dst long")


def ranks_by_hand(n, edges, reset=0.15, rounds=10):
    out = [0] * n
    for s, _ in edges:
        out[s] += 1
    rank = [1.0] * n
    for _ in range(rounds):
        new = [reset] * n
        for s, t in edges:
            new[t] += (1 - reset) * rank[s] / out[s]
        rank = new
    scale = n / sum(rank)
    return [r * scale for r in rank]


def components_by_hand(n, edges):
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for s, t in edges:
            low = min(label[s], label[t])
            changed |= label[s] != low or label[t] != low
            label[s] = label[t] = low
    order = {root: i for i, root in enumerate(sorted(set(label)))}
    return [order[root] for root in label]


# A loop, parallel edges, a source, a sink and vertices without edges.
SMALL = (8, [(0, 0), (0, 1), (0, 1), (1, 2), (2, 0), (3, 2), (1, 4), (6, 7)])


def random_graph(seed: int, n: int, m: int, hub: bool):
    rng = random.Random(seed)
    return n, [(0 if hub and rng.random() < 0.34 else rng.randrange(n), rng.randrange(n)) for _ in range(m)]


@pytest.mark.parametrize("target_rows", [1_000_000, 5])
@pytest.mark.parametrize("case", [SMALL, random_graph(1, 40, 300, hub=True)], ids=["small", "hub"])
def test_pagerank(spark, case, target_rows):
    nodes, edges = make_graph(spark, *case)
    got = {r.id: r.pagerank for r in graph_loops.pagerank(nodes, edges, target_rows=target_rows).collect()}
    expected = ranks_by_hand(*case)
    assert got == pytest.approx(dict(enumerate(expected)), abs=1e-12)
    assert sum(got.values()) == pytest.approx(case[0])


def test_pagerank_parameters_and_edges_to_nowhere(spark):
    n, edges = SMALL
    nodes, more = make_graph(spark, n, [*edges, (0, 99), (None, 1)])
    got = {r.id: r.pagerank for r in graph_loops.pagerank(nodes, more, reset=0.3, iterations=3).collect()}
    assert got == pytest.approx(dict(enumerate(ranks_by_hand(n, edges, 0.3, 3))), abs=1e-12)
    top = rows(graph_loops.pagerank_top(nodes, more.filter("dst < 99"), 2))
    best = sorted(enumerate(ranks_by_hand(n, edges)), key=lambda t: (-t[1], t[0]))[:2]
    assert [t[0] for t in top] == [i for i, _ in best]


CHAIN = (60, [(i + 1, i) if i % 3 else (i, i + 1) for i in range(59)])


@pytest.mark.parametrize("target_rows", [1_000_000, 3])
@pytest.mark.parametrize(
    "case",
    [SMALL, CHAIN, random_graph(2, 60, 45, hub=False), random_graph(3, 60, 40, hub=True), (3, [(1, 1)])],
    ids=["small", "chain", "sparse", "hub", "isolated"],
)
def test_connected_components(spark, case, target_rows):
    nodes, edges = make_graph(spark, *case)
    got = graph_loops.connected_components(nodes, edges, target_rows=target_rows).collect()
    expected = components_by_hand(*case)
    assert {r.id: r.component for r in got} == dict(enumerate(expected))
    assert [(r.component, r.id) for r in got] == sorted((c, i) for i, c in enumerate(expected))
    assert rows(graph_loops.component_count(nodes, edges)) == [(case[0], len(set(expected)))]


def test_rounds_move_only_vertex_sized_tables(spark, conf, monkeypatch):
    """Links and ranks keep their place: a round shuffles the partial sums, and the ranks if some are salted."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    monkeypatch.setattr(graph_loops, "MANY_LINKS", 1)
    plans, pass_ranks = [], graph_loops._pass_ranks

    def watched(*args):
        ranks = pass_ranks(*args)
        plans.append(planned(ranks))
        return ranks

    monkeypatch.setattr(graph_loops, "_pass_ranks", watched)
    hub = make_graph(spark, *random_graph(4, 30, 200, hub=True))
    for target_rows, exchanges in ((1_000_000, 1), (10, 2)):
        graph_loops.pagerank(*hub, iterations=1, target_rows=target_rows)
        assert plans[-1].count("Exchange hashpartitioning") == exchanges, plans[-1]


def test_rounds_have_tasks_by_links_and_leave_the_session_alone(spark, monkeypatch):
    before = dict(spark.conf.getAll.items())
    partitions, settle = [], graph_loops._settle

    def watched(df, parts, on):
        partitions.append(parts)
        return settle(df, parts, on)

    monkeypatch.setattr(graph_loops, "_settle", watched)
    monkeypatch.setattr(graph_loops, "MANY_LINKS", 5)
    n, edges = random_graph(4, 30, 200, hub=True)
    graph_loops.pagerank(*make_graph(spark, n, edges), iterations=1)
    assert partitions == [-(-len(set(edges)) // 5)] * 2 and partitions[0] > 8
    assert dict(spark.conf.getAll.items()) == before


@pytest.mark.parametrize(
    "links, cores, parts", [(0, 8, 2), (147_000, 8, 6), (10**6, 8, 8), (10**8, 8, 50), (10**8, 1000, 1000), (10**9, 1000, 1000), (10**10, 1000, 5000)]
)
def test_partitions_of_a_round(links, cores, parts):
    """Cores while there are links for them, then partitions of two million links; a round has the square of that in blocks."""
    assert graph_loops.round_partitions(links, cores) == parts


def test_traffic_is_reduced_to_pairs_of_stations_after_the_users(spark, conf, city):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = planned(graph.optional_match(city.stations, city.trips, city.users))
    pairs = plan.index("keys=[start_station_id")
    assert "user_id" not in plan[pairs : plan.index("]", pairs)] and plan.index("LeftSemi", pairs) > pairs
    assert plan.count("partial_count(1)") == 1


def test_links_are_reduced_before_their_ends_are_checked(spark, conf, city):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    nodes, edges = graph.station_graph(city.stations, city.trips)
    plan = planned(graph.with_known_ends(graph.weighted_links(edges), nodes))
    assert plan.index("LeftSemi") < plan.index("HashAggregate")


def test_number_rows(spark):
    df = spark.range(0, 3000, 3).repartition(7)
    got = sorted(rows(number_rows(df, "id", "n").select("id", "n")))
    assert got == [(3 * i, i) for i in range(1000)]


def test_walks_agree_between_forms(city):
    linked = graph.linked_trips(city.trips, city.users, city.stations)
    docs = documents.embed_events(linked, city.events)
    counted = {t.station_id: t.trips_ending for t in documents.station_counts(docs, city.stations).collect()}
    top = {t.station_id: t.incoming for t in graph.optional_match(city.stations, city.trips, city.users).collect()}
    assert {k: v for k, v in top.items() if k in counted} == counted
    assert isinstance(city, Mobility)
