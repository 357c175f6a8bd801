"""PageRank and connected components as loops of joins and aggregates.

Edges are collapsed to one row per station pair and checkpointed before the first round, and
the state of a loop is checkpointed between rounds; only single numbers reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pedalflow.operators.graph import weighted_links, with_known_ends
from pedalflow.operators.numbering import number_rows
from pedalflow.operators.skew import TARGET_ROWS, hot_keys, replicate, salted_join, spread
from pedalflow.session import checkpoint, in_session, planning_session

RESET = 0.15
ITERATIONS = 10
# Links that are worth a partition of their own while cores are free, and those that one holds at most (some 50 MB).
FEW_LINKS, MANY_LINKS = 25_000, 2_000_000


def pagerank(
    nodes: DataFrame,
    edges: DataFrame,
    reset: float = RESET,
    iterations: int = ITERATIONS,
    target_rows: int = TARGET_ROWS,
) -> DataFrame:
    """``nodes`` with their ``pagerank`` after a fixed number of rounds.

    Ranks start at 1; a round gives ``reset + (1 - reset) * sum(rank / out-degree)`` over the
    incoming edges, parallel ones counted each. At the end ranks are scaled to sum to the
    number of vertices. Links are laid out once by source, or by (source, slot) with a busy
    source dealt over several slots, and stay put: a round moves the partial sums per target.
    """
    links = checkpoint(with_known_ends(weighted_links(edges), nodes))
    sources = links.groupBy("src").agg(F.sum("weight").alias("out_degree"), F.count("*").alias("n"))
    n_links, busiest = sources.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    parts = round_partitions(n_links, nodes.sparkSession.sparkContext.defaultParallelism)
    # The rounds are planned in a session of their own; the caller's keeps its settings.
    loop = planning_session(nodes.sparkSession, parts)
    links = in_session(loop, links, "links")
    ids = in_session(loop, nodes.select("id"), "vertices")
    sources = links.groupBy("src").agg(F.sum("weight").alias("out_degree"), F.count("*").alias("n"))
    hot, on = None, ["src"]
    if busiest > target_rows:
        hot, on = hot_keys(sources, "src", target_rows=target_rows), ["src", "slot"]
    salted = links if hot is None else spread(links, hot, "src", F.col("dst"))
    out_degrees = sources.select(F.col("src").alias("id"), "out_degree")

    placed = _settle(salted, parts, on)
    state = _settle(ids.join(out_degrees, "id", "left"), parts, ["id"])
    ranks = state.withColumn("rank", F.lit(1.0))
    for _ in range(iterations):
        ranks = checkpoint(_pass_ranks(placed, state, ranks, hot, on, reset))

    ranks = in_session(nodes.sparkSession, ranks.select("id", "rank"), "ranks")
    scale = ranks.agg((F.count("*") / F.sum("rank")).alias("scale")).scalar()
    scaled = ranks.withColumn("pagerank", F.col("rank") * scale).drop("rank")
    return nodes.join(scaled, "id")


def round_partitions(n_links: int, cores: int) -> int:
    """Partitions of a round: as many as there are cores, fewer for few links, more only where one would hold too many, since a
    round shuffles a block from each partition to each. Two at least: one alone Spark would shuffle again."""
    return max(2, min(-(-n_links // FEW_LINKS), cores), -(-n_links // MANY_LINKS))


def _settle(df: DataFrame, parts: int, on: list[str]) -> DataFrame:
    """Write ``df`` laid out and sorted by ``on``; in the loop's session joins on ``on`` do not move it again."""
    return checkpoint(df.repartition(parts, *on).sortWithinPartitions(*on))


def _pass_ranks(
    placed: DataFrame, state: DataFrame, ranks: DataFrame, hot: DataFrame | None, on: list[str], reset: float
) -> DataFrame:
    """One round. ``placed``, ``state`` and ``ranks`` stay where they are, only partial sums move
    (and the ranks, if busy sources are spread over slots)."""
    shares = ranks.filter(F.col("out_degree").isNotNull()).select(
        F.col("id").alias("src"), (F.col("rank") / F.col("out_degree")).alias("share")
    )
    received = (
        placed.join((shares if hot is None else replicate(shares, hot, "src")).hint("merge"), on)
        .groupBy(F.col("dst").alias("id"))
        .agg(F.sum(F.col("share") * F.col("weight")).alias("received"))
    )
    rank = F.lit(reset) + F.lit(1.0 - reset) * F.coalesce("received", F.lit(0.0))
    return state.join(received.hint("merge"), "id", "left").select("id", "out_degree", rank.alias("rank"))


def pagerank_top(nodes: DataFrame, edges: DataFrame, k: int = 3) -> DataFrame:
    """The k vertices with the highest rank; ties go to the lower id."""
    return (
        pagerank(nodes, edges)
        .select("id", "name", "city", "pagerank")
        .orderBy(F.desc("pagerank"), "id")
        .limit(k)
    )


def _stars(nodes: DataFrame, edges: DataFrame, target_rows: int) -> tuple[DataFrame, int]:
    """``(u, v)``: every vertex u on the lowest vertex v of its component, and the most links at a vertex.

    Alternating large-star and small-star rounds (Kiveris et al., "Connected Components in
    MapReduce and Beyond", 2014) until every vertex hangs on its root. A vertex with very many
    neighbours is split over several tasks.
    """
    pairs = edges.filter(F.col("src") != F.col("dst")).select(
        F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")
    )
    known = with_known_ends(pairs.distinct(), nodes)
    links = checkpoint(known.select(F.col("src").alias("u"), F.col("dst").alias("v")))
    unfinished, busiest = _progress(links)
    while unfinished:
        salted = busiest > target_rows
        links = checkpoint(_large_star(links, target_rows, salted))
        links = checkpoint(_small_star(links, target_rows, salted))
        unfinished, busiest = _progress(links)
    return links, busiest


def _roots(nodes: DataFrame, links: DataFrame) -> DataFrame:
    hung = links.select(F.col("u").alias("id"), F.col("v").alias("root"))
    return nodes.select("id").join(hung, "id", "left").withColumn("root", F.coalesce("root", "id"))


def component_roots(nodes: DataFrame, edges: DataFrame, target_rows: int = TARGET_ROWS) -> DataFrame:
    """``(id, root)``: the lowest vertex id in each vertex's component, edges taken both ways."""
    return _roots(nodes, _stars(nodes, edges, target_rows)[0])


def _progress(links: DataFrame) -> tuple[int, int]:
    """Vertices that hang on two others, or hang on one and carry one; and the most links at a vertex."""
    ends = F.array(
        F.struct(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")),
        F.struct(F.col("v").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down")),
    )
    per_vertex = links.select(F.inline(ends)).groupBy("id").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    unfinished = (F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))
    return tuple(
        per_vertex.agg(
            F.count_if(unfinished),
            F.coalesce(F.max(F.col("up") + F.col("down")), F.lit(0)),
        ).first()
    )


def _large_star(links: DataFrame, target_rows: int, salted: bool) -> DataFrame:
    """Hang every higher neighbour of u on the lowest vertex among u and its neighbours."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    hot = hot_keys(lowest, "u", target_rows=target_rows) if salted else None
    root = F.least("u", "m").alias("m")
    joined = salted_join(both, lowest.select("u", root), hot, "u", F.col("v"))
    return joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame, target_rows: int, salted: bool) -> DataFrame:
    """Hang u and its lower neighbours on the lowest of these."""
    lowest = links.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    hot = hot_keys(lowest, "u", target_rows=target_rows) if salted else None
    joined = salted_join(links, lowest.select("u", "m"), hot, "u", F.col("v"))
    moved = joined.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct()


def connected_components(nodes: DataFrame, edges: DataFrame, target_rows: int = TARGET_ROWS) -> DataFrame:
    """``(id, name, city, component)`` in the order of component and id; components count from 0 by lowest id."""
    links, busiest = _stars(nodes, edges, target_rows)
    roots = _roots(nodes, links)
    # A root is the one vertex that is its own root.
    numbers = number_rows(roots.filter(F.col("id") == F.col("root")).select("root"), "root", "component")
    hot = None
    if busiest >= target_rows:  # a component has one vertex more than its root has links
        sizes = roots.groupBy("root").agg(F.count("*").alias("n"))
        hot = hot_keys(sizes, "root", target_rows=target_rows)
    labelled = salted_join(roots, numbers, hot, "root", F.col("id"))
    return (
        nodes.join(labelled.select("id", "component"), "id")
        .select("id", "name", "city", "component")
        .orderBy("component", "id")
    )


def component_count(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Vertices and components."""
    return component_roots(nodes, edges).agg(
        F.count("*").alias("vertices"), F.count_if(F.col("id") == F.col("root")).alias("components")
    )
