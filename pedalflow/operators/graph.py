"""The property graph as vertex and edge tables, and the queries that walk it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pedalflow.functions.scalars import format_ts, or_default
from pedalflow.sources.keyed import KeyedTable

PERFORMED, STARTS_AT, ENDS_AT = "PERFORMED", "STARTS_AT", "ENDS_AT"

# Label -> key of its vertices, unique within the label.
VERTEX_KEYS = {"User": "user_id", "Station": "station_id", "Trip": "trip_id"}


def vertices(users: DataFrame, stations: DataFrame, trips: DataFrame) -> dict[str, DataFrame]:
    """The vertex table of each label; trip times are text.

    Keys are unique in the tables (``quality.duplicate_keys``), so nothing is shuffled to
    compare rows; ``merge_upsert`` takes in a batch that repeats some.
    """
    return {
        "User": users.select("user_id", "name", "surname", "country"),
        "Station": stations.select("station_id", "name", "city"),
        "Trip": trips.select(
            "trip_id",
            format_ts("start_time").alias("start_time"),
            format_ts("end_time").alias("end_time"),
            "total_cost",
        ),
    }


def vertex_list(labelled: dict[str, DataFrame]) -> DataFrame:
    """All vertices as label, id and the properties of all labels; null where a label lacks one."""
    parts = [
        df.withColumnRenamed(VERTEX_KEYS[label], "id").select(F.lit(label).alias("label"), "*") for label, df in labelled.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def merge_graph(
    vertices_in: dict[str, DataFrame], edges_in: DataFrame, vertices_new: dict[str, DataFrame], edges_new: DataFrame
) -> tuple[dict[str, DataFrame], DataFrame]:
    """``merge_upsert`` for the vertices of every label and for the relationships of every type."""
    merged = {label: merge_upsert(df, vertices_new[label]) for label, df in vertices_in.items()}
    return merged, merge_upsert(edges_in, edges_new)


def merge_upsert(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """``existing`` plus the incoming rows that equal none of its rows in every property.

    A row whose key exists with other properties is added too; ``quality.duplicate_keys`` finds it.
    """
    new = incoming.select(existing.columns).distinct().alias("new")
    same = [F.col(f"new.{c}").eqNullSafe(F.col(f"old.{c}")) for c in existing.columns]
    return existing.unionByName(new.join(existing.alias("old"), same, "left_anti"))


def linked_trips(trips: DataFrame, users: DataFrame, stations: DataFrame) -> DataFrame:
    """Trips whose user and both stations exist; only these get edges."""
    ids = stations.select("station_id")
    return (
        trips.join(users.select("user_id"), "user_id", "left_semi")
        .join(ids.withColumnRenamed("station_id", "start_station_id"), "start_station_id", "left_semi")
        .join(ids.withColumnRenamed("station_id", "end_station_id"), "end_station_id", "left_semi")
    )


def trip_edges(linked: DataFrame) -> DataFrame:
    """User-PERFORMED->Trip, Trip-STARTS_AT->Station and Trip-ENDS_AT->Station, from one scan."""

    def edge(src: str, dst: str, rel: str):
        return F.struct(F.col(src).alias("src"), F.col(dst).alias("dst"), F.lit(rel).alias("rel"))

    return linked.select(
        F.inline(
            F.array(
                edge("user_id", "trip_id", PERFORMED),
                edge("trip_id", "start_station_id", STARTS_AT),
                edge("trip_id", "end_station_id", ENDS_AT),
            )
        )
    )


def station_edges(edges: DataFrame) -> DataFrame:
    """Trip-to-station edges of either kind, as one list."""
    starts, ends = (edges.filter(F.col("rel") == rel) for rel in (STARTS_AT, ENDS_AT))
    return starts.unionByName(ends)


def _named_ends(pairs: DataFrame, stations: DataFrame, *kept: str) -> DataFrame:
    """Both stations of distinct ``start_station_id``, ``end_station_id`` pairs as rows of their own, distinct; a pair
    with an unknown end drops out. ``stations`` is joined once per end and brings its other columns along."""
    others = [c for c in stations.columns if c != "station_id"]
    named = pairs
    for end in ("start", "end"):
        fields = F.struct(*stations.columns).alias(f"_{end}")
        known = stations.select(F.col("station_id").alias(f"{end}_station_id"), fields)
        named = named.join(known, f"{end}_station_id")
    station = F.explode(F.array("_start", "_end")).alias("_station")
    return named.select(*kept, station).select(*kept, "_station.station_id", *[f"_station.{c}" for c in others]).distinct()


def two_hop_paths(trips: DataFrame, users: DataFrame, stations: DataFrame) -> DataFrame:
    """Distinct User-PERFORMED->Trip-STARTS_AT|ENDS_AT->Station end points.

    A trip's row holds its whole path, so the trips are read once and reduced to distinct
    user, start and end before they meet another table.
    """
    triples = trips.select("user_id", "start_station_id", "end_station_id").distinct()
    known = triples.join(users.select("user_id"), "user_id", "left_semi")
    names = stations.select("station_id", F.col("name").alias("station_name"))
    return _named_ends(known, names, "user_id").select("station_id", "user_id", "station_name")


def reachable_stations(trips: DataFrame, users: DataFrame, stations: DataFrame, user_id: int = 1) -> DataFrame:
    """The stations where one user's trips start or end, by name.

    The user filter reaches the trip scan, and the user's station pairs are made distinct before
    they meet another table.
    """
    own = trips.filter(F.col("user_id") == F.lit(user_id)).select("user_id", "start_station_id", "end_station_id")
    known = own.distinct().join(users.select("user_id"), "user_id", "left_semi")
    named = stations.select("station_id", F.col("name").alias("station_name"), "city")
    return _named_ends(known, named).orderBy("station_name", "station_id")


def reachable_stations_stored(trips: KeyedTable, users: KeyedTable, stations: DataFrame, user_id: int = 1) -> DataFrame:
    """``reachable_stations`` of trips and users laid out by user, of which only that user's rows are read."""
    return reachable_stations(trips.rows_of(user_id), users.rows_of(user_id), stations, user_id)


def optional_match(stations: DataFrame, trips: DataFrame, users: DataFrame) -> DataFrame:
    """Every station with its incoming and outgoing trips, 0 where there are none.

    Trips whose user, start or end is null or unknown have no edges. Users are looked up where the trips are read,
    or in a join that adaptive execution splits; the rest are reduced to counts per start and end before these are looked up.
    """
    ends = ["start_station_id", "end_station_id"]
    performed = trips.join(users.select("user_id"), "user_id", "left_semi")
    connected = performed.groupBy(*ends).agg(F.count("*").alias("n"))
    for end in ends:
        connected = connected.join(stations.select(F.col("station_id").alias(end)), end, "left_semi")
    both = F.array(
        F.struct(F.col(ends[0]).alias("station_id"), F.lit(0).alias("i"), F.col("n").alias("o")),
        F.struct(F.col(ends[1]).alias("station_id"), F.col("n").alias("i"), F.lit(0).alias("o")),
    )
    traffic = connected.select(F.inline(both)).groupBy("station_id").agg(F.sum("i").alias("i"), F.sum("o").alias("o"))
    return stations.join(traffic, "station_id", "left").select(
        "station_id",
        F.col("name").alias("station_name"),
        "city",
        or_default("i", 0).alias("incoming"),
        or_default("o", 0).alias("outgoing"),
    )


def top_stations(stations: DataFrame, trips: DataFrame, users: DataFrame, k: int = 3) -> DataFrame:
    """The k stations with the most incoming and outgoing trips; ties go to the lower id."""
    return (
        optional_match(stations, trips, users)
        .withColumn("total_trips", F.col("incoming") + F.col("outgoing"))
        .orderBy(F.desc("total_trips"), "station_id")
        .limit(k)
    )


def station_graph(stations: DataFrame, trips: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stations as vertices and one directed edge per trip; parallel edges and loops are kept."""
    nodes = stations.select("station_id", "name", "city").withColumnRenamed("station_id", "id")
    edges = trips.select(F.col("start_station_id").alias("src"), F.col("end_station_id").alias("dst"))
    return nodes, edges


def weighted_links(edges: DataFrame) -> DataFrame:
    """Parallel edges as one link with their number as weight."""
    return edges.groupBy("src", "dst").agg(F.count("*").alias("weight"))


def with_known_ends(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges whose ends are both vertices."""
    ids = nodes.select("id")
    return edges.join(ids.withColumnRenamed("id", "src"), "src", "left_semi").join(
        ids.withColumnRenamed("id", "dst"), "dst", "left_semi"
    )


def degrees(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """In, out and total degree of every vertex; ends that are no vertex count for the other end only."""
    ends = F.array(
        F.struct(F.col("src").alias("id"), F.lit(0).alias("i"), F.lit(1).alias("o")),
        F.struct(F.col("dst").alias("id"), F.lit(1).alias("i"), F.lit(0).alias("o")),
    )
    counted = edges.select(F.inline(ends)).groupBy("id").agg(F.sum("i").alias("i"), F.sum("o").alias("o"))
    known = nodes.select("id").join(counted, "id", "left")
    return known.select(
        "id", or_default("i", 0).alias("in_degree"), or_default("o", 0).alias("out_degree")
    ).withColumn("degree", F.col("in_degree") + F.col("out_degree"))
