"""The same results in SQL, written independently of the Spark code, for DuckDB on the given tables."""

from __future__ import annotations

from pedalflow.operators.documents import PART_EVENTS
from pedalflow.operators.graph_loops import ITERATIONS, RESET
from pedalflow.sources import generate as g

VIEWS = """
users AS (
  SELECT c_custkey AS user_id, c_name AS name, c_mktsegment AS surname,
         DATE '1960-01-01' + CAST(c_custkey % 14600 AS INT) AS birthdate, n_name AS country
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
stations AS (
  SELECT s_suppkey AS station_id, s_name AS name, n_name AS city, CAST(10 + s_suppkey % 41 AS INT) AS capacity
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
ranked_lines AS (
  SELECT l_orderkey, l_suppkey, l_shipdate,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_suppkey) AS a,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_suppkey DESC) AS z
  FROM lineitem),
trips AS (
  SELECT o_orderkey AS trip_id, o_custkey AS user_id, f.l_suppkey AS start_station_id,
         g.l_suppkey AS end_station_id, f.l_shipdate AS start_time, g.l_shipdate AS end_time,
         o_totalprice AS total_cost
  FROM orders JOIN ranked_lines f ON f.l_orderkey = o_orderkey AND f.a = 1
              JOIN ranked_lines g ON g.l_orderkey = o_orderkey AND g.z = 1),
trip_events AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                   epoch_us(l_shipdate)) AS event_id,
         l_orderkey AS trip_id, l_shipdate AS timestamp,
         CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'ERROR' WHEN l_returnflag = 'R' THEN 'DELAY'
              WHEN l_returnflag = 'A' THEN 'GPS' ELSE 'BATTERY' END AS type,
         concat(CAST(CAST(l_quantity AS INT) AS VARCHAR), '%') AS value
  FROM lineitem),
leveled_events AS (
  SELECT *, CASE WHEN type = 'BATTERY' AND CAST(replace(value, '%', '') AS INT) <= 25
                 THEN CAST(replace(value, '%', '') AS INT) END AS battery_level
  FROM trip_events),
element AS (
  SELECT trip_id, strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS timestamp, type, value,
         (row_number() OVER (PARTITION BY trip_id ORDER BY strftime(timestamp, '%Y-%m-%d %H:%M:%S'), type, value, event_id) - 1)
           // {part_events} AS part
  FROM trip_events WHERE trip_id IN (SELECT trip_id FROM trips)),
texts AS (
  SELECT trip_id, user_id, start_station_id, end_station_id,
         strftime(start_time, '%Y-%m-%d %H:%M:%S') AS start_time,
         strftime(end_time, '%Y-%m-%d %H:%M:%S') AS end_time, total_cost
  FROM trips),
arrays AS (
  SELECT trip_id, part, count(*) OVER (PARTITION BY trip_id) AS parts, to_json(list(struct_pack(timestamp := timestamp, type := type, value := value)
                               ORDER BY timestamp, type, value))::VARCHAR AS events
  FROM element GROUP BY trip_id, part),
links AS (
  SELECT start_station_id AS src, end_station_id AS dst, count(*) AS weight FROM trips GROUP BY ALL)
""".replace("{part_events}", str(PART_EVENTS))


def _sql(body: str, more: str = "", recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{VIEWS.strip()}{', ' + more if more else ''}\n{body.strip()}"


MINUTES = "date_diff('second', start_time, end_time) / 60.0"
MEAN_MINUTES = "avg(date_diff('second', t.start_time, t.end_time)) / 60.0"

_Q2 = """
SELECT users.user_id, name, surname, coalesce(n, 0) AS total_trips, seconds / n / 60.0 AS avg_duration_minutes
FROM users LEFT JOIN (
  SELECT user_id AS rider, count(*) AS n, sum(date_diff('second', start_time, end_time))::DOUBLE AS seconds
  FROM trips GROUP BY rider) ON rider = users.user_id"""

_TRAFFIC = """
starts AS (SELECT start_station_id AS station_id, count(*) AS n FROM trips GROUP BY ALL),
ends AS (SELECT end_station_id AS station_id, count(*) AS n FROM trips GROUP BY ALL)"""

_LINKED = """
linked AS (
  SELECT * FROM trips WHERE user_id IN (SELECT user_id FROM users)
    AND start_station_id IN (SELECT station_id FROM stations) AND end_station_id IN (SELECT station_id FROM stations)),
linked_out AS (SELECT start_station_id AS station_id, count(*) AS n FROM linked GROUP BY ALL),
linked_in AS (SELECT end_station_id AS station_id, count(*) AS n FROM linked GROUP BY ALL)"""

_G2 = """
SELECT s.station_id, s.name AS station_name, s.city, coalesce(e.n, 0) AS incoming, coalesce(b.n, 0) AS outgoing
FROM stations s LEFT JOIN linked_out b ON b.station_id = s.station_id LEFT JOIN linked_in e ON e.station_id = s.station_id"""

_EDGES = _LINKED + """,
edges AS (
  SELECT user_id AS src, trip_id AS dst, 'PERFORMED' AS rel FROM linked
  UNION ALL SELECT trip_id, start_station_id, 'STARTS_AT' FROM linked
  UNION ALL SELECT trip_id, end_station_id, 'ENDS_AT' FROM linked)"""

_VERTICES = """
SELECT 'User' AS label, user_id AS id, name, surname, country, NULL::VARCHAR AS city, NULL::VARCHAR AS start_time,
       NULL::VARCHAR AS end_time, NULL::DOUBLE AS total_cost{more} FROM users
UNION ALL SELECT 'Station', station_id, name, NULL, NULL, city, NULL, NULL, NULL{more} FROM stations
UNION ALL SELECT 'Trip', trip_id, NULL, NULL, NULL, NULL, start_time, end_time, total_cost{more} FROM texts"""

_ERRORS = "errors AS (SELECT DISTINCT trip_id FROM trip_events WHERE type = 'ERROR')"


def _pagerank_ctes() -> str:
    rounds = ["d AS MATERIALIZED (SELECT src, sum(weight) AS deg FROM links GROUP BY src)",
              "e AS MATERIALIZED (SELECT src, dst, weight / deg AS share FROM links JOIN d USING (src))",
              "r0 AS MATERIALIZED (SELECT station_id AS id, 1.0::DOUBLE AS rank FROM stations)"]
    for i in range(1, ITERATIONS + 1):
        rounds.append(
            f"r{i} AS MATERIALIZED (SELECT v.id, {RESET} + {1 - RESET} * coalesce(sum(r.rank * e.share), 0) AS rank"
            f" FROM r0 v LEFT JOIN e ON e.dst = v.id LEFT JOIN r{i - 1} r ON r.id = e.src GROUP BY v.id)"
        )
    rounds.append(
        "pr AS (SELECT id, round(rank * (SELECT count(*) / sum(rank) FROM r%d), 6) AS pagerank FROM r%d)"
        % (ITERATIONS, ITERATIONS)
    )
    return ",\n".join(rounds)


_COMPONENTS = """
undirected AS MATERIALIZED (SELECT src, dst FROM links UNION SELECT dst, src FROM links),
reach AS (SELECT station_id AS id, station_id AS other FROM stations
          UNION SELECT r.id, b.dst FROM reach r JOIN undirected b ON b.src = r.other),
roots AS (SELECT id, min(other) AS root FROM reach GROUP BY id)"""


def _list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _pick(values: list[str], index: str) -> str:
    return f"{_list(values)}[CAST({index} + 1 AS INT)]"


def _pick_value(event_type: str, number: str) -> str:
    cases = " ".join(
        f"WHEN {event_type} = '{t}' THEN {_pick(v, f'({number} % {len(v)})')}" for t, v in g.EVENT_VALUES.items()
    )
    return f"CASE {cases} END"


def oracle_sql() -> dict[str, str]:
    q1_from = """
FROM {trips} t JOIN users u ON t.user_id = u.user_id
JOIN stations s1 ON t.start_station_id = s1.station_id JOIN stations s2 ON t.end_station_id = s2.station_id"""
    details = (
        "SELECT t.trip_id, u.name, u.surname, u.country, s1.name AS start_station, s2.name AS end_station, "
        "t.start_time, t.end_time, t.total_cost{more}" + q1_from.format(trips="trips")
    )
    q3 = """
SELECT s.station_id, s.name, s.city, coalesce(b.n, 0) AS trips_starting, coalesce(e.n, 0) AS trips_ending
FROM stations s LEFT JOIN starts b ON b.station_id = s.station_id LEFT JOIN ends e ON e.station_id = s.station_id"""
    return {
        # flagship queries
        "q1_trip_details": _sql(details.format(more="")),
        "q1_trip_details_doc": _sql(
            "SELECT t.trip_id, u.name AS user_name, u.surname AS user_surname, u.country AS user_country, "
            "s1.name AS start_station, s2.name AS end_station, t.start_time, t.end_time, t.total_cost"
            + q1_from.format(trips="texts")
        ),
        "q2_user_stats": _sql(_Q2),
        "q2_user_stats_doc": _sql(f"""
SELECT t.user_id, u.name, u.surname, count(*) AS total_trips, {MEAN_MINUTES} AS avg_duration_minutes
FROM trips t LEFT JOIN users u ON u.user_id = t.user_id GROUP BY ALL"""),
        "q2_user_stats_null": _sql(f"""
SELECT u.user_id, u.name, u.surname, s.total_trips, s.avg_duration_minutes FROM users u LEFT JOIN (
  SELECT user_id, count(trip_id) AS total_trips, {MEAN_MINUTES} AS avg_duration_minutes FROM trips t GROUP BY user_id
) s ON s.user_id = u.user_id"""),
        "q3_station_counts": _sql(q3, _TRAFFIC),
        "q3_station_counts_doc": _sql("""
SELECT station_id, coalesce(s.name, 'unknown') AS name, coalesce(s.city, 'unknown') AS city,
       coalesce(b.n, 0) AS trips_starting, coalesce(e.n, 0) AS trips_ending
FROM starts b FULL JOIN ends e USING (station_id) LEFT JOIN stations s USING (station_id)""", _TRAFFIC),
        "q4_error_trips": _sql("""
SELECT trip_id, name, surname, start_time, end_time, total_cost
FROM trips SEMI JOIN errors USING (trip_id) JOIN users USING (user_id)""", _ERRORS),
        "q4_error_trips_doc": _sql("""
SELECT trip_id, user_id, start_time, end_time, total_cost FROM texts
WHERE trip_id IN (SELECT trip_id FROM errors)""", _ERRORS),
        "g1_reachable_stations": _sql("""
SELECT DISTINCT s.station_id, s.name AS station_name, s.city
FROM trips t JOIN stations s ON s.station_id IN (t.start_station_id, t.end_station_id)
WHERE t.user_id = 1 ORDER BY station_name, station_id"""),
        "g2_top3_stations": _sql(
            f"SELECT *, incoming + outgoing AS total_trips FROM ({_G2}) ORDER BY total_trips DESC, station_id LIMIT 3",
            _LINKED,
        ),
        "pagerank_top3": _sql("""
SELECT id, name, city, pagerank FROM pr JOIN stations ON station_id = id ORDER BY pagerank DESC, id LIMIT 3""",
            _pagerank_ctes()),
        "connected_components": _sql("""
SELECT id, name, city, dense_rank() OVER (ORDER BY root) - 1 AS component
FROM roots JOIN stations ON station_id = id""", _COMPONENTS, recursive=True),
        "evolve_battery_level": _sql("""
SELECT event_id, trip_id, timestamp, type, value,
       CASE WHEN type = 'BATTERY' THEN coalesce(battery_level, 50) ELSE battery_level END AS battery_level
FROM leveled_events"""),
        "evolve_battery_level_doc": _sql("""
SELECT t.*, d.part, d.parts, coalesce(d.events, '[]') AS events FROM texts t JOIN (
  SELECT t.trip_id, coalesce(part, 0) AS part, coalesce(parts, 1) AS parts, events FROM texts t LEFT JOIN (
    SELECT trip_id, part, count(*) OVER (PARTITION BY trip_id) AS parts, to_json(list(struct_pack(timestamp := timestamp, type := type, value := value,
             battery_level := CASE WHEN type = 'BATTERY' THEN 50 END) ORDER BY timestamp, type, value))::VARCHAR AS events
    FROM element GROUP BY trip_id, part) e ON e.trip_id = t.trip_id) d ON d.trip_id = t.trip_id"""),
        # scans, sources, sinks, layout
        "scan_project": _sql("SELECT trip_id, user_id, start_time, end_time FROM trips"),
        "scan_stations_edges": _sql("""
SELECT 'station' AS kind, station_id AS a, NULL::BIGINT AS b, name, city FROM stations
UNION ALL SELECT 'trip', start_station_id, end_station_id, NULL, NULL FROM trips"""),
        "write_tables": _sql(
            details.format(more=", (SELECT count(*) FROM trip_events v WHERE v.trip_id = t.trip_id) AS n_events")
        ),
        "write_docs": _sql(
            "SELECT t.*, coalesce(a.part, 0) AS part, coalesce(a.parts, 1) AS parts, coalesce(a.events, '[]') AS events "
            "FROM texts t LEFT JOIN arrays a ON a.trip_id = t.trip_id"
        ),
        "embed_events": _sql(
            "SELECT t.trip_id, t.user_id, coalesce(a.part, 0) AS part, coalesce(a.events, '[]') AS events "
            "FROM texts t LEFT JOIN arrays a ON a.trip_id = t.trip_id"
        ),
        "unembed_events": _sql("SELECT trip_id, timestamp, type, value FROM element"),
        "graph_vertices": _sql(_VERTICES.format(more="")),
        "graph_edges": _sql("SELECT src, dst, rel FROM edges", _EDGES),
        "merge_upsert": _sql(
            _VERTICES.format(more=", NULL::BIGINT AS dst")
            + " UNION ALL SELECT rel, src, NULL, NULL, NULL, NULL, NULL, NULL, NULL, dst FROM edges",
            _EDGES,
        ),
        "unique_key_check": _sql("""
SELECT table_name, CAST(sum(n) AS BIGINT) AS row_count, count(*) AS keys,
       count(*) FILTER (n > 1) AS duplicated_keys, 0::BIGINT AS null_keys
FROM (SELECT 'users' AS table_name, user_id::VARCHAR AS k, count(*) AS n FROM users GROUP BY ALL
      UNION ALL SELECT 'stations', station_id::VARCHAR, count(*) FROM stations GROUP BY ALL
      UNION ALL SELECT 'trips', trip_id::VARCHAR, count(*) FROM trips GROUP BY ALL
      UNION ALL SELECT 'events', event_id, count(*) FROM trip_events GROUP BY ALL) GROUP BY table_name"""),
        "fk_check": _sql("""
SELECT 'trips.user_id' AS reference, count(*) AS orphans FROM trips WHERE user_id NOT IN (SELECT user_id FROM users)
UNION ALL SELECT 'trips.start_station_id', count(*) FROM trips
  WHERE start_station_id NOT IN (SELECT station_id FROM stations)
UNION ALL SELECT 'trips.end_station_id', count(*) FROM trips
  WHERE end_station_id NOT IN (SELECT station_id FROM stations)
UNION ALL SELECT 'events.trip_id', count(*) FROM trip_events WHERE trip_id NOT IN (SELECT trip_id FROM trips)"""),
        "csv_sink": _sql(_Q2),
        "preview": _sql("SELECT trip_id, user_id, start_time, end_time, total_cost FROM trips ORDER BY trip_id LIMIT 5"),
        "partition_layout": _sql(_Q2),
        # projection, filter, predicate
        "rename_vertices": _sql("SELECT station_id AS id, name, city FROM stations"),
        "filter_eq": _sql("SELECT event_id, trip_id, type, value FROM trip_events WHERE type = 'BATTERY'"),
        "filter_null_and": _sql(
            "SELECT event_id, trip_id, value FROM leveled_events WHERE type = 'BATTERY' AND battery_level IS NULL"
        ),
        "array_any_eq": _sql(
            "SELECT DISTINCT trip_id FROM element WHERE type = 'BATTERY'"
        ),
        "filter_param": _sql("SELECT trip_id, start_station_id, end_station_id FROM trips WHERE user_id = 1"),
        "default_missing": _sql(
            "SELECT trip_id, type, CASE WHEN type = 'BATTERY' THEN '50' ELSE 'MISSING' END AS battery_level FROM element"
        ),
        "check_range": _sql("""
SELECT event_id, battery_level FROM (
  SELECT event_id, CASE WHEN type = 'BATTERY' THEN 3 * CAST(replace(value, '%', '') AS INT) END AS battery_level
  FROM trip_events) WHERE NOT (battery_level IS NULL OR (battery_level >= 0 AND battery_level <= 100))"""),
        # joins
        "join_inner_users": _sql(
            "SELECT t.trip_id, u.name, u.surname, u.country FROM trips t JOIN users u ON t.user_id = u.user_id"
        ),
        "join_two_roles": _sql("""
SELECT t.trip_id, s1.name AS start_station, s2.name AS end_station FROM trips t
JOIN stations s1 ON t.start_station_id = s1.station_id JOIN stations s2 ON t.end_station_id = s2.station_id"""),
        "join_left_agg": _sql("""
SELECT s.station_id, s.name, count(t.trip_id) AS trips
FROM stations s LEFT JOIN trips t ON t.start_station_id = s.station_id GROUP BY ALL"""),
        "semi_exists": _sql("SELECT trip_id, user_id FROM trips WHERE trip_id IN (SELECT trip_id FROM errors)", _ERRORS),
        "lookup": _sql("""
SELECT t.trip_id, t.user_id,
       coalesce((SELECT to_json(list(struct_pack(user_id := u.user_id, name := u.name, surname := u.surname)))::VARCHAR
                 FROM users u WHERE u.user_id = t.user_id), '[]') AS user
FROM texts t"""),
        "unwind_inner": _sql("""
SELECT t.trip_id, t.user_id, e.timestamp, e.type, e.value FROM texts t JOIN element e ON e.trip_id = t.trip_id"""),
        "unwind_outer": _sql("""
SELECT t.trip_id, t.user_id, e.timestamp, e.type, e.value FROM texts t LEFT JOIN element e ON e.trip_id = t.trip_id"""),
        "full_outer_counts": _sql("""
SELECT k.station_id, coalesce(b.n, 0) AS starts, coalesce(e.n, 0) AS ends
FROM (SELECT station_id FROM starts UNION SELECT station_id FROM ends) k
LEFT JOIN starts b ON b.station_id IS NOT DISTINCT FROM k.station_id
LEFT JOIN ends e ON e.station_id IS NOT DISTINCT FROM k.station_id""", _TRAFFIC),
        "path_two_hop": _sql("""
SELECT DISTINCT p.src AS user_id, s.station_id, s.name AS station_name
FROM edges p JOIN edges h ON h.src = p.dst AND h.rel IN ('STARTS_AT', 'ENDS_AT')
JOIN stations s ON s.station_id = h.dst WHERE p.rel = 'PERFORMED'""", _EDGES),
        "optional_match": _sql(_G2, _LINKED),
        "edges_valid": _sql("""
SELECT start_station_id AS src, end_station_id AS dst FROM trips
WHERE start_station_id IN (SELECT station_id FROM stations) AND end_station_id IN (SELECT station_id FROM stations)"""),
        # aggregation
        "count_distinct": _sql("""
SELECT start_station_id, count(DISTINCT user_id) AS users, count(DISTINCT end_station_id) AS destinations
FROM trips GROUP BY start_station_id"""),
        "group_count": _sql("SELECT start_station_id, count(*) AS n FROM trips GROUP BY start_station_id"),
        "group_agg_df": _sql(
            f"SELECT user_id, count(trip_id) AS total_trips, {MEAN_MINUTES} AS avg_duration_minutes FROM trips t GROUP BY user_id"
        ),
        "count_filtered": _sql("""
SELECT (SELECT count(*) FROM trip_events WHERE type = 'BATTERY') AS battery_events,
       (SELECT count(DISTINCT trip_id) FROM trip_events WHERE type = 'BATTERY') AS battery_trips"""),
        "graph_sizes": _sql(
            "SELECT (SELECT count(*) FROM stations) AS vertices, (SELECT count(*) FROM trips) AS edges"
        ),
        "max_coalesce": _sql("""
SELECT 'users' AS table_name, coalesce(max(user_id)::VARCHAR, '1') AS max_id FROM users
UNION ALL SELECT 'stations', coalesce(max(station_id)::VARCHAR, '1') FROM stations
UNION ALL SELECT 'trips', coalesce(max(trip_id)::VARCHAR, '1') FROM trips
UNION ALL SELECT 'events', coalesce(max(event_id), '1') FROM trip_events"""),
        "components_count": _sql(
            "SELECT count(*) AS vertices, count(DISTINCT root) AS components FROM roots", _COMPONENTS, recursive=True
        ),
        # sort, limit, distinct, set operations
        "topk": _sql(_Q2 + " ORDER BY total_trips DESC, users.user_id LIMIT 3"),
        "distinct_rows": _sql("SELECT DISTINCT start_station_id, end_station_id FROM trips"),
        "union_keys": _sql("SELECT start_station_id AS station_id FROM trips UNION SELECT end_station_id FROM trips"),
        "union_all_edges": _sql("SELECT src, dst, rel FROM edges WHERE rel <> 'PERFORMED'", _EDGES),
        # scalar functions
        "duration_minutes": _sql(f"SELECT trip_id, {MINUTES} AS minutes FROM trips"),
        "parse_ts": _sql("""
SELECT trip_id, strptime(start_time, '%Y-%m-%d %H:%M:%S') AS start_time,
       strptime(end_time, '%Y-%m-%d %H:%M:%S') AS end_time FROM texts"""),
        "format_ts": _sql("SELECT trip_id, start_time, end_time FROM texts"),
        "ts_add": _sql("""
SELECT trip_id, start_time + to_days(CAST(trip_id % 365 AS INT)) + to_hours(6) + to_minutes(CAST(user_id % 60 AS INT))
                + to_seconds(1) AS later FROM trips"""),
        "cost_round": _sql(f"SELECT trip_id, round(1.0 + {MINUTES} * 0.15::DOUBLE + total_cost / 1000000, 2) AS cost FROM trips"),
        "greatest_one": _sql(
            "SELECT trip_id, greatest(date_diff('second', start_time, end_time), 1) AS seconds FROM trips"
        ),
        "concat_name": _sql("SELECT station_id, city || ' ' || name AS full_name FROM stations"),
        "pick_value": _sql(f"SELECT event_id, type, {_pick_value('type', 'trip_id')} AS picked FROM trip_events"),
        # schema evolution
        "add_column": _sql("SELECT event_id, trip_id, type, NULL::INT AS battery_level FROM trip_events"),
        "evolve_counts": _sql("""
SELECT count(*) FILTER (type = 'BATTERY') AS battery_events,
       count(*) FILTER (type = 'BATTERY' AND battery_level IS NULL) AS backfilled, count(*) AS events,
       count(DISTINCT trip_id) FILTER (type = 'BATTERY') AS matched,
       count(DISTINCT trip_id) FILTER (type = 'BATTERY') AS modified
FROM leveled_events"""),
        "evolve_sample": _sql("""
SELECT event_id, trip_id, type, value, coalesce(battery_level, 50) AS battery_level
FROM leveled_events WHERE type = 'BATTERY' ORDER BY event_id LIMIT 5"""),
        "evolve_sample_doc": _sql("""
SELECT trip_id, timestamp, type, value, 50 AS battery_level FROM element
WHERE type = 'BATTERY' AND trip_id IN (
  SELECT DISTINCT trip_id FROM element WHERE type = 'BATTERY' ORDER BY trip_id LIMIT 3)"""),
        # graph
        "station_graph": _sql("SELECT start_station_id AS src, end_station_id AS dst FROM trips"),
        "station_degrees": _sql("""
SELECT s.station_id AS id, coalesce(e.n, 0) AS in_degree, coalesce(b.n, 0) AS out_degree, coalesce(e.n, 0) + coalesce(b.n, 0) AS degree
FROM stations s LEFT JOIN starts b ON b.station_id = s.station_id LEFT JOIN ends e ON e.station_id = s.station_id""", _TRAFFIC),
        "pagerank": _sql("SELECT id, name, city, pagerank FROM pr JOIN stations ON station_id = id", _pagerank_ctes()),
        # stored tables
        "key_lookup": _sql("SELECT trip_id, start_station_id, end_station_id FROM trips WHERE user_id = 1"),
        "g1_reachable_stored": _sql("""
SELECT station_id, name AS station_name, city FROM stations WHERE station_id IN (
  SELECT start_station_id FROM trips WHERE user_id = 1 UNION SELECT end_station_id FROM trips WHERE user_id = 1)"""),
        "update_where": _sql("""
SELECT event_id, trip_id, timestamp, type, value,
       CASE WHEN type = 'BATTERY' AND battery_level IS NULL THEN 50 ELSE battery_level END AS battery_level
FROM leveled_events"""),
        "add_column_versions": _sql("""
SELECT event_id, trip_id, timestamp, type, value, CASE WHEN trip_id % 2 = 1 THEN battery_level END AS battery_level
FROM leveled_events"""),
        "merge_stored": _sql(
            _VERTICES.format(more=", NULL::BIGINT AS dst")
            + " UNION ALL SELECT rel, src, NULL, NULL, NULL, NULL, NULL, NULL, NULL, dst FROM edges",
            _EDGES,
        ),
        "write_checked": _sql("""
SELECT 'users' AS table_name, 'rows' AS rule, count(*) AS broken FROM users
UNION ALL SELECT 'stations', 'rows', count(*) FROM stations
UNION ALL SELECT 'trips', 'rows', count(*) FROM trips
UNION ALL SELECT 'events', 'rows', count(*) FROM trip_events
UNION ALL SELECT 'high_levels', rule, CASE rule WHEN 'range_battery_level' THEN n ELSE 0 END
FROM (SELECT count(*) FILTER (30 * battery_level > 100) AS n FROM leveled_events),
     (SELECT unnest(['null_event_id', 'null_timestamp', 'null_type', 'null_value', 'long_type', 'range_battery_level',
                     'duplicate_event_id']) AS rule)"""),
        "count_distinct_bitmaps": _sql("""
SELECT start_station_id, count(DISTINCT user_id) AS users, count(DISTINCT end_station_id) AS destinations
FROM trips GROUP BY start_station_id"""),
        "semi_join_bitmap": _sql("SELECT trip_id, user_id FROM trips WHERE trip_id IN (SELECT trip_id FROM errors)", _ERRORS),
        "variant_docs": _sql("""
SELECT trip_id, type, value, battery_level, CASE WHEN type = 'ERROR' THEN value END AS code,
       CASE WHEN type = 'ERROR' THEN true END AS open
FROM leveled_events"""),
        "variant_fields": _sql("""
SELECT type, concat('OBJECT<', CASE WHEN count(battery_level) > 0 THEN 'battery_level: BIGINT, ' ELSE '' END,
                    CASE WHEN type = 'ERROR' THEN 'fault: OBJECT<code: STRING, open: BOOLEAN>, ' ELSE '' END,
                    'timestamp: STRING, type: STRING, value: STRING>') AS fields
FROM leveled_events GROUP BY type"""),
        "trips_from_city": _sql("""
SELECT trip_id, start_station_id, s.name AS station FROM trips JOIN stations s ON s.station_id = start_station_id
WHERE s.city = 'FRANCE'"""),
    }
