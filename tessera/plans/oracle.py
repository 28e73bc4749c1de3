"""DuckDB SQL that computes the same results as the Spark jobs.

Used as the correctness oracle: each string runs on the raw parquet views
(region nation customer ... conversations) and must give the same rows,
column names and types as the matching Spark query.  The stand-in views of
:mod:`tessera.sources.standins` are written out again here as CTEs.
"""

from __future__ import annotations

PEOPLE = """people AS (
  SELECT c.c_custkey AS id, c.c_name AS name, n.n_name AS nationality,
         c.c_nationkey AS country_code, c.c_mktsegment AS hobby
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

LOGS = """logs AS (
  SELECT event_id AS acc_id, user_id AS by_who,
         TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS what_page,
         event_type AS type_of_access,
         CAST(date_diff('second', TIMESTAMP '2024-01-01 00:00:00', date_trunc('second', ts)) AS VARCHAR) AS access_time
  FROM events)"""

ASSOCIATES = """associates AS (
  SELECT o.o_orderkey * 10 + l.l_linenumber AS rel_id, o.o_custkey AS person_a, l.l_suppkey AS person_b
  FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey)"""

EDGES = """edges AS (
  SELECT person_a AS id, person_b AS friend_id FROM associates
  UNION ALL SELECT person_b AS id, person_a AS friend_id FROM associates)"""

DEGREE = """deg AS (
  SELECT id, count(id) AS relationship_count
  FROM (SELECT person_a AS id FROM associates UNION ALL SELECT person_b AS id FROM associates) ends
  GROUP BY id)"""

VISITED = """visited AS (
  SELECT DISTINCT by_who AS id, what_page AS friend_id FROM logs
  WHERE by_who IS NOT NULL AND what_page IS NOT NULL)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


from tessera.fixed import LATEST_ACCESS_MIN  # noqa: E402

NATIONALITY = "NATION_7"          # a nation of the stand-in people (report A's filter value there)
LATEST_THRESHOLD = LATEST_ACCESS_MIN


def report_sql() -> dict[str, str]:
    return {
        "filter_project_nationality": with_(PEOPLE) + f"""
SELECT name, hobby FROM people WHERE nationality = '{NATIONALITY}'""",

        "top_pages": with_(PEOPLE, LOGS) + """
SELECT p.id, p.name, p.nationality
FROM people p JOIN (SELECT what_page AS id, count(acc_id) AS access_count FROM logs GROUP BY what_page) a
  ON p.id = a.id
ORDER BY a.access_count DESC, p.id ASC LIMIT 10""",

        "people_per_nationality": with_(PEOPLE) + """
SELECT nationality, count(id) AS citizen_count FROM people GROUP BY nationality""",

        "relationship_degree": with_(PEOPLE, ASSOCIATES, DEGREE) + """
SELECT p.name AS owner_name, CAST(COALESCE(d.relationship_count, 0) AS BIGINT) AS happiness_factor
FROM people p LEFT JOIN deg d ON p.id = d.id""",

        "access_profile": with_(PEOPLE, LOGS) + """
SELECT p.name AS owner_name,
       CAST(COALESCE(a.total_accesses, 0) AS BIGINT) AS total_accesses,
       CAST(COALESCE(a.distinct_pages_accessed, 0) AS BIGINT) AS distinct_pages_accessed
FROM people p LEFT JOIN (
  SELECT by_who AS id, count(acc_id) AS total_accesses, count(DISTINCT what_page) AS distinct_pages_accessed
  FROM logs GROUP BY by_who) a ON p.id = a.id""",

        "unvisited_friends": with_(PEOPLE, LOGS, ASSOCIATES, EDGES, VISITED) + """
SELECT e.id, o.name, e.friend_id, f.name AS friend_name
FROM edges e
JOIN people f ON f.id = e.friend_id
JOIN people o ON o.id = e.id
WHERE NOT EXISTS (SELECT 1 FROM visited v WHERE v.id = e.id AND v.friend_id = e.friend_id)""",

        "friend_page_visits": with_(LOGS, ASSOCIATES, EDGES, VISITED) + """
SELECT DISTINCT e.id, e.friend_id FROM edges e
JOIN visited v ON v.id = e.id AND v.friend_id = e.friend_id""",

        "latest_access_threshold": with_(PEOPLE, LOGS) + f"""
SELECT p.id, p.name
FROM (SELECT what_page AS id, TRY_CAST(trim(max(access_time)) AS INTEGER) AS latest_date
      FROM logs GROUP BY what_page) g
JOIN people p ON p.id = g.id
WHERE g.latest_date >= {LATEST_THRESHOLD}""",

        "latest_access_numeric": with_(PEOPLE, LOGS) + f"""
SELECT p.id, p.name
FROM (SELECT what_page AS id, max(TRY_CAST(trim(access_time) AS INTEGER)) AS latest_date
      FROM logs GROUP BY what_page) g
JOIN people p ON p.id = g.id
WHERE g.latest_date >= {LATEST_THRESHOLD}""",

        "degree_summary": with_(ASSOCIATES, DEGREE) + """
SELECT CAST(sum(relationship_count) AS BIGINT) AS total_relationships,
       count(id) AS num_owners,
       CAST(sum(relationship_count) AS DOUBLE) / CAST(count(id) AS DOUBLE) AS average_relationships
FROM deg""",

        "above_average_degree": with_(PEOPLE, ASSOCIATES, DEGREE) + """
SELECT p.id, p.name, d.relationship_count
FROM deg d JOIN people p ON p.id = d.id
WHERE d.relationship_count > (SELECT CAST(sum(relationship_count) AS DOUBLE) / count(id) FROM deg)""",
    }


TRIPS = """trips AS (
  SELECT p.pickup AS tpep_pickup_datetime,
         p.pickup + to_seconds(p.k * 60 + 7) AS tpep_dropoff_datetime,
         CAST(p.user_id % 7 AS INTEGER) AS passenger_count,
         p.value AS trip_distance, p.k - 50.0 AS pickup_longitude, p.user_id % 90 - 45.0 AS pickup_latitude,
         p.k % 40 - 20.0 AS dropoff_longitude, p.value - p.user_id AS dropoff_latitude,
         CASE p.event_type WHEN 'purchase' THEN 1 WHEN 'click' THEN 2 WHEN 'view' THEN 3
                           WHEN 'signup' THEN 4 END AS payment_type,
         CAST(CASE WHEN p.event_type = 'purchase' THEN p.k % 5 ELSE 0 END AS DOUBLE) AS tip_amount,
         CAST(p.k % 3 AS DOUBLE) AS tolls_amount,
         p.value + p.k AS total_amount
  FROM (SELECT date_trunc('second', ts) AS pickup, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
               user_id, value, event_type FROM events) p)"""

CLEAN_TRIPS = """clean AS (
  SELECT * FROM trips
  WHERE tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL AND passenger_count IS NOT NULL
    AND trip_distance IS NOT NULL AND payment_type IS NOT NULL AND tip_amount IS NOT NULL
    AND tolls_amount IS NOT NULL AND total_amount IS NOT NULL
    AND pickup_longitude IS NOT NULL AND pickup_latitude IS NOT NULL
    AND dropoff_longitude IS NOT NULL AND dropoff_latitude IS NOT NULL
    AND pickup_longitude <> 0 AND pickup_latitude <> 0 AND dropoff_longitude <> 0 AND dropoff_latitude <> 0
    AND total_amount <> 0 AND passenger_count <> 0 AND trip_distance <> 0)"""


def trips_sql() -> dict[str, str]:
    return {
        "trip_features": with_(TRIPS, CLEAN_TRIPS) + """
SELECT passenger_count, trip_distance, CAST(pickup_longitude AS DOUBLE) AS pickup_longitude,
       CAST(pickup_latitude AS DOUBLE) AS pickup_latitude, CAST(dropoff_longitude AS DOUBLE) AS dropoff_longitude,
       CAST(dropoff_latitude AS DOUBLE) AS dropoff_latitude, payment_type, tolls_amount, total_amount,
       CAST(isodow(tpep_pickup_datetime) - 1 AS INTEGER) AS dayofweek,
       CAST(CASE WHEN hour(tpep_pickup_datetime) >= 7 THEN hour(tpep_pickup_datetime) - 7
                 ELSE hour(tpep_pickup_datetime) + 17 END AS INTEGER) AS lighthour,
       CAST(floor(date_diff('microsecond', tpep_pickup_datetime, tpep_dropoff_datetime) / 1000000.0) AS BIGINT)
         AS duration,
       CAST(payment_type = 1 AS INTEGER) AS credit_card,
       CAST(payment_type = 2 AS INTEGER) AS cash
FROM clean""",
        "mean_card_tip": with_(TRIPS, CLEAN_TRIPS) + """
SELECT CAST(sum(CASE WHEN payment_type = 1 THEN tip_amount END) AS DOUBLE)
       / nullif(CAST(count(CASE WHEN payment_type = 1 AND tip_amount <> 0 THEN 1 END) AS DOUBLE), 0) AS mean_card_tip
FROM clean""",
    }


def generate_sql(seed: int = 7) -> str:
    """Points 0..10000 by MD5 of seed:key:axis over the customer keys."""
    def axis(a: int) -> str:
        return f"CAST(('0x' || substr(md5('{seed}:' || c_custkey || ':{a}'), 1, 13))::BIGINT % 10001 AS INTEGER)"
    return f"SELECT c_custkey AS pid, {axis(0)} AS x, {axis(1)} AS y FROM customer"


def generate_seeds_sql(k: int, seed: int = 8) -> str:
    return generate_sql(seed) + f" ORDER BY c_custkey LIMIT {k}"


def lines_sql() -> dict[str, str]:
    """Delimited lines, formatted and read back (malformed ones among them)."""
    line = "concat_ws(',', id::VARCHAR, coalesce(name, ''), coalesce(nationality, ''), coalesce(country_code::VARCHAR, ''), coalesce(hobby, ''))"
    return {
        "format_people_lines": with_(PEOPLE) + f"SELECT {line} AS value FROM people",
        "parse_assignment_lines": """
SELECT CASE WHEN t THEN y END AS cx, CASE WHEN t THEN x END AS cy, CASE WHEN t AND g THEN x END AS x,
       CASE WHEN t THEN y END AS y, NOT (t AND g) AS skipped
FROM (SELECT CAST(c_nationkey * 400 AS INTEGER) AS x, CAST(floor((c_acctbal + 1000) * 10 / 11) AS INTEGER) AS y,
             c_custkey % 11 <> 5 AS t, c_custkey % 7 <> 3 AS g FROM customer) p""",
    }


def files_sql() -> dict[str, str]:
    """What the readers give for the lines of :mod:`tessera.plans.files`."""
    return {
        "parse_people_lines": with_(PEOPLE) + """
SELECT CASE WHEN id % 9 <> 0 THEN CAST(id AS INTEGER) END AS id,
       CASE WHEN id % 9 = 0 THEN id::VARCHAR ELSE name END AS name,
       CASE WHEN id % 9 = 0 THEN name WHEN id % 9 <> 1 THEN nationality END AS nationality,
       CASE WHEN id % 9 > 1 THEN CAST(country_code AS INTEGER) END AS country_code,
       CASE WHEN id % 9 = 0 THEN country_code::VARCHAR WHEN id % 9 <> 1 THEN hobby END AS hobby
FROM people""",
        "file_logs": with_(LOGS) + """
SELECT CASE WHEN acc_id % 9 <> 0 THEN CAST(acc_id AS INTEGER) END AS acc_id,
       CAST(CASE WHEN acc_id % 9 = 0 THEN acc_id ELSE by_who END AS INTEGER) AS by_who,
       CAST(CASE WHEN acc_id % 9 = 0 THEN by_who WHEN acc_id % 9 <> 1 THEN what_page END AS INTEGER) AS what_page,
       CASE WHEN acc_id % 9 = 0 THEN what_page::VARCHAR WHEN acc_id % 9 <> 1 THEN type_of_access END AS type_of_access,
       CASE WHEN acc_id % 9 = 0 THEN type_of_access WHEN acc_id % 9 <> 1 THEN access_time END AS access_time
FROM logs""",
        "file_associates": with_(ASSOCIATES) + """
SELECT CAST(rel_id AS INTEGER) AS rel_id, CAST(person_a AS INTEGER) AS person_a, CAST(person_b AS INTEGER) AS person_b,
       CAST(NULL AS VARCHAR) AS date_of_relation, CAST(NULL AS VARCHAR) AS description FROM associates""",
        "bad_lines": with_(LOGS) + """
SELECT file, reason, nulls, count(*) AS lines FROM (
  SELECT 'people' AS file, CASE c_custkey % 9 WHEN 0 THEN 'extra field' ELSE 'missing field' END AS reason,
         CASE c_custkey % 9 WHEN 0 THEN 'id;country_code' ELSE 'nationality;country_code;hobby' END AS nulls
  FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 9 IN (0, 1)
  UNION ALL
  SELECT 'logs', CASE acc_id % 9 WHEN 0 THEN 'extra field' ELSE 'missing field' END,
         CASE acc_id % 9 WHEN 0 THEN concat_ws(';', 'acc_id', CASE WHEN by_who IS NULL THEN 'what_page' END,
             CASE WHEN what_page IS NULL THEN 'type_of_access' END)
           ELSE concat_ws(';', CASE WHEN by_who IS NULL THEN 'by_who' END, 'what_page;type_of_access;access_time') END
  FROM logs WHERE acc_id % 9 IN (0, 1)) t
GROUP BY file, reason, nulls""",
        "centroid_lines_nd": """
SELECT CASE WHEN vec_id % 10 <> 3 THEN CAST(vec_id AS INTEGER) END AS cid, vec_id % 10 NOT IN (3, 4, 5) AS valid,
       CASE WHEN vec_id % 10 NOT IN (3, 4, 5) THEN CAST(j AS INTEGER) END AS dim,
       CASE WHEN vec_id % 10 NOT IN (3, 4, 5) THEN round(CAST(embedding[j] AS DOUBLE), 6) END AS value
FROM (SELECT vec_id, embedding, unnest(CASE WHEN vec_id % 10 IN (3, 4, 5) THEN [1] ELSE range(1, len(embedding) + 1) END) AS j
      FROM embeddings) e""",
        "file_trips": with_(TRIPS) + "SELECT * FROM trips",
    }
