"""Derived input views over the driver's tables (see FIXTURES.md §B).

No driver table is about roads, so road data is derived by arithmetic. The
same SQL text is used by Spark (tables bound as DataFrames through
``spark.sql(text, **frames)``) and by the DuckDB oracle (tables bound by
name), so both engines see identical inputs. Every view is a projection or
filter of one base table: its size grows with the base table.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
               "lineitem", "events", "documents", "embeddings", "pages",
               "benchmark", "labels", "conversations")

# The fixture definitions of FIXTURES.md §B, plus our own
# `incoming_segments` (an upsert batch derived from supplier).
VIEW_SQL: dict[str, str] = {
    "readings": """
SELECT event_id AS reading_id, user_id AS segment_id,
  value + CAST(event_id % 997 AS DOUBLE) / 1e5 AS current_speed,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(event_id % 101 AS DOUBLE) / 1e2 END AS congestion_score,
  ts AS reading_ts FROM {events}""",
    "raw_traffic": """
SELECT event_id AS ordinal,
  CASE WHEN event_id % 23 = 0 THEN 'x' ELSE CAST(user_id AS STRING) END AS segment_id,
  CASE WHEN event_id % 17 = 0 THEN 'bad' WHEN event_id % 19 = 0 THEN '-1.5' ELSE CAST(value AS STRING) END AS current_speed,
  CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 29 = 0 THEN 15e-1 ELSE CAST(event_id % 101 AS DOUBLE) / 1e2 END AS congestion_score,
  date_trunc('hour', ts) AS reading_ts FROM {events}""",
    "segments": """
SELECT c_custkey AS segment_id, c_custkey + 100000 AS osm_id,
  CASE WHEN c_custkey % 7 = 0 THEN '' ELSE c_name END AS name,
  CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(30 + 10 * (c_custkey % 9) AS INT) END AS speed_limit,
  CASE WHEN c_custkey % 13 = 0 THEN 0e0 ELSE 25e1 + 25e0 * CAST(c_custkey % 200 AS DOUBLE) END AS length,
  -1225e-1 + CAST(c_custkey % 40 AS DOUBLE) / 2e2 AS x0,
  377e-1 + CAST(c_custkey % 37 AS DOUBLE) / 3e2 AS y0,
  -1225e-1 + CAST(c_custkey % 40 + c_custkey % 5 - 2 AS DOUBLE) / 2e2 AS x1,
  377e-1 + CAST(c_custkey % 37 + c_custkey % 3 - 1 AS DOUBLE) / 3e2 AS y1,
  -1225e-1 + CAST(c_custkey % 40 + c_custkey % 4 AS DOUBLE) / 2e2 AS x2,
  377e-1 + CAST(c_custkey % 37 - c_custkey % 6 AS DOUBLE) / 3e2 AS y2
FROM {customer}""",
    "small_segments": """
SELECT s_suppkey AS segment_id, s_name AS name FROM {supplier}""",
    "weather": """
SELECT event_id AS snapshot_id,
  377e-1 + CAST(user_id % 5 AS DOUBLE) / 4e1 AS latitude,
  -1225e-1 + CAST(user_id % 25 AS DOUBLE) / 1e2 AS longitude,
  CASE WHEN event_id % 10 = 0 THEN NULL ELSE CAST(event_id % 350 AS DOUBLE) / 1e1 END AS temperature,
  CASE WHEN event_id % 4 = 0 THEN NULL ELSE CAST(event_id % 80 AS DOUBLE) / 1e1 END AS rain_intensity,
  CASE WHEN event_id % 4 = 0 THEN CAST(event_id % 60 AS DOUBLE) / 1e1 ELSE NULL END AS precipitation,
  ts AS observed_at FROM {events}""",
    # Stations that nearly all stand at a place of their own, most of them in one city, the rest far and wide.
    "weather_spread": """
SELECT event_id AS snapshot_id,
  CASE WHEN event_id % 7 = 0 THEN -8e1 + CAST(event_id * 7919 % 160001 AS DOUBLE) / 1e3
       ELSE 377e-1 + CAST(event_id * 7919 % 100003 AS DOUBLE) / 8e5 END AS latitude,
  CASE WHEN event_id % 7 = 0 THEN -17e1 + CAST(event_id * 104729 % 340007 AS DOUBLE) / 1e3
       ELSE -1225e-1 + CAST(event_id * 104729 % 100019 AS DOUBLE) / 4e5 END AS longitude,
  CAST(event_id % 350 AS DOUBLE) / 1e1 AS temperature, CAST(event_id % 80 AS DOUBLE) / 1e1 AS rain_intensity,
  ts AS observed_at FROM {events}""",
    "raw_incidents": """
SELECT o_orderkey AS incident_id,
  CASE o_orderkey % 4 WHEN 0 THEN 'accident' WHEN 1 THEN 'debris' WHEN 2 THEN 'congestion' ELSE 'hazard' END AS incident_type,
  CASE WHEN o_orderkey % 5 = 0 THEN '' WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderpriority END AS description,
  CASE o_orderkey % 9 WHEN 0 THEN 'Minor spill' WHEN 1 THEN 'SEVERE' WHEN 2 THEN 'fatal crash' WHEN 3 THEN ' High '
    WHEN 4 THEN 'lane blocked' WHEN 5 THEN 'slight' WHEN 6 THEN '4' WHEN 7 THEN 'critical' ELSE NULL END AS severity,
  CASE o_orderkey % 7 WHEN 0 THEN 'OPEN' WHEN 1 THEN 'closed' WHEN 2 THEN 'Clearing' WHEN 3 THEN 'active'
    WHEN 4 THEN 'pending' WHEN 5 THEN 'reported' ELSE NULL END AS status,
  377e-1 + CAST(o_orderkey % 61 AS DOUBLE) / 5e2 AS latitude,
  -1225e-1 + CAST(o_orderkey % 83 AS DOUBLE) / 4e2 AS longitude,
  o_orderdate AS created_at FROM {orders}""",
    "raw_construction": """
SELECT p_partkey AS zone_id, CASE WHEN p_partkey % 4 = 0 THEN '' ELSE p_name END AS description,
  CASE p_partkey % 5 WHEN 0 THEN 'polyline' WHEN 1 THEN ' Polygon' WHEN 2 THEN 'LINESTRING' WHEN 3 THEN 'MultiPolygon' ELSE 'circle' END AS geometry_type,
  -1225e-1 + CAST(p_partkey % 50 AS DOUBLE) / 1e2 AS x, 377e-1 + CAST(p_partkey % 30 AS DOUBLE) / 1e2 AS y,
  CASE p_partkey % 3 WHEN 0 THEN 'planned' WHEN 1 THEN 'active' ELSE 'paused' END AS status,
  DATE '2024-01-01' + CAST(p_partkey % 90 AS INT) AS start_date FROM {part}""",
    "training": """
SELECT l_orderkey, l_linenumber, l_quantity * 1e2 AS length,
  CAST(30 + 10 * (l_suppkey % 9) AS DOUBLE) AS speed_limit, l_discount * 1e1 AS congestion_score,
  l_tax * 1e2 AS rain_intensity, CAST(l_partkey % 35 AS DOUBLE) AS temperature,
  CASE WHEN l_returnflag = 'R' THEN NULL
       ELSE l_quantity * 1e2 / (CAST(30 + 10 * (l_suppkey % 9) AS DOUBLE) / 36e-1)
            * (12e-1 + 25e-1 * l_discount * 1e1 + 1e-1 * l_tax * 1e2) END AS actual_time
FROM {lineitem}""",
    # Prediction requests, some with a value missing or outside its range.
    "requests": """
SELECT l_orderkey, l_linenumber,
  CASE WHEN l_orderkey % 11 = 0 THEN NULL WHEN l_orderkey % 13 = 0 THEN 0e0 ELSE l_quantity * 1e2 END AS length,
  CASE WHEN l_partkey % 17 = 0 THEN -3e1 ELSE CAST(30 + 10 * (l_suppkey % 9) AS DOUBLE) END AS speed_limit,
  CASE WHEN l_partkey % 7 = 0 THEN l_discount * 1e1 + 1e0 ELSE l_discount * 1e1 END AS congestion_score,
  CASE WHEN l_suppkey % 5 = 0 THEN NULL WHEN l_suppkey % 19 = 0 THEN -1e0 ELSE l_tax * 1e2 END AS rain_intensity,
  CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE CAST(l_partkey % 35 AS DOUBLE) END AS temperature
FROM {lineitem}""",
    # An upsert batch keyed by osm_id: keys repeat (s % 60), so keep-last by
    # `ordinal` matters; about half the keys exist in `segments`.
    "incoming_segments": """
SELECT s_suppkey AS ordinal, s_suppkey + 10000000 AS segment_id,
  100000 + (s_suppkey % 60) * 30 AS osm_id, s_name AS name,
  CAST(40 + 10 * (s_nationkey % 5) AS INT) AS speed_limit,
  1e2 + CAST(s_nationkey AS DOUBLE) * 1e1 AS length,
  -1224e-1 + CAST(s_suppkey % 20 AS DOUBLE) / 2e2 AS x0, 377e-1 + CAST(s_suppkey % 15 AS DOUBLE) / 3e2 AS y0,
  -1224e-1 + CAST(s_suppkey % 20 + 1 AS DOUBLE) / 2e2 AS x1, 377e-1 + CAST(s_suppkey % 15 + 2 AS DOUBLE) / 3e2 AS y1,
  -1224e-1 + CAST(s_suppkey % 20 + 3 AS DOUBLE) / 2e2 AS x2, 377e-1 + CAST(s_suppkey % 15 + 1 AS DOUBLE) / 3e2 AS y2
FROM {supplier}""",
}

_PLACEHOLDER = re.compile(r"\{(\w+)\}")


def _tables_of(sql: str) -> list[str]:
    return sorted(set(_PLACEHOLDER.findall(sql)))


def duck_view(name: str) -> str:
    """The view body with table placeholders bound to DuckDB view names."""
    return VIEW_SQL[name].format(**{t: t for t in _tables_of(VIEW_SQL[name])})


def duck_ctes(*names: str) -> str:
    """``name AS (body)`` entries for the named views, comma-separated."""
    return ",\n".join(f"{n} AS ({duck_view(n)})" for n in names)


def duck_with(*names: str) -> str:
    """A ``WITH`` prefix defining the named views for an oracle query."""
    return "WITH " + duck_ctes(*names) + "\n"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Build one derived view as a lazy DataFrame over the parquet tables."""
    # Hours, days and date truncation are defined in UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    sql = VIEW_SQL[name]
    frames = {t: read_table(spark, sf_dir, t) for t in _tables_of(sql)}
    df = spark.sql(sql, **frames)
    if name == "raw_traffic":
        # date_trunc turns timestamp_ntz into timestamp in Spark; restore it.
        df = df.withColumn("reading_ts", F.col("reading_ts").cast("timestamp_ntz"))
    return df


@lru_cache(maxsize=None)
def view_names() -> tuple[str, ...]:
    return tuple(VIEW_SQL)


def construction_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`raw_construction` plus a JSON `coordinates` payload built from the id.

    Polygon-typed plans carry one ring of the first n = 3 + id % 3 corners of
    a 0.01-degree square (3 is too short, 4 is open, 5 is closed); every 7th
    carries a flat list instead (wrong nesting). Other plans carry a flat line
    of n = 1 + id % 4 points (1 is too short).
    """
    rc = view(spark, sf_dir, "raw_construction")
    zid, x, y = F.col("zone_id"), F.col("x"), F.col("y")
    poly = F.lower(F.col("geometry_type")).contains("polygon")
    nested = poly & (zid % 7 != 0)
    n = F.when(nested, F.lit(3) + zid % 3).otherwise(F.lit(1) + zid % 4).cast("int")
    k = F.sequence(F.lit(0), n - 1)
    ring = F.transform(k, lambda i: F.array(
        x + F.when(i.isin(1, 2), F.lit(1e-2)).otherwise(F.lit(0.0)),
        y + F.when(i.isin(2, 3), F.lit(1e-2)).otherwise(F.lit(0.0))))
    line = F.transform(k, lambda i: F.array(x + i.cast("double") * F.lit(1e-2),
                                            y + (i % 2).cast("double") * F.lit(1e-2)))
    coords = F.when(nested, F.to_json(F.array(ring))).otherwise(F.to_json(line))
    return rc.withColumn("coordinates", coords)
