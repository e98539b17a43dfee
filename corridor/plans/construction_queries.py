"""Queries over `raw_construction`: geometry type, nesting, ring closing, transform, EWKT."""

from __future__ import annotations

from pyspark.sql import functions as F

from corridor.functions.normalize import ZONE_STATUSES, normalize_geometry_type
from corridor.operators import integrity, kpis, transform, validate
from corridor.plans.catalog import register
from corridor.plans.views import construction_feed, duck_with


def _validated(spark, sf):
    return validate.validate_construction(construction_feed(spark, sf), keep=("zone_id",))


def zone_table(spark, sf):
    return transform.transform_construction(_validated(spark, sf).valid, keep=["zone_id"])


def loaded_zones(spark, sf):
    """Zones that pass the table's CHECK constraints (status domain, type allow-list)."""
    valid, _ = integrity.domain_check(zone_table(spark, sf), {
        "status_domain": F.col("status").isin(*ZONE_STATUSES),
        "geometry_type_domain": F.col("geometry_type").isin("LineString", "Polygon"),
    })
    return valid


CS_SQL = duck_with("raw_construction").rstrip() + """,
c AS (SELECT *,
    CASE WHEN lower(geometry_type) LIKE '%polygon%' THEN 'Polygon'
         WHEN lower(geometry_type) LIKE '%line%' THEN 'LineString' END AS gtype,
    (lower(geometry_type) LIKE '%polygon%' AND zone_id % 7 <> 0) AS nested,
    CASE WHEN lower(geometry_type) LIKE '%polygon%' AND zone_id % 7 <> 0 THEN 3 + zone_id % 3
         ELSE 1 + zone_id % 4 END AS n
  FROM raw_construction),
s AS (SELECT *, concat_ws(';',
    CASE WHEN gtype IS NULL THEN 'geometry_type_invalid' END,
    CASE WHEN gtype = 'LineString' AND (nested OR n < 2) THEN 'linestring_invalid' END,
    CASE WHEN gtype = 'Polygon' AND (NOT nested OR n < 4) THEN 'polygon_invalid' END) AS reason FROM c),
cv AS (SELECT zone_id, description, gtype AS geometry_type, status, start_date, CAST(1 AS INTEGER) AS n_rings,
    CAST(CASE WHEN gtype = 'Polygon' THEN 5 ELSE n END AS INTEGER) AS n_points, x, y, n FROM s WHERE reason = '')
"""


@register("construction_validate", CS_SQL + "SELECT zone_id, description, geometry_type, status, start_date, "
          "n_rings, n_points FROM cv")
def q_construction_validate(spark, sf):
    v = _validated(spark, sf).valid
    return v.select("zone_id", "description", "geometry_type", "status", "start_date",
                    F.size("rings").alias("n_rings"), F.size(F.col("rings")[0]).alias("n_points"))


@register("construction_rejects", CS_SQL + "SELECT zone_id, reason FROM s WHERE reason <> ''")
def q_construction_rejects(spark, sf):
    return _validated(spark, sf).rejected.select("zone_id", "reason")


@register("geometry_type_normalize", CS_SQL + "SELECT zone_id, gtype AS geometry_type FROM c")
def q_geometry_type_normalize(spark, sf):
    raw = construction_feed(spark, sf)
    return raw.select("zone_id", normalize_geometry_type(raw, "geometry_type").alias("geometry_type"))


@register("polygon_close", CS_SQL + "SELECT zone_id, n_points, x AS first_x, y AS first_y, x AS last_x, "
          "y AS last_y FROM cv WHERE geometry_type = 'Polygon'")
def q_polygon_close(spark, sf):
    v = _validated(spark, sf).valid.filter(F.col("geometry_type") == "Polygon")
    r = F.col("rings")[0]
    return v.select("zone_id", F.size(r).alias("n_points"), r[0].x.alias("first_x"), r[0].y.alias("first_y"),
                    F.element_at(r, -1).x.alias("last_x"), F.element_at(r, -1).y.alias("last_y"))


@register("construction_transform", CS_SQL + """SELECT zone_id,
    COALESCE(NULLIF(description, ''), 'Active construction zone') AS description, geometry_type, status,
    start_date, CAST(NULL AS DATE) AS end_date, n_points, x AS min_x, y AS min_y,
    CASE WHEN geometry_type = 'Polygon' THEN x + 1e-2 ELSE x + CAST(n - 1 AS DOUBLE) * 1e-2 END AS max_x,
    CASE WHEN geometry_type = 'Polygon' OR n >= 2 THEN y + 1e-2 ELSE y END AS max_y FROM cv""")
def q_construction_transform(spark, sf):
    z = zone_table(spark, sf)
    return z.select("zone_id", "description", "geometry_type", "status", "start_date", "end_date",
                    F.size(F.col("rings")[0]).alias("n_points"), "min_x", "min_y", "max_x", "max_y")


def _v(e: str) -> str:
    return f"CAST({e} AS VARCHAR)"


@register("ewkt_polygon", CS_SQL + "SELECT zone_id, 'SRID=4326;POLYGON((' || "
          f"{_v('x')} || ' ' || {_v('y')} || ', ' || {_v('x + 1e-2')} || ' ' || {_v('y')} || ', ' || "
          f"{_v('x + 1e-2')} || ' ' || {_v('y + 1e-2')} || ', ' || {_v('x')} || ' ' || {_v('y + 1e-2')} || ', ' || "
          f"{_v('x')} || ' ' || {_v('y')} || '))' AS ewkt FROM cv WHERE geometry_type = 'Polygon'")
def q_ewkt_polygon(spark, sf):
    return zone_table(spark, sf).filter(F.col("geometry_type") == "Polygon") \
        .select("zone_id", F.col("geometry").alias("ewkt"))


@register("zone_domain_rejects", CS_SQL + "SELECT zone_id, 'status_domain' AS reason FROM cv "
          "WHERE status NOT IN ('planned', 'active', 'completed')")
def q_zone_domain_rejects(spark, sf):
    _, rejected = integrity.domain_check(zone_table(spark, sf), {
        "status_domain": F.col("status").isin(*ZONE_STATUSES),
        "geometry_type_domain": F.col("geometry_type").isin("LineString", "Polygon"),
    })
    return rejected.select("zone_id", "reason")


def _feed_counts_sql() -> str:
    from corridor.plans.incident_queries import IV_SQL
    inc = IV_SQL.rstrip()
    zones = CS_SQL.replace("WITH raw_construction AS", "raw_construction AS", 1).rstrip()
    return (inc + ",\n" + zones + "\n"
            "SELECT 'incidents' AS feed, status, COUNT(*) AS n FROM it GROUP BY status UNION ALL "
            "SELECT 'construction' AS feed, status, COUNT(*) AS n FROM cv "
            "WHERE status IN ('planned', 'active', 'completed') GROUP BY status")


@register("feed_status_counts", _feed_counts_sql())
def q_feed_status_counts(spark, sf):
    """Rows per (feed, status) for the incident and construction tables."""
    from corridor.plans.incident_queries import incident_table
    return kpis.status_counts(incidents=incident_table(spark, sf), construction=loaded_zones(spark, sf))
