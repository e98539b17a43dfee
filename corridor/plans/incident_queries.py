"""Queries over `raw_incidents` (and zone statuses): validate, normalize, transform, filter, GeoJSON."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from corridor.operators import incidents as inc
from corridor.operators import kpis, spatial, transform, validate
from corridor.plans.catalog import register
from corridor.plans.views import duck_with, view

# Viewport (min_lon, min_lat, max_lon, max_lat) and severity filter.
INCIDENT_BOX = (-122.45, 37.72, -122.35, 37.76)
_BOX_SQL = "longitude BETWEEN -12245e-2 AND -12235e-2 AND latitude BETWEEN 3772e-2 AND 3776e-2"
SEVERITY_FILTER = "high"


def validated_incidents(spark, sf, box=None):
    raw = view(spark, sf, "raw_incidents")
    if box is not None:
        raw = inc.raw_in_box(raw, box)
    return validate.validate_incident(raw, ts="created_at", keep=("incident_id",)).valid


def incident_table(spark, sf, box=None):
    return transform.transform_incident(validated_incidents(spark, sf, box), ts="created_at", keep=["incident_id"])


def _clean(c: str) -> str:
    return f"lower(regexp_replace({c}, '^\\s+|\\s+$', '', 'g'))"


_SEV = f"""CASE WHEN severity IS NULL THEN 'medium'
  WHEN {_clean('severity')} IN ('low', 'medium', 'high', 'critical') THEN {_clean('severity')}
  WHEN {_clean('severity')} LIKE '%minor%' OR {_clean('severity')} LIKE '%light%' THEN 'low'
  WHEN {_clean('severity')} LIKE '%major%' OR {_clean('severity')} LIKE '%severe%' THEN 'high'
  WHEN {_clean('severity')} LIKE '%block%' OR {_clean('severity')} LIKE '%fatal%'
    OR {_clean('severity')} LIKE '%extreme%' THEN 'critical'
  ELSE 'medium' END"""

_STATUS = f"""CASE WHEN status IS NULL THEN 'active'
  WHEN {_clean('status')} IN ('active', 'resolved', 'cleared') THEN {_clean('status')}
  WHEN {_clean('status')} LIKE '%open%' OR {_clean('status')} LIKE '%report%' THEN 'active'
  WHEN {_clean('status')} LIKE '%close%' OR {_clean('status')} LIKE '%end%' THEN 'resolved'
  WHEN {_clean('status')} LIKE '%clear%' OR {_clean('status')} LIKE '%done%' THEN 'cleared'
  ELSE 'active' END"""

IV_SQL = duck_with("raw_incidents").rstrip() + f""",
iv AS (SELECT incident_id, incident_type, description, latitude, longitude, {_SEV} AS severity,
    {_STATUS} AS status, created_at FROM raw_incidents
  WHERE incident_type IS NOT NULL AND length(incident_type) >= 1
    AND latitude IS NOT NULL AND NOT isnan(latitude) AND latitude BETWEEN -9e1 AND 9e1
    AND longitude IS NOT NULL AND NOT isnan(longitude) AND longitude BETWEEN -18e1 AND 18e1),
it AS (SELECT incident_id, incident_type,
    COALESCE(NULLIF(description, ''), 'Traffic incident of type: ' || incident_type) AS description,
    longitude, latitude,
    'SRID=4326;POINT(' || CAST(longitude AS VARCHAR) || ' ' || CAST(latitude AS VARCHAR) || ')' AS geometry,
    severity, status, created_at, created_at AS updated_at FROM iv)
"""


@register("incident_validate", IV_SQL + "SELECT * FROM iv")
def q_incident_validate(spark, sf):
    return validated_incidents(spark, sf)


@register("severity_normalize", IV_SQL + "SELECT incident_id, severity FROM iv")
def q_severity_normalize(spark, sf):
    return validated_incidents(spark, sf).select("incident_id", "severity")


@register("status_normalize", IV_SQL + "SELECT incident_id, status FROM iv")
def q_status_normalize(spark, sf):
    return validated_incidents(spark, sf).select("incident_id", "status")


@register("incident_transform", IV_SQL + "SELECT * FROM it")
def q_incident_transform(spark, sf):
    return incident_table(spark, sf)


@register("incidents_in_viewport", IV_SQL + f"SELECT incident_id, severity, status, longitude, latitude "
          f"FROM it WHERE {_BOX_SQL}")
def q_incidents_in_viewport(spark, sf):
    t = incident_table(spark, sf, INCIDENT_BOX).select("incident_id", "severity", "status", "longitude", "latitude")
    return spatial.within_box(t, INCIDENT_BOX)


_ACTIVE_COLS = "incident_id, incident_type, description, severity, status, created_at, updated_at, longitude, latitude"


@register("active_incidents", IV_SQL + f"SELECT {_ACTIVE_COLS} FROM it WHERE status = 'active'")
def q_active_incidents(spark, sf):
    return inc.active_incidents(incident_table(spark, sf)).select(*_ACTIVE_COLS.split(", "))


@register("active_incidents_filtered", IV_SQL + f"SELECT {_ACTIVE_COLS} FROM it WHERE status = 'active' "
          f"AND severity = '{SEVERITY_FILTER}' AND {_BOX_SQL}")
def q_active_incidents_filtered(spark, sf):
    t = incident_table(spark, sf, INCIDENT_BOX)
    return inc.active_incidents(t, severity=SEVERITY_FILTER, box=INCIDENT_BOX).select(*_ACTIVE_COLS.split(", "))


_PARSED = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("geometry", T.StructType([T.StructField("type", T.StringType()),
                                            T.StructField("coordinates", T.ArrayType(T.DoubleType()))])),
    T.StructField("properties", T.StructType([
        T.StructField("id", T.LongType()), T.StructField("incident_type", T.StringType()),
        T.StructField("description", T.StringType()), T.StructField("severity", T.StringType()),
        T.StructField("status", T.StringType()), T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("updated_at", T.TimestampNTZType())])),
])


@register("incident_geojson", IV_SQL + "SELECT incident_id, 'Feature' AS feature_type, 'Point' AS geometry_type, "
          "longitude AS lon, latitude AS lat, incident_type, description, severity, status, created_at "
          "FROM it WHERE status = 'active'")
def q_incident_geojson(spark, sf):
    """Active incidents as GeoJSON Feature text, read back into columns.

    Reading the emitted JSON back checks the text itself while keeping the
    comparison numeric (engines print doubles differently).
    """
    # Row-per-feature output: no presentation sort (a sort is a range shuffle).
    t = incident_table(spark, sf).filter(inc.incident_filters())
    props = {"id": F.col("incident_id"), "incident_type": F.col("incident_type"),
             "description": F.col("description"), "severity": F.col("severity"),
             "status": F.col("status"), "created_at": F.col("created_at"), "updated_at": F.col("updated_at")}
    feats = t.select(inc.point_feature(F.col("longitude"), F.col("latitude"), props).alias("feature"))
    p = feats.select(F.from_json("feature", _PARSED).alias("f"))
    return p.select(F.col("f.properties.id").alias("incident_id"), F.col("f.type").alias("feature_type"),
                    F.col("f.geometry.type").alias("geometry_type"),
                    F.col("f.geometry.coordinates")[0].alias("lon"), F.col("f.geometry.coordinates")[1].alias("lat"),
                    "f.properties.incident_type", "f.properties.description", "f.properties.severity",
                    "f.properties.status", "f.properties.created_at")


@register("incident_kpis", IV_SQL + "SELECT CAST(COUNT(*) FILTER (WHERE status = 'active') AS BIGINT) AS active, "
          "CAST(COUNT(*) FILTER (WHERE status = 'active' AND severity = 'critical') AS BIGINT) AS critical, "
          "CAST(COUNT(*) FILTER (WHERE status = 'cleared') AS BIGINT) AS cleared FROM it")
def q_incident_kpis(spark, sf):
    """Dashboard incident counters in one aggregate: active, active critical, cleared."""
    return kpis.incident_kpis(incident_table(spark, sf))
