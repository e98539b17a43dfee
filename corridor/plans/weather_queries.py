"""Queries over the `weather` view: validate, alias, transform, nearest, distance, EWKT."""

from __future__ import annotations

from pyspark.sql import functions as F

from corridor.functions import geometry as geo
from corridor.functions.geodesy import spheroid_distance_m
from corridor.functions.numeric import rnd
from corridor.operators import spatial, transform, validate
from corridor.plans.catalog import register, rnd_sql
from corridor.plans.views import duck_with, view

# The query point of the nearest-weather lookup (lon, lat).
QUERY_LON, QUERY_LAT = -122.42, 37.75
_QLON, _QLAT = "-12242e-2", "3775e-2"

WEATHER_COLS = ["snapshot_id", "latitude", "longitude", "temperature", "rain_intensity",
                "visibility", "observed_at"]


def validated_weather(spark, sf):
    return validate.validate_weather(view(spark, sf, "weather"), ts="observed_at",
                                     keep=("snapshot_id",)).valid


def weather_table(spark, sf):
    """Loaded weather snapshots: validated, then transformed (rain NULL -> 0)."""
    return transform.transform_weather(validated_weather(spark, sf), ts="observed_at", keep=["snapshot_id"])


# Validated weather in SQL: range rules, precipitation alias.
WV_SQL = duck_with("weather").rstrip() + """,
wv AS (SELECT snapshot_id, latitude, longitude, temperature,
    COALESCE(rain_intensity, precipitation) AS rain_intensity, CAST(NULL AS DOUBLE) AS visibility, observed_at
  FROM weather
  WHERE latitude IS NOT NULL AND NOT isnan(latitude) AND latitude BETWEEN -9e1 AND 9e1
    AND longitude IS NOT NULL AND NOT isnan(longitude) AND longitude BETWEEN -18e1 AND 18e1
    AND (COALESCE(rain_intensity, precipitation) IS NULL
         OR (NOT isnan(COALESCE(rain_intensity, precipitation)) AND COALESCE(rain_intensity, precipitation) >= 0))),
wt AS (SELECT snapshot_id, latitude, longitude,
    'SRID=4326;POINT(' || CAST(longitude AS VARCHAR) || ' ' || CAST(latitude AS VARCHAR) || ')' AS geometry,
    temperature, COALESCE(rain_intensity, 0e0) AS rain_intensity, visibility, observed_at FROM wv)
"""


@register("weather_validate", WV_SQL + "SELECT * FROM wv")
def q_weather_validate(spark, sf):
    return validated_weather(spark, sf).select(*WEATHER_COLS)


@register("rain_alias", WV_SQL + "SELECT snapshot_id, rain_intensity FROM wv")
def q_rain_alias(spark, sf):
    return validated_weather(spark, sf).select("snapshot_id", "rain_intensity")


@register("weather_transform", WV_SQL + "SELECT * FROM wt")
def q_weather_transform(spark, sf):
    return weather_table(spark, sf)


@register("ewkt_point", WV_SQL + "SELECT snapshot_id, geometry AS ewkt FROM wt")
def q_ewkt_point(spark, sf):
    w = validated_weather(spark, sf)
    return w.select("snapshot_id", geo.ewkt_point(F.col("longitude"), F.col("latitude")).alias("ewkt"))


_NEAREST_ORDER = (f"(longitude - {_QLON}) * (longitude - {_QLON}) + (latitude - {_QLAT}) * (latitude - {_QLAT}), "
                  "observed_at DESC, snapshot_id")


@register("nearest_weather", WV_SQL + "SELECT snapshot_id, latitude, longitude, temperature, rain_intensity, "
          f"visibility, observed_at FROM wt ORDER BY {_NEAREST_ORDER} LIMIT 1")
def q_nearest_weather(spark, sf):
    w = weather_table(spark, sf).select(*WEATHER_COLS)
    return spatial.nearest_to_point(w, QUERY_LON, QUERY_LAT, ts="observed_at", tiebreak="snapshot_id")


def _haversine_sql(lon: str, lat: str, lon0: str, lat0: str) -> str:
    return (f"(2e0 * 63710088e-1 * asin(sqrt(pow(sin(radians({lat0} - {lat}) / 2), 2) + "
            f"cos(radians({lat})) * cos(radians({lat0})) * pow(sin(radians({lon0} - {lon}) / 2), 2))))")


@register("weather_distance", WV_SQL + "SELECT snapshot_id, "
          f"{rnd_sql(_haversine_sql('longitude', 'latitude', _QLON, _QLAT), 3)} AS distance_m FROM wt")
def q_weather_distance(spark, sf):
    """Great-circle distance (m) from the query point to every snapshot."""
    w = weather_table(spark, sf)
    d = geo.haversine_m(F.col("longitude"), F.col("latitude"), F.lit(QUERY_LON), F.lit(QUERY_LAT))
    return w.select("snapshot_id", rnd(d, 3).alias("distance_m"))


def _vincenty_sql(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    """Vincenty's inverse formula as a recursive CTE over one row (``nw``).

    The iteration mirrors ``functions.geodesy.vincenty_np``: lambda is updated
    until it moves less than 1e-12; the final row's terms give the distance.
    """
    a, f = "6378137e0", "(1e0 / 298257223563e-9)"
    b = f"((1e0 - {f}) * {a})"
    return f"""geo0 AS (SELECT radians({lon2} - {lon1}) AS L,
    atan((1e0 - {f}) * tan(radians({lat1}))) AS U1, atan((1e0 - {f}) * tan(radians({lat2}))) AS U2 FROM nw),
geo1 AS (SELECT L, sin(U1) AS sU1, cos(U1) AS cU1, sin(U2) AS sU2, cos(U2) AS cU2 FROM geo0),
it(k, lam, L, sU1, cU1, sU2, cU2, sS, cS, sig, cA2, c2m, done) AS (
  SELECT 0, L, L, sU1, cU1, sU2, cU2, 0e0, 0e0, 0e0, 0e0, 0e0, false FROM geo1
  UNION ALL
  SELECT k + 1, nl, L, sU1, cU1, sU2, cU2, sS, cS, sig, cA2, c2m, abs(nl - lam) < 1e-12 FROM (
    SELECT *, L + (1e0 - C) * {f} * sA * (sig + C * sS * (c2m + C * cS * (-1e0 + 2e0 * c2m * c2m))) AS nl FROM (
      SELECT *, {f} / 16e0 * cA2 * (4e0 + {f} * (4e0 - 3e0 * cA2)) AS C FROM (
        SELECT *, CASE WHEN cA2 = 0 THEN 0e0 ELSE cS - 2e0 * sU1 * sU2 / cA2 END AS c2m FROM (
          SELECT *, 1e0 - sA * sA AS cA2 FROM (
            SELECT *, CASE WHEN sS = 0 THEN 0e0 ELSE cU1 * cU2 * sin(lam) / sS END AS sA FROM (
              SELECT *, atan2(sS, cS) AS sig FROM (
                SELECT k, lam, L, sU1, cU1, sU2, cU2,
                  sqrt(pow(cU2 * sin(lam), 2) + pow(cU1 * sU2 - sU1 * cU2 * cos(lam), 2)) AS sS,
                  sU1 * sU2 + cU1 * cU2 * cos(lam) AS cS FROM it WHERE NOT done AND k < 200) t1) t2) t3) t4) t5) t6) t7),
fin AS (SELECT * FROM it WHERE done ORDER BY k LIMIT 1),
dist AS (SELECT CASE WHEN sS = 0 THEN 0e0 ELSE {b} * A * (sig - dS) END AS s FROM (
  SELECT *, Bc * sS * (c2m + Bc / 4e0 * (cS * (-1e0 + 2e0 * c2m * c2m)
      - Bc / 6e0 * c2m * (-3e0 + 4e0 * sS * sS) * (-3e0 + 4e0 * c2m * c2m))) AS dS FROM (
    SELECT *, 1e0 + u2 / 16384e0 * (4096e0 + u2 * (-768e0 + u2 * (320e0 - 175e0 * u2))) AS A,
      u2 / 1024e0 * (256e0 + u2 * (-128e0 + u2 * (74e0 - 47e0 * u2))) AS Bc FROM (
      SELECT *, cA2 * ({a} * {a} - {b} * {b}) / ({b} * {b}) AS u2 FROM fin) x) y) z)
"""


@register("nearest_weather_geodesic", WV_SQL.replace("WITH ", "WITH RECURSIVE ", 1).rstrip() + ",\n" +
          "nw AS (SELECT snapshot_id, latitude, longitude, temperature, rain_intensity, visibility, observed_at "
          f"FROM wt ORDER BY {_NEAREST_ORDER} LIMIT 1),\n" +
          _vincenty_sql("longitude", "latitude", _QLON, _QLAT) +
          f"SELECT nw.*, {rnd_sql('dist.s', 3)} AS distance_meters FROM nw, dist")
def q_nearest_weather_geodesic(spark, sf):
    """The nearest snapshot with its spheroid (WGS84) distance in metres (to the mm).

    Planar order picks the row; the Arrow UDF then runs on that one row.
    The oracle iterates the same formula in a recursive CTE.
    """
    w = weather_table(spark, sf).select(*WEATHER_COLS)
    best = spatial.nearest_to_point(w, QUERY_LON, QUERY_LAT, ts="observed_at", tiebreak="snapshot_id")
    d = spheroid_distance_m(F.col("longitude"), F.col("latitude"), F.lit(QUERY_LON), F.lit(QUERY_LAT))
    return best.withColumn("distance_meters", rnd(d, 3))
