"""Queries over `segments` (+ readings, weather): upsert, geometry, latest, viewport, KNN, scoring."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from corridor.functions import geometry as geo
from corridor.functions.numeric import rnd
from corridor.operators import integrity, kpis, latest, segments as sg, spatial
from corridor.operators.incidents import line_feature
from corridor.plans.catalog import avg_sql, register, rnd_sql
from corridor.plans.views import duck_ctes, duck_with, view
from corridor.plans.weather_queries import WV_SQL, weather_table

# Fixed value: the map viewport (min_lon, min_lat, max_lon, max_lat).
VIEWPORT = (-122.44, 37.74, -122.36, 37.78)
_VB = ("-12244e-2", "3774e-2", "-12236e-2", "3778e-2")
_XY = ("x0", "y0", "x1", "y1", "x2", "y2")


def segment_table(spark, sf):
    """Segments with their line as ``pts`` and bbox columns (the stored layout)."""
    s = view(spark, sf, "segments")
    pts = geo.line_from_columns(*_XY)
    s = s.withColumn("pts", pts)
    mnx, mny, mxx, mxy = geo.bbox(F.col("pts"))
    return s.select("segment_id", "osm_id", "name", "speed_limit", "length", "pts",
                    mnx.alias("min_x"), mny.alias("min_y"), mxx.alias("max_x"), mxy.alias("max_y"))


def _weather_for_join(spark, sf):
    return weather_table(spark, sf).select("snapshot_id", "longitude", "latitude", "temperature",
                                           "rain_intensity", "observed_at")


# ---- upsert / integrity --------------------------------------------------

_SEG_COLS = "segment_id, osm_id, name, speed_limit, length, x0, y0, x1, y1, x2, y2"
_INC_COLS = "s.segment_id, i.osm_id, i.name, i.speed_limit, i.length, i.x0, i.y0, i.x1, i.y1, i.x2, i.y2"


@register("segment_upsert", duck_with("segments", "incoming_segments").rstrip() + f""",
inc AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY osm_id ORDER BY ordinal DESC) AS rn
                       FROM incoming_segments) t WHERE rn = 1)
SELECT {_INC_COLS} FROM segments s JOIN inc i ON s.osm_id = i.osm_id
UNION ALL SELECT {_SEG_COLS} FROM segments WHERE osm_id NOT IN (SELECT osm_id FROM inc)
UNION ALL SELECT {_SEG_COLS} FROM inc WHERE osm_id NOT IN (SELECT osm_id FROM segments)""")
def q_segment_upsert(spark, sf):
    return sg.upsert(view(spark, sf, "segments"), view(spark, sf, "incoming_segments"))


@register("duplicate_osm_ids", duck_with("incoming_segments") +
          "SELECT osm_id, COUNT(*) AS n FROM incoming_segments GROUP BY osm_id HAVING COUNT(*) > 1")
def q_duplicate_osm_ids(spark, sf):
    return integrity.duplicate_keys(view(spark, sf, "incoming_segments"), "osm_id")


@register("cascade_delete", duck_with("readings", "segments") +
          "SELECT reading_id, segment_id FROM readings WHERE segment_id NOT IN "
          "(SELECT segment_id FROM segments WHERE length = 0)")
def q_cascade_delete(spark, sf):
    """Readings left after deleting the zero-length segments (ON DELETE CASCADE)."""
    deleted = view(spark, sf, "segments").filter(F.col("length") == 0).select("segment_id")
    return integrity.cascade_delete(view(spark, sf, "readings"), deleted, "segment_id") \
        .select("reading_id", "segment_id")


# ---- geometry ------------------------------------------------------------

@register("segment_endpoints", duck_with("segments") +
          "SELECT segment_id, x0 AS start_lon, y0 AS start_lat, x2 AS end_lon, y2 AS end_lat FROM segments")
def q_segment_endpoints(spark, sf):
    s = segment_table(spark, sf)
    return s.select("segment_id", *[v.alias(k) for k, v in sg.endpoints(F.col("pts")).items()])


@register("segment_defaults", duck_with("segments") +
          "SELECT segment_id, COALESCE(NULLIF(name, ''), 'Unnamed Corridor') AS name, "
          "CAST(COALESCE(NULLIF(speed_limit, 0), 50) AS DOUBLE) AS speed_limit, "
          "COALESCE(NULLIF(length, 0e0), 1e3) AS length FROM segments")
def q_segment_defaults(spark, sf):
    return sg.with_defaults(view(spark, sf, "segments")).select("segment_id", "name", "speed_limit", "length")


def _txt(e: str) -> str:
    return f"CAST({e} AS VARCHAR)"


_LINE_TXT = (f"'SRID=4326;LINESTRING(' || {_txt('x0')} || ' ' || {_txt('y0')} || ', ' || {_txt('x1')} || ' ' || "
             f"{_txt('y1')} || ', ' || {_txt('x2')} || ' ' || {_txt('y2')} || ')'")


@register("ewkt_linestring", duck_with("segments") + f"SELECT segment_id, {_LINE_TXT} AS ewkt FROM segments")
def q_ewkt_linestring(spark, sf):
    return segment_table(spark, sf).select("segment_id", geo.ewkt_linestring(F.col("pts")).alias("ewkt"))


@register("ewkt_parse", duck_with("segments") +
          "SELECT segment_id, 4326 AS srid, 'LineString' AS geometry_type, CAST(3 AS INTEGER) AS n_points, "
          "x0, y0, x1, y1, x2, y2 FROM segments")
def q_ewkt_parse(spark, sf):
    """Text -> geometry round trip: EWKT written, then parsed back to numbers."""
    s = segment_table(spark, sf).select("segment_id", geo.ewkt_linestring(F.col("pts")).alias("ewkt"))
    g = s.select("segment_id", geo.parse_ewkt(F.col("ewkt")).alias("g"))
    line = F.col("g.rings")[0]
    return g.select("segment_id", F.col("g.srid").alias("srid"), F.col("g.type").alias("geometry_type"),
                    F.size(line).alias("n_points"),
                    *[line[i // 2][("x", "y")[i % 2]].alias(_XY[i]) for i in range(6)])


# ---- latest join, viewport, GeoJSON --------------------------------------

_LATEST = """lr AS (SELECT segment_id, current_speed, congestion_score, reading_ts FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY segment_id ORDER BY reading_ts DESC, reading_id DESC) AS rn
  FROM readings) t WHERE rn = 1)
"""


@register("segments_with_latest", duck_with("segments", "readings").rstrip() + ",\n" + _LATEST +
          "SELECT s.segment_id, s.osm_id, s.name, s.speed_limit, s.length, lr.current_speed, "
          "lr.congestion_score, lr.reading_ts FROM segments s LEFT JOIN lr ON s.segment_id = lr.segment_id")
def q_segments_with_latest(spark, sf):
    s = view(spark, sf, "segments").select("segment_id", "osm_id", "name", "speed_limit", "length")
    return latest.segments_with_latest(s, view(spark, sf, "readings")) \
        .select("segment_id", "osm_id", "name", "speed_limit", "length",
                "current_speed", "congestion_score", "reading_ts")


def _piece_sql(ax, ay, bx, by) -> str:
    x1, y1, x2, y2 = _VB
    f = [f"(({bx} - {ax}) * ({cy} - {ay}) - ({by} - {ay}) * ({cx} - {ax}))"
         for cx, cy in ((x1, y1), (x2, y1), (x1, y2), (x2, y2))]
    return (f"(greatest({ax}, {bx}) >= {x1} AND least({ax}, {bx}) <= {x2} AND "
            f"greatest({ay}, {by}) >= {y1} AND least({ay}, {by}) <= {y2} AND "
            f"least({', '.join(f)}) <= 0 AND greatest({', '.join(f)}) >= 0)")


_IN_VIEW = f"({_piece_sql('x0', 'y0', 'x1', 'y1')} OR {_piece_sql('x1', 'y1', 'x2', 'y2')})"


@register("segments_in_viewport", duck_with("segments") +
          f"SELECT segment_id, osm_id, name, speed_limit, length FROM segments WHERE {_IN_VIEW}")
def q_segments_in_viewport(spark, sf):
    return spatial.segments_in_viewport(segment_table(spark, sf), VIEWPORT) \
        .select("segment_id", "osm_id", "name", "speed_limit", "length")


_GEO_PARSED = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("geometry", T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("coordinates", T.ArrayType(T.ArrayType(T.DoubleType())))])),
    T.StructField("properties", T.StructType([
        T.StructField("segment_id", T.LongType()), T.StructField("osm_id", T.LongType()),
        T.StructField("name", T.StringType()), T.StructField("speed_limit", T.IntegerType()),
        T.StructField("length", T.DoubleType()), T.StructField("current_speed", T.DoubleType()),
        T.StructField("congestion_score", T.DoubleType()),
        T.StructField("reading_timestamp", T.TimestampNTZType())])),
])


@register("traffic_geojson", duck_with("segments", "readings").rstrip() + ",\n" + _LATEST +
          "SELECT s.segment_id, 'Feature' AS feature_type, 'LineString' AS geometry_type, "
          "CAST(3 AS INTEGER) AS n_coords, x0 AS first_lon, y0 AS first_lat, x2 AS last_lon, y2 AS last_lat, "
          "s.osm_id, s.name, s.speed_limit, s.length, lr.current_speed, lr.congestion_score, "
          f"lr.reading_ts AS reading_timestamp FROM segments s LEFT JOIN lr ON s.segment_id = lr.segment_id "
          f"WHERE {_IN_VIEW}")
def q_traffic_geojson(spark, sf):
    """Viewport segments with their latest reading as GeoJSON Feature text,
    read back into columns (checks the text, compares numbers)."""
    s = spatial.segments_in_viewport(segment_table(spark, sf), VIEWPORT)
    j = latest.segments_with_latest(s, view(spark, sf, "readings"), selective=True)
    props = {k: F.col(k) for k in ("segment_id", "osm_id", "name", "speed_limit", "length",
                                   "current_speed", "congestion_score")}
    props["reading_timestamp"] = F.col("reading_ts")
    # A segment without a usable line yields no feature (the reference skips
    # features whose geometry does not parse).
    feats = j.filter(F.col("pts").isNotNull()).select(line_feature(F.col("pts"), props).alias("feature"))
    f = feats.select(F.from_json("feature", _GEO_PARSED).alias("f"))
    c = F.col("f.geometry.coordinates")
    return f.select(F.col("f.properties.segment_id").alias("segment_id"), F.col("f.type").alias("feature_type"),
                    F.col("f.geometry.type").alias("geometry_type"), F.size(c).alias("n_coords"),
                    c[0][0].alias("first_lon"), c[0][1].alias("first_lat"),
                    F.element_at(c, -1)[0].alias("last_lon"), F.element_at(c, -1)[1].alias("last_lat"),
                    *[F.col(f"f.properties.{k}").alias(k) for k in
                      ("osm_id", "name", "speed_limit", "length", "current_speed", "congestion_score",
                       "reading_timestamp")])


# ---- nearest weather, features, scoring ----------------------------------

_KNN = """seg_mid AS (SELECT segment_id, (x0 + x2) / 2e0 AS mid_lon, (y0 + y2) / 2e0 AS mid_lat FROM segments),
knn AS (SELECT segment_id, snapshot_id, temperature, rain_intensity FROM (
  SELECT m.segment_id, w.snapshot_id, w.temperature, w.rain_intensity,
    ROW_NUMBER() OVER (PARTITION BY m.segment_id ORDER BY
      (w.longitude - m.mid_lon) * (w.longitude - m.mid_lon) + (w.latitude - m.mid_lat) * (w.latitude - m.mid_lat),
      w.observed_at DESC, w.snapshot_id) AS rn
  FROM seg_mid m, wt w) t WHERE rn = 1)
"""

_SEG_WX = (WV_SQL.rstrip() + ",\n" + duck_ctes("segments", "readings") + ",\n" +
           _LATEST.rstrip() + ",\n" + _KNN)


@register("segment_weather_knn", _SEG_WX + "SELECT * FROM knn")
def q_segment_weather_knn(spark, sf):
    k = sg.segment_weather(segment_table(spark, sf), _weather_for_join(spark, sf))
    return k.select("segment_id", "snapshot_id", "temperature", "rain_intensity")


_FEATURES = """feat AS (SELECT s.segment_id, COALESCE(NULLIF(s.name, ''), 'Unnamed Corridor') AS name,
    COALESCE(NULLIF(s.length, 0e0), 1e3) AS length,
    CAST(COALESCE(NULLIF(s.speed_limit, 0), 50) AS DOUBLE) AS speed_limit,
    COALESCE(lr.congestion_score, 0e0) AS congestion_score,
    COALESCE(knn.temperature, 2e1) AS temperature, COALESCE(knn.rain_intensity, 0e0) AS rain_intensity,
    s.x0 AS start_lon, s.y0 AS start_lat, s.x2 AS end_lon, s.y2 AS end_lat
  FROM segments s LEFT JOIN lr ON s.segment_id = lr.segment_id LEFT JOIN knn ON s.segment_id = knn.segment_id)
"""


def _mult_sql() -> str:
    from corridor.operators.model import DEFAULT_WEIGHTS as W
    x1 = "greatest(0e0, least(1e0, congestion_score))"
    x2 = "greatest(0e0, rain_intensity)"
    x3 = "abs(temperature - 2e1)"
    return (f"greatest(1e0, {W['w0']!r}e0 + {W['w1']!r}e0 * {x1} + {W['w2']!r}e0 * {x2} "
            f"+ {W['w3']!r}e0 * {x3})")


_FF = "length / (speed_limit / 36e-1)"
_PRED = rnd_sql(f"{_FF} * {_mult_sql()}", 2)

_SCORED = f"""scored AS (SELECT *, {_PRED} AS predicted_time_seconds,
  {rnd_sql(_FF, 2)} AS free_flow_time_seconds FROM feat)
"""


@register("segment_features", _SEG_WX.rstrip() + ",\n" + _FEATURES + "SELECT * FROM feat")
def q_segment_features(spark, sf):
    return sg.segment_features(segment_table(spark, sf), view(spark, sf, "readings"),
                               _weather_for_join(spark, sf))


def _scored(spark, sf):
    return sg.score_segments(sg.segment_features(segment_table(spark, sf), view(spark, sf, "readings"),
                                                 _weather_for_join(spark, sf)))


@register("predict_segments", _SEG_WX.rstrip() + ",\n" + _FEATURES.rstrip() + ",\n" + _SCORED +
          "SELECT segment_id, name, predicted_time_seconds, free_flow_time_seconds, congestion_score, "
          "rain_intensity, temperature FROM scored")
def q_predict_segments(spark, sf):
    return _scored(spark, sf).select("segment_id", "name", "predicted_time_seconds", "free_flow_time_seconds",
                                     "congestion_score", "rain_intensity", "temperature")


@register("prediction_log", _SEG_WX.rstrip() + ",\n" + _FEATURES.rstrip() + ",\n" + _SCORED +
          "SELECT sha256(run || '|' || CAST(segment_id AS VARCHAR)) AS prediction_id, segment_id, start_lat AS origin_lat, "
          "start_lon AS origin_lng, end_lat AS dest_lat, end_lon AS dest_lng, "
          "predicted_time_seconds AS predicted_time, CAST(NULL AS DOUBLE) AS actual_time "
          "FROM scored, (SELECT unnest(['run-1', 'run-2']) AS run) r")
def q_prediction_log(spark, sf):
    """Two scoring runs in one log: their ids differ."""
    scored = _scored(spark, sf)
    return sg.prediction_log(scored, "run-1").unionByName(sg.prediction_log(scored, "run-2"))


@register("network_kpis", duck_with("readings").rstrip() + ",\n" + _LATEST +
          f"SELECT {rnd_sql(avg_sql('current_speed'), 2)} AS avg_speed, "
          f"{rnd_sql(avg_sql('congestion_score'), 3)} AS avg_congestion, "
          "COUNT(*) AS segment_count, (SELECT COUNT(*) FROM readings) AS reading_count, "
          f"CASE WHEN {avg_sql('congestion_score')} IS NULL THEN NULL "
          f"WHEN {avg_sql('congestion_score')} < 35e-2 THEN 'LIGHT' "
          f"WHEN {avg_sql('congestion_score')} < 65e-2 THEN 'MODERATE' ELSE 'HEAVY' END AS congestion_level "
          "FROM lr")
def q_network_kpis(spark, sf):
    """Network-wide speed/congestion over each segment's latest reading, plus volume."""
    return kpis.network_kpis(view(spark, sf, "readings"))
