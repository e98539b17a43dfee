"""Queries over the curve layout and over many distinct stations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corridor.operators import segments as sg, spatial
from corridor.plans import catalog
from corridor.plans.catalog import register
from corridor.plans.segment_queries import VIEWPORT, segment_table
from corridor.plans.views import duck_with, view
from corridor.session import scratch_path
from corridor.sinks import tables


@register("segments_in_viewport_curve", catalog.ORACLE["segments_in_viewport"])
def q_segments_in_viewport_curve(spark: SparkSession, sf: str) -> DataFrame:
    """The viewport over the stored segments, laid out along the curve."""
    path = scratch_path(spark, "segments-curve")
    tables.write_segments(segment_table(spark, sf), path)
    return spatial.segments_in_viewport(spark.read.parquet(path), VIEWPORT).select(
        "segment_id", "osm_id", "name", "speed_limit", "length")


_MIDS = duck_with("segments", "weather_spread").rstrip() + """,
m AS (SELECT segment_id, (x0 + x2) / 2e0 AS mx, (y0 + y2) / 2e0 AS my FROM segments),
l AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY longitude, latitude ORDER BY observed_at DESC, snapshot_id) AS n
                     FROM weather_spread) t WHERE n = 1),
d AS (SELECT segment_id, snapshot_id, temperature, rain_intensity, observed_at,
  (longitude - mx) * (longitude - mx) + (latitude - my) * (latitude - my) AS d2 FROM m, l)
SELECT segment_id, snapshot_id, temperature, rain_intensity FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY segment_id ORDER BY d2, observed_at DESC, snapshot_id) AS n FROM d) t WHERE n = 1"""


@register("segment_weather_knn_spread", _MIDS)
def q_segment_weather_knn_spread(spark: SparkSession, sf: str) -> DataFrame:
    """Nearest weather among thousands of distinct stations, by leaves of k-d cuts."""
    near = sg.segment_weather(segment_table(spark, sf), view(spark, sf, "weather_spread"), broadcast_rows=1_000, leaf_rows=500)
    return near.select("segment_id", "snapshot_id", "temperature", "rain_intensity")
