"""Road-segment operators: upsert, endpoints, defaults, feature assembly, scoring, log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corridor.operators import latest as lt
from corridor.operators import model, spatial
from corridor.functions.numeric import rnd
from corridor.operators.transform import keep_last

# Defaults for falsy segment attributes and missing conditions.
UNNAMED = "Unnamed Corridor"
DEFAULT_LENGTH_M = 1000.0
DEFAULT_LIMIT_KMH = 50.0
DEFAULT_SCORE = 0.0
DEFAULT_TEMP_C = 20.0
DEFAULT_RAIN = 0.0


def upsert(base: DataFrame, incoming: DataFrame, key: str = "osm_id", id_col: str = "segment_id",
           ordinal: str | None = "ordinal") -> DataFrame:
    """Insert-or-update by ``key``: every non-key column is overwritten.

    Duplicate keys in the batch keep the last (largest ``ordinal``). An
    existing row keeps its id; a new row takes the id it arrives with. One
    full outer join on the key (both sides hash-partitioned on it).
    """
    cols = [c for c in base.columns if c != key]
    inc = incoming
    if ordinal and ordinal in inc.columns:
        inc = keep_last(inc, [key], ordinal)
    inc = inc.select(key, *cols).withColumn("_in", F.lit(True))
    b, i = base.alias("b"), inc.alias("i")
    j = b.join(i, F.col(f"b.{key}") == F.col(f"i.{key}"), "full_outer")
    out = [F.coalesce(F.col(f"b.{key}"), F.col(f"i.{key}")).alias(key)]
    for c in cols:
        if c == id_col:
            out.append(F.coalesce(F.col(f"b.{c}"), F.col(f"i.{c}")).alias(c))
        else:
            out.append(F.when(F.col("i._in"), F.col(f"i.{c}")).otherwise(F.col(f"b.{c}")).alias(c))
    return j.select(*out).select(*base.columns)


def endpoints(pts: Column) -> dict[str, Column]:
    first, last = pts[0], F.element_at(pts, -1)
    return {"start_lon": first.x, "start_lat": first.y, "end_lon": last.x, "end_lat": last.y}


def chord_midpoint(pts: Column) -> tuple[Column, Column]:
    """Mean of start and end point (not the along-line midpoint)."""
    first, last = pts[0], F.element_at(pts, -1)
    return (first.x + last.x) / F.lit(2.0), (first.y + last.y) / F.lit(2.0)


def with_defaults(df: DataFrame) -> DataFrame:
    """Falsy values replaced: length 0/NULL, limit 0/NULL, name ''/NULL."""
    return (df.withColumn("length", F.coalesce(F.when(F.col("length") != 0, F.col("length")),
                                               F.lit(DEFAULT_LENGTH_M)))
            .withColumn("speed_limit", F.coalesce(F.when(F.col("speed_limit") != 0, F.col("speed_limit")),
                                                  F.lit(DEFAULT_LIMIT_KMH)).cast("double"))
            .withColumn("name", F.coalesce(F.when(F.col("name") != "", F.col("name")), F.lit(UNNAMED))))


def segment_weather(segments: DataFrame, weather: DataFrame, pts: str = "pts", ts: str | None = None,
                    tiebreak: str = "snapshot_id", **options) -> DataFrame:
    """Nearest weather snapshot to each segment's chord midpoint (exact; ``options`` of ``spatial.nearest_join``)."""
    mx, my = chord_midpoint(F.col(pts))
    mids = segments.select("segment_id", mx.alias("mid_lon"), my.alias("mid_lat"))
    return spatial.nearest_join(mids, weather, "segment_id", "mid_lon", "mid_lat",
                                ts=lt.time_column(weather, ts, "observed_at", "timestamp"), tiebreak=tiebreak, **options)


def segment_features(segments: DataFrame, readings: DataFrame, weather: DataFrame,
                     pts: str = "pts") -> DataFrame:
    """Segment + latest congestion + nearest weather, with every default applied."""
    seg = with_defaults(segments).select("segment_id", "name", "length", "speed_limit",
                                         *[v.alias(k) for k, v in endpoints(F.col(pts)).items()], pts)
    score = lt.latest_per_segment(readings).select("segment_id", "congestion_score")
    wx = segment_weather(seg, weather, pts).select("segment_id", "temperature", "rain_intensity")
    return (seg.drop(pts).join(score, "segment_id", "left").join(wx, "segment_id", "left")
            .select("segment_id", "name", "length", "speed_limit",
                    F.coalesce("congestion_score", F.lit(DEFAULT_SCORE)).alias("congestion_score"),
                    F.coalesce("temperature", F.lit(DEFAULT_TEMP_C)).alias("temperature"),
                    F.coalesce("rain_intensity", F.lit(DEFAULT_RAIN)).alias("rain_intensity"),
                    "start_lon", "start_lat", "end_lon", "end_lat"))


def predict_segment(segments: DataFrame, readings: DataFrame, weather: DataFrame, segment_id: int,
                    pts: str = "pts", w: dict | None = None) -> DataFrame:
    """The prediction of one segment; ``LookupError`` if there is no such segment.

    The id filters segments and readings before anything else reads them.
    """
    own = segments.where(F.col("segment_id") == F.lit(int(segment_id)))
    if own.isEmpty():
        raise LookupError(f"no road segment {segment_id}")
    mine = readings.where(F.col("segment_id") == F.lit(int(segment_id)))
    return score_segments(segment_features(own, mine, weather, pts), w)


def score_segments(features: DataFrame, w: dict | None = None) -> DataFrame:
    """Predicted and free-flow travel time for every feature row."""
    pred = model.predict(F.col("length"), F.col("speed_limit"), F.col("congestion_score"),
                         F.col("rain_intensity"), F.col("temperature"), w)
    ff = rnd(F.col("length") / (F.col("speed_limit") / F.lit(model.KMH_PER_MS)), 2)
    return features.select("*", pred.alias("predicted_time_seconds"), ff.alias("free_flow_time_seconds"))


def prediction_log(scored: DataFrame, run_id: str, id_cols: Sequence[str] = ("segment_id",)) -> DataFrame:
    """Audit rows: origin = start point, destination = end point, actual NULL.

    The id is a SHA-256 of the scoring run and the key columns: two runs never
    share one, and a replayed run writes the same ids again.
    """
    pid = F.sha2(F.concat_ws("|", F.lit(run_id), *[F.col(c).cast("string") for c in id_cols]), 256)
    return scored.select(pid.alias("prediction_id"), *id_cols,
                         F.col("start_lat").alias("origin_lat"), F.col("start_lon").alias("origin_lng"),
                         F.col("end_lat").alias("dest_lat"), F.col("end_lon").alias("dest_lng"),
                         F.col("predicted_time_seconds").alias("predicted_time"),
                         F.lit(None).cast("double").alias("actual_time"))
