"""Load-ready transforms of validated feed records, and keep-last dedupe.

Timestamps are instants; the session clock is UTC, so normalization to UTC
is the session setting itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corridor.functions import geometry as geo

# Default descriptions.
INCIDENT_DESCRIPTION_PREFIX = "Traffic incident of type: "
CONSTRUCTION_DESCRIPTION = "Active construction zone"


def keep_last(df: DataFrame, keys: Sequence[str], ordinal: str) -> DataFrame:
    """One row per key: the one with the largest input ordinal.

    A plain aggregate (``max`` of a struct led by the ordinal) with map-side
    combining: a key holding a third of the rows sends one candidate per
    task through the shuffle. ``dropDuplicates`` would keep an arbitrary row.
    """
    others = [c for c in df.columns if c not in keys and c != ordinal]
    fixed = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
             T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    if isinstance(df.schema[ordinal].dataType, (T.IntegerType, T.LongType)) and \
            all(isinstance(df.schema[c].dataType, fixed) for c in others):
        # Fixed-width values and an integer ordinal: per-column max_by runs as
        # a hash aggregate (about 20% faster than the struct form on 20M rows).
        # The ordinal is unique per record, so every column comes from one row.
        aggs = [F.max(ordinal).alias(ordinal)] + [F.max_by(c, ordinal).alias(c) for c in others]
        return df.groupBy(*keys).agg(*aggs).select(*df.columns)
    best = F.max(F.struct(F.col(ordinal).alias("_ord"), *[F.col(c) for c in others]))
    out = df.groupBy(*keys).agg(best.alias("_k"))
    return out.select(*keys, F.col("_k._ord").alias(ordinal), *[F.col(f"_k.{c}").alias(c) for c in others]) \
        .select(*df.columns)


def transform_traffic(valid: DataFrame, ts: str = "timestamp", ordinal: str = "ordinal",
                      has_time: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Keep-last per (segment_id, timestamp) within the batch.

    With ``has_time`` (a boolean column) a record that came without a timestamp
    is a reading of its own and never merged with another.
    """
    cols = ["segment_id", "current_speed", "congestion_score", ts, *keep]
    if has_time is None:
        return keep_last(valid.select(*cols, ordinal), ["segment_id", ts], ordinal).select(*cols)
    own = F.when(~F.col(has_time), F.col(ordinal)).alias("_own")
    return keep_last(valid.select(*cols, ordinal, own), ["segment_id", ts, "_own"], ordinal).select(*cols)


def _blank_to_null(c: Column) -> Column:
    return F.when(c != "", c)


def transform_weather(valid: DataFrame, ts: str = "timestamp", keep: Sequence[str] = ()) -> DataFrame:
    return valid.select(
        *keep, "latitude", "longitude",
        geo.ewkt_point(F.col("longitude"), F.col("latitude")).alias("geometry"),
        "temperature", F.coalesce(F.col("rain_intensity"), F.lit(0.0)).alias("rain_intensity"),
        "visibility", ts)


def transform_incident(valid: DataFrame, ts: str = "timestamp", keep: Sequence[str] = ()) -> DataFrame:
    desc = F.coalesce(_blank_to_null(F.col("description")),
                      F.concat(F.lit(INCIDENT_DESCRIPTION_PREFIX), F.col("incident_type")))
    return valid.select(
        *keep, "incident_type", desc.alias("description"), "longitude", "latitude",
        geo.ewkt_point(F.col("longitude"), F.col("latitude")).alias("geometry"),
        "severity", "status", F.col(ts).alias("created_at"), F.col(ts).alias("updated_at"))


def transform_construction(valid: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    desc = F.coalesce(_blank_to_null(F.col("description")), F.lit(CONSTRUCTION_DESCRIPTION))
    pts = F.flatten(F.col("rings"))
    mnx, mny, mxx, mxy = geo.bbox(pts)
    return valid.select(
        *keep, desc.alias("description"), "geometry_type", "rings",
        geo.ewkt_geometry(F.col("geometry_type"), F.col("rings")).alias("geometry"),
        "status", F.to_date("start_date").alias("start_date"), F.to_date("end_date").alias("end_date"),
        mnx.alias("min_x"), mny.alias("min_y"), mxx.alias("max_x"), mxy.alias("max_y"))
