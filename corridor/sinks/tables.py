"""Table sinks: date-partitioned Parquet commits, full reload, upsert frames.

* ``write_batch`` commits a batch of a table under its stream and batch number
  (``commits.CommitTable``): a replay takes the place of its earlier attempt
  and another stream's batch of the same number stays. The row count comes from
  an ``Observation`` on the write itself (no second pass).
* An empty batch writes nothing and reports 0.
* ``strict=True`` reproduces all-or-nothing loading: one rejected record
  fails the batch before anything is written.
* ``upsert_touch`` returns a frame; ``versions.VersionedTable`` writes it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corridor.functions.curve import curve_key, point_key
from corridor.operators.transform import keep_last
from corridor.sinks.commits import CommitTable

# Layout of each table (partition column source, sort keys).
LAYOUT = {
    "traffic_readings": ("timestamp", ("segment_id", "timestamp")),
    "weather_snapshots": ("timestamp", ("longitude", "latitude")),
    "incidents": ("created_at", ("status", "created_at")),
    "construction_zones": ("start_date", ("status",)),
    "predictions": ("timestamp", ("timestamp",)),
}


class BatchRejected(RuntimeError):
    pass


def committed(spark: SparkSession, path: str, table: str) -> CommitTable:
    """The commits of one of the tables of LAYOUT: read, compact and vacuum it."""
    return CommitTable(spark, path, days=True, sort=LAYOUT[table][1])


def write_batch(df: DataFrame, path: str, table: str, batch_id: int | None = None,
                rejected: DataFrame | None = None, strict: bool = False, stream: str = "batch") -> int:
    """Commit one batch of a table; returns the number of rows written."""
    if strict and rejected is not None and not rejected.isEmpty():
        raise BatchRejected(f"{table}: batch {batch_id} has rejected records; nothing written")
    dated = df.withColumn("dt", F.to_date(F.col(LAYOUT[table][0])))
    return committed(df.sparkSession, path, table).write(dated, batch_id, stream)


def load_traffic_readings(df: DataFrame, path: str, batch_id: int | None = None, **kw) -> int:
    """Readings with a deterministic ``reading_id`` (a hash of the row), so a
    retried task or a replayed batch writes the same ids; the id breaks ties
    between readings of a segment with the same timestamp."""
    place = ["record_id"] if "record_id" in df.columns else []
    rid = F.xxhash64("segment_id", "timestamp", "current_speed", "congestion_score", *place)
    return write_batch(df.select(rid.alias("reading_id"), "segment_id", "current_speed",
                                 F.col("congestion_score").cast("decimal(3,2)").alias("congestion_score"),
                                 "timestamp"), path, "traffic_readings", batch_id, **kw)


def _with_id(df: DataFrame, name: str) -> DataFrame:
    """The table's id column, from the record's own hash, if the rows have none yet."""
    if name in df.columns or "record_id" not in df.columns:
        return df
    return df.withColumnRenamed("record_id", name)


def load_weather_snapshots(df: DataFrame, path: str, batch_id: int | None = None, **kw) -> int:
    return write_batch(_with_id(df, "snapshot_id"), path, "weather_snapshots", batch_id, **kw)


def load_incidents(df: DataFrame, path: str, batch_id: int | None = None, **kw) -> int:
    return write_batch(_with_id(df, "incident_id"), path, "incidents", batch_id, **kw)


def load_construction_zones(df: DataFrame, path: str, batch_id: int | None = None, **kw) -> int:
    return write_batch(_with_id(df, "zone_id").withColumn("start_date", F.to_date("start_date"))
                       .withColumn("end_date", F.to_date("end_date")),
                       path, "construction_zones", batch_id, **kw)


def append_predictions(log: DataFrame, path: str, batch_id: int | None = None,
                       at: Column | None = None, stream: str = "batch") -> int:
    """Prediction audit log; ``timestamp`` defaults to the query time."""
    return write_batch(log.withColumn("timestamp", at if at is not None else F.current_timestamp()),
                       path, "predictions", batch_id, stream=stream)


def full_reload(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Truncate-and-insert: the table is replaced by ``df``."""
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def upsert_touch(base: DataFrame, incoming: DataFrame, key: str, touch: str = "updated_at",
                 keep: Sequence[str] = ("created_at",), now: Column | None = None,
                 ordinal: str | None = "ordinal") -> DataFrame:
    """Insert-or-update by ``key`` where an updated row gets ``touch = now``.

    Mirrors a BEFORE UPDATE trigger: every updated row is stamped, inserted
    rows keep their own value, ``keep`` columns (creation time) stay as first
    written. A key that comes more than once keeps its last row: the largest
    ``ordinal`` where the batch has one, else the latest ``touch``. One full outer
    join on the key.
    """
    now = now if now is not None else F.current_timestamp()
    cols = [c for c in base.columns if c != key]
    order = ordinal if ordinal in incoming.columns else touch
    rows = incoming.select(key, *cols, F.col(order).alias("_order"))
    inc = keep_last(rows, [key], "_order").select(key, *cols).withColumn("_in", F.lit(True))
    b, i = base.alias("b"), inc.alias("i")
    j = b.join(i, F.col(f"b.{key}") == F.col(f"i.{key}"), "full_outer")
    matched = F.col(f"b.{key}").isNotNull() & F.col("i._in").isNotNull()
    out = [F.coalesce(F.col(f"b.{key}"), F.col(f"i.{key}")).alias(key)]
    for c in cols:
        if c == touch:
            v = F.when(matched, now.cast(base.schema[c].dataType)).otherwise(
                F.coalesce(F.col(f"i.{c}"), F.col(f"b.{c}")))
        elif c in keep:
            v = F.coalesce(F.col(f"b.{c}"), F.col(f"i.{c}"))
        else:
            v = F.when(F.col("i._in"), F.col(f"i.{c}")).otherwise(F.col(f"b.{c}"))
        out.append(v.alias(c))
    return j.select(*out)


def write_features(features: DataFrame, path: str, feature: str = "feature") -> None:
    """GeoJSON Features, one per line: a collection of any size, written by all tasks."""
    features.select(F.col(feature).alias("value")).write.mode("overwrite").text(path)


def write_segments(segments: DataFrame, path: str, pts: str = "pts") -> None:
    """Road segments as a new table version, with stored bbox columns and curve key.

    ``min_x..max_y`` next to the line make the viewport's bbox test a Parquet
    filter. Rows are dealt and sorted by ``curve``, so a row group or page holds a
    neighbourhood, and a box, being a few key ranges, skips the others on both axes.
    """
    from corridor.functions.geometry import bbox
    out = segments
    if not {"min_x", "min_y", "max_x", "max_y"} <= set(out.columns):
        mnx, mny, mxx, mxy = bbox(F.col(pts))
        out = out.select("*", mnx.alias("min_x"), mny.alias("min_y"), mxx.alias("max_x"), mxy.alias("max_y"))
    key = curve_key(*[F.col(c) for c in ("min_x", "min_y", "max_x", "max_y")])
    _write_along(out.withColumn("curve", key), path)


def write_points(points: DataFrame, path: str, x: str = "longitude", y: str = "latitude") -> None:
    """Points (incidents, stations) as a new table version along the curve, for ``spatial.within_box``."""
    _write_along(points.withColumn("curve", point_key(F.col(x), F.col(y))), path)


def _write_along(df: DataFrame, path: str) -> None:
    # Range bounds come from a sample of the keys; equal keys stay together, and a range can be split no further
    # than one key, a cell of some 38 m.
    df.repartitionByRange("curve").sortWithinPartitions("curve").write.mode("overwrite").parquet(path)
