"""Spatial operators: viewport filters, nearest-to-point, exact nearest-neighbour join.

Distances for *ordering* are planar squared degrees (the reference orders by
``<->`` on SRID 4326); reported distances are metres, computed after the
nearest row is chosen.

The nearest-neighbour join is exact and without a cross join: see ``nearest``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corridor.functions import curve
from corridor.functions import geometry as geo
from corridor.operators.nearest import nearest_locations
from corridor.session import checkpoint_dir


def within_box(df: DataFrame, box, x: str = "longitude", y: str = "latitude") -> DataFrame:
    """Points in the closed box; a stored ``curve`` column (``tables.write_points``) narrows the scan to its key ranges."""
    geo.check_box(*box)
    if "curve" in df.columns:
        df = df.filter(curve.in_ranges(F.col("curve"), curve.key_ranges(box, (curve.FINEST,))))
    return df.filter(geo.point_in_box(F.col(x), F.col(y), box))


def segments_in_viewport(segments: DataFrame, box, pts: str = "pts") -> DataFrame:
    """Lines touching the closed box.

    When the frame carries ``min_x..max_y`` columns (stored next to the
    geometry) the bbox-overlap test is added first; on a parquet scan it is
    pushed down and skips row groups. The exact test then removes lines
    whose bbox overlaps the box but whose pieces miss it. A stored ``curve``
    column, by which the table is sorted, narrows the scan on both axes at once.
    """
    geo.check_box(*box)
    x1, y1, x2, y2 = (float(v) for v in box)
    out = segments
    if "curve" in segments.columns:
        out = out.filter(curve.in_ranges(F.col("curve"), curve.key_ranges(box)))
    if {"min_x", "min_y", "max_x", "max_y"} <= set(segments.columns):
        out = out.filter((F.col("max_x") >= x1) & (F.col("min_x") <= x2) &
                         (F.col("max_y") >= y1) & (F.col("min_y") <= y2))
    return out.filter(geo.line_box_intersects(F.col(pts), box))


def nearest_one(df: DataFrame, lon: float, lat: float, **columns):
    """The nearest row itself; ``ValueError`` for a point off the globe, ``LookupError`` without rows."""
    if not (-90 <= lat <= 90 and -180 <= lon <= 180):
        raise ValueError("latitude must be within -90..90 and longitude within -180..180")
    row = nearest_to_point(df, lon, lat, **columns).first()
    if row is None:
        raise LookupError("no row to be nearest")
    return row


def nearest_to_point(df: DataFrame, lon: float, lat: float, x: str = "longitude", y: str = "latitude",
                     ts: str = "timestamp", tiebreak: str = "id") -> DataFrame:
    """The single nearest row (ties: latest ``ts``, then smaller ``tiebreak``).

    ``orderBy(...).limit(1)`` plans as TakeOrderedAndProject: each task keeps
    its own best row and only those meet on one task.
    """
    d2 = geo.planar_d2(F.col(x), F.col(y), F.lit(float(lon)), F.lit(float(lat)))
    return (df.withColumn("_d2", d2).orderBy(F.col("_d2"), F.col(ts).desc(), F.col(tiebreak))
            .limit(1).drop("_d2"))


def latest_per_location(stations: DataFrame, x: str, y: str, ts: str, tiebreak: str) -> DataFrame:
    """One row per (x, y): the latest, ties by the smaller ``tiebreak``."""
    others = [c for c in stations.columns if c not in (x, y)]
    best = F.min(F.struct((-F.unix_micros(F.col(ts).cast("timestamp"))).alias("_t"), F.col(tiebreak).alias("_id"),
                          *[F.col(c) for c in others]))
    return (stations.groupBy(x, y).agg(best.alias("_s"))
            .select(x, y, *[F.col(f"_s.{c}").alias(c) for c in others]))


def nearest_join(points: DataFrame, stations: DataFrame, pid: str, px: str, py: str,
                 sx: str = "longitude", sy: str = "latitude", ts: str = "timestamp",
                 tiebreak: str = "id", **options) -> DataFrame:
    """For each point the nearest station row (planar), exactly.

    Ties: smaller distance, then later ``ts``, then smaller ``tiebreak``.
    Returns ``pid`` plus the station columns and ``d2``; points with no
    station at all (or NULL coordinates) are absent (the caller left-joins
    for defaults).

    Jobs run while the frame is built: the locations are written to the checkpoint
    folder and counted, and beyond ``nearest.BROADCAST_ROWS`` they are sampled, dealt to
    leaves and searched once. Spark removes the files at the session's end
    where ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
    """
    checkpoint_dir(points.sparkSession)
    # One row per distinct location, written once: it is counted, searched and joined.
    locs = latest_per_location(stations, sx, sy, ts, tiebreak).checkpoint()
    order = (-F.unix_micros(F.col(ts).cast("timestamp")), F.col(tiebreak))
    return nearest_locations(points, locs, pid, px, py, sx, sy, order, **options)
