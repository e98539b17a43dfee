"""Dashboard counters: rows per status, incident counters, network speed and congestion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corridor.functions.levels import congestion_level
from corridor.functions.numeric import exact_avg, rnd


def status_counts(**feeds: DataFrame) -> DataFrame:
    """(feed, status, n) over several tables, each by the name it is given."""
    out = None
    for feed, rows in feeds.items():
        one = rows.groupBy("status").agg(F.count(F.lit(1)).alias("n")).select(F.lit(feed).alias("feed"), "status", "n")
        out = one if out is None else out.unionByName(one)
    return out


def incident_kpis(incidents: DataFrame) -> DataFrame:
    """One row: active, active and critical, cleared."""
    active = F.col("status") == "active"
    return incidents.agg(F.count_if(active).cast("long").alias("active"),
                         F.count_if(active & (F.col("severity") == "critical")).cast("long").alias("critical"),
                         F.count_if(F.col("status") == "cleared").cast("long").alias("cleared"))


def network_kpis(readings: DataFrame, ts: str = "reading_ts") -> DataFrame:
    """One row: mean speed and congestion over each segment's latest reading, its level, and the volume."""
    per_segment = readings.groupBy("segment_id").agg(
        F.max(F.struct(ts, "reading_id", "current_speed", "congestion_score")).alias("l"), F.count(F.lit(1)).alias("n"))
    return _network(per_segment.select("l.current_speed", "l.congestion_score", "n"))


def network_kpis_kept(latest: DataFrame, cells: DataFrame) -> DataFrame:
    """As :func:`network_kpis`, from the tables the stream keeps: no reading is scanned."""
    volume = cells.groupBy("segment_id").agg(F.sum("readings").alias("n"))
    return _network(latest.join(volume, "segment_id", "left"))


def _network(per_segment: DataFrame) -> DataFrame:
    c = F.col("congestion_score")
    return per_segment.agg(rnd(exact_avg(F.col("current_speed")), 2).alias("avg_speed"),
                           rnd(exact_avg(c), 3).alias("avg_congestion"),
                           F.count(F.lit(1)).alias("segment_count"),
                           F.sum("n").alias("reading_count"),
                           congestion_level(exact_avg(c)).alias("congestion_level"))
