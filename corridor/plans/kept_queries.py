"""Queries over tables that the library writes itself: commits, kept summaries, versioned tables.

Each writes all rows of its view to the session's shared scratch folder through
the same sinks as the ingest, with replays and compaction, and reads the answer back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corridor.functions.numeric import rnd
from corridor.operators import kpis
from corridor.plans import catalog, model_queries, reading_queries, segment_queries  # noqa: F401 - their SQL
from corridor.plans.catalog import register
from corridor.plans.views import duck_with, view
from corridor.session import scratch_path
from corridor.sinks.commits import CommitTable
from corridor.sinks.versions import VersionedTable
from corridor.streaming import kept

_PARTS = 2


def _batches(df: DataFrame, key: str) -> list[tuple[str, int, DataFrame]]:
    """All rows as batches of two streams, newest first, and the last one twice (a replay)."""
    part = F.pmod(F.xxhash64(key), F.lit(2 * _PARTS))
    out = [(f"feed-{k % 2}", k // 2, df.where(part == k)) for k in range(2 * _PARTS)][::-1]
    return [*out, out[0]]


def _fill(summary: kept.Kept, df: DataFrame, key: str) -> kept.Kept:
    for stream, number, rows in _batches(df, key):
        summary.add(rows, number, stream)
    summary.compact(fan=2)
    return summary


@register("latest_reading_kept", catalog.ORACLE["latest_reading"])
def q_latest_reading_kept(spark: SparkSession, sf: str) -> DataFrame:
    """The latest reading per segment from the table that the stream keeps."""
    summary = kept.latest_readings(spark, scratch_path(spark, "latest"), ts="reading_ts")
    return _fill(summary, view(spark, sf, "readings"), "reading_id").read()


def _cells(spark: SparkSession, sf: str) -> kept.HourlyCells:
    summary = kept.HourlyCells(spark, scratch_path(spark, "cells"), ts="reading_ts")
    return _fill(summary, view(spark, sf, "readings"), "reading_id")


@register("traffic_trends_kept", catalog.ORACLE["traffic_trends"])
def q_traffic_trends_kept(spark: SparkSession, sf: str) -> DataFrame:
    """The trend report from the hourly cells that the stream keeps."""
    return _cells(spark, sf).report()


@register("traffic_trends_segment_kept", catalog.ORACLE["traffic_trends_segment"])
def q_traffic_trends_segment_kept(spark: SparkSession, sf: str) -> DataFrame:
    return _cells(spark, sf).report(by=["segment_id"])


@register("network_kpis_kept", catalog.ORACLE["network_kpis"])
def q_network_kpis_kept(spark: SparkSession, sf: str) -> DataFrame:
    """The network counters from the kept tables."""
    latest = _fill(kept.latest_readings(spark, scratch_path(spark, "latest"), ts="reading_ts"), view(spark, sf, "readings"), "reading_id")
    return kpis.network_kpis_kept(latest.read(), _cells(spark, sf).read())


@register("model_fit_kept", catalog.ORACLE["model_fit"])
def q_model_fit_kept(spark: SparkSession, sf: str) -> DataFrame:
    """The fit from sums kept per batch of training rows."""
    sums = _fill(kept.training_sums(spark, scratch_path(spark, "sums")), view(spark, sf, "training"), "l_orderkey")
    res = kept.fit_kept(sums)
    w = [float(res["weights"][f"w{i}"]) for i in range(4)]
    row = spark.createDataFrame([(res["status"], int(res.get("samples", 0)), float(res.get("final_loss") or 0.0), *w)],
                                "status string, samples long, final_loss double, w0 double, w1 double, w2 double, w3 double")
    return row.select("status", "samples", rnd(F.col("final_loss"), 8).alias("final_loss"),
                      *[rnd(F.col(f"w{i}"), 6).alias(f"w{i}") for i in range(4)])


@register("readings_committed", duck_with("readings") +
          "SELECT reading_id, segment_id, current_speed, congestion_score, reading_ts FROM readings")
def q_readings_committed(spark: SparkSession, sf: str) -> DataFrame:
    """All readings after ingest by two streams, a replay and compaction: none lost, none twice."""
    table = CommitTable(spark, scratch_path(spark, "readings"), days=True, sort=("segment_id", "reading_ts"))
    dated = view(spark, sf, "readings").withColumn("dt", F.to_date("reading_ts"))
    for stream, number, rows in _batches(dated, "reading_id"):
        table.write(rows, number, stream)
    table.compact(fan=2)
    return table.read().drop("dt")


def _stored_segments(spark: SparkSession, sf: str) -> VersionedTable:
    table = VersionedTable(spark, scratch_path(spark, "segments"), "osm_id", buckets=16)
    table.reload(view(spark, sf, "segments"))
    return table


@register("segment_upsert_stored", catalog.ORACLE["segment_upsert"])
def q_segment_upsert_stored(spark: SparkSession, sf: str) -> DataFrame:
    """Upsert into the stored table, then of the stored table into itself, which changes nothing."""
    table = _stored_segments(spark, sf)
    table.upsert(view(spark, sf, "incoming_segments"))
    table.upsert(table.read(), ordinal=None)
    return table.read()


@register("segment_insert_unique", duck_with("segments", "incoming_segments") + """
SELECT ordinal, osm_id, CASE WHEN osm_id IN (SELECT osm_id FROM segments) THEN 'osm_id_stored' ELSE 'osm_id_repeated' END AS reason
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY osm_id ORDER BY ordinal) AS n FROM incoming_segments) t
WHERE n > 1 OR osm_id IN (SELECT osm_id FROM segments)""")
def q_segment_insert_unique(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of an insert that the table's UNIQUE key refuses."""
    _, rejected = _stored_segments(spark, sf).insert(view(spark, sf, "incoming_segments"))
    return rejected.select("ordinal", "osm_id", "reason")
