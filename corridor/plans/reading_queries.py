"""Queries over the `readings` view: trends, windows, latest, levels, integrity."""

from __future__ import annotations

from pyspark.sql import functions as F

from corridor.operators import integrity, latest, trends
from corridor.functions.levels import congestion_level
from corridor.plans.catalog import avg_sql, register, rnd_sql
from corridor.plans.views import duck_with, view

# Fixed value: the segment used by the single-segment trend report.
TREND_SEGMENT = 7

_DAY_CASE = ("CASE day_of_week WHEN 0 THEN 'Sunday' WHEN 1 THEN 'Monday' WHEN 2 THEN 'Tuesday' "
             "WHEN 3 THEN 'Wednesday' WHEN 4 THEN 'Thursday' WHEN 5 THEN 'Friday' "
             "WHEN 6 THEN 'Saturday' ELSE 'Unknown' END")


def _hourly_cte(keys: str = "", where: str = "") -> str:
    k = f"{keys}, " if keys else ""
    return (f"h AS (SELECT {k}CAST(dayofweek(reading_ts) AS INTEGER) AS day_of_week, "
            f"CAST(hour(reading_ts) AS INTEGER) AS hour_of_day, "
            f"{avg_sql('current_speed')} AS s, {avg_sql('congestion_score')} AS c, "
            f"CAST(COUNT(*) AS INTEGER) AS reading_count FROM readings {where} "
            f"GROUP BY {k}dayofweek(reading_ts), hour(reading_ts))\n")


def _win(keys: str, order: str = "") -> str:
    part = f"{keys}, day_of_week" if keys else "day_of_week"
    return f"OVER (PARTITION BY {part}{' ORDER BY ' + order if order else ''})"


def _trend_sql(keys: str = "", where: str = "") -> str:
    k = f"{keys}, " if keys else ""
    return (duck_with("readings").rstrip() + ",\n" + _hourly_cte(keys, where) +
            f"SELECT {k}day_of_week, {_DAY_CASE} AS day_name, hour_of_day, "
            f"{rnd_sql('s', 2)} AS avg_speed, {rnd_sql('c', 3)} AS avg_congestion, reading_count, "
            f"{rnd_sql('AVG(s) ' + _win(keys), 2)} AS daily_avg_speed, "
            f"{rnd_sql('s - AVG(s) ' + _win(keys), 2)} AS speed_diff_from_daily_avg, "
            f"{rnd_sql('s - COALESCE(LAG(s) ' + _win(keys, 'hour_of_day') + ', s)', 2)} AS speed_change_from_prev_hour, "
            f"CAST(RANK() {_win(keys, 's DESC')} AS INTEGER) AS speed_rank FROM h")


def _profile_sql(keys: str = "") -> str:
    k = f"{keys}, " if keys else ""
    return (duck_with("readings").rstrip() + ",\n" + _hourly_cte(keys) +
            f"SELECT {k}day_of_week, hour_of_day, {rnd_sql('s', 2)} AS avg_speed, "
            f"{rnd_sql('c', 3)} AS avg_congestion, reading_count FROM h")


def _window_sql(col: str, expr: str) -> str:
    return (duck_with("readings").rstrip() + ",\n" + _hourly_cte() +
            f"SELECT day_of_week, hour_of_day, {expr} AS {col} FROM h")


def _windowed(spark, sf, col_fn, name):
    h = trends.hourly_profile(view(spark, sf, "readings"), keep_raw=True)
    return h.select("day_of_week", "hour_of_day", col_fn().alias(name))


@register("hourly_profile", _profile_sql())
def q_hourly_profile(spark, sf):
    return trends.hourly_profile(view(spark, sf, "readings"))


@register("hourly_profile_segment", _profile_sql("segment_id"))
def q_hourly_profile_segment(spark, sf):
    return trends.hourly_profile(view(spark, sf, "readings"), by=["segment_id"])


@register("daily_baseline", _window_sql("daily_avg_speed", rnd_sql("AVG(s) OVER (PARTITION BY day_of_week)", 2)))
def q_daily_baseline(spark, sf):
    return _windowed(spark, sf, trends.daily_baseline, "daily_avg_speed")


@register("speed_vs_daily", _window_sql(
    "speed_diff_from_daily_avg", rnd_sql("s - AVG(s) OVER (PARTITION BY day_of_week)", 2)))
def q_speed_vs_daily(spark, sf):
    return _windowed(spark, sf, trends.speed_vs_daily, "speed_diff_from_daily_avg")


@register("speed_change_prev_hour", _window_sql(
    "speed_change_from_prev_hour",
    rnd_sql("s - COALESCE(LAG(s) OVER (PARTITION BY day_of_week ORDER BY hour_of_day), s)", 2)))
def q_speed_change_prev_hour(spark, sf):
    return _windowed(spark, sf, trends.speed_change_prev_hour, "speed_change_from_prev_hour")


@register("speed_rank", _window_sql(
    "speed_rank", "CAST(RANK() OVER (PARTITION BY day_of_week ORDER BY s DESC) AS INTEGER)"))
def q_speed_rank(spark, sf):
    return _windowed(spark, sf, trends.speed_rank, "speed_rank")


@register("traffic_trends", _trend_sql())
def q_traffic_trends(spark, sf):
    return trends.traffic_trends(view(spark, sf, "readings"))


@register("traffic_trends_segment", _trend_sql("segment_id"))
def q_traffic_trends_segment(spark, sf):
    """Batch form of the per-segment report: every segment at once."""
    return trends.traffic_trends(view(spark, sf, "readings"), by=["segment_id"])


@register("traffic_trends_one_segment", _trend_sql(where=f"WHERE segment_id = {TREND_SEGMENT}"))
def q_traffic_trends_one_segment(spark, sf):
    """Point form: existence check (raises when the id is unknown), then the
    report for one segment; the id filter reaches the parquet scan."""
    trends.require_segment(view(spark, sf, "segments"), TREND_SEGMENT)
    readings = view(spark, sf, "readings")
    return trends.traffic_trends(readings, segment_id=TREND_SEGMENT)


_LATEST_SQL = (duck_with("readings") +
               "SELECT segment_id, current_speed, congestion_score, reading_ts, reading_id FROM ("
               "SELECT *, ROW_NUMBER() OVER (PARTITION BY segment_id ORDER BY reading_ts DESC, reading_id DESC) AS rn "
               "FROM readings) t WHERE rn = 1")


@register("latest_reading", _LATEST_SQL)
def q_latest_reading(spark, sf):
    return latest.latest_per_segment(view(spark, sf, "readings"))


@register("congestion_level", duck_with("readings") +
          "SELECT reading_id, congestion_score, CASE WHEN congestion_score IS NULL THEN NULL "
          "WHEN congestion_score < 35e-2 THEN 'LIGHT' WHEN congestion_score < 65e-2 THEN 'MODERATE' "
          "ELSE 'HEAVY' END AS congestion_level FROM readings")
def q_congestion_level(spark, sf):
    r = view(spark, sf, "readings")
    return r.select("reading_id", "congestion_score",
                    congestion_level(F.col("congestion_score")).alias("congestion_level"))


@register("orphan_readings", duck_with("readings", "small_segments") +
          "SELECT reading_id, segment_id FROM readings r WHERE NOT EXISTS "
          "(SELECT 1 FROM small_segments s WHERE s.segment_id = r.segment_id)")
def q_orphan_readings(spark, sf):
    _, orphans = integrity.foreign_key(view(spark, sf, "readings"), view(spark, sf, "small_segments"),
                                       "segment_id")
    return orphans.select("reading_id", "segment_id")


@register("segment_exists", duck_with("readings", "small_segments") +
          "SELECT segment_id, EXISTS (SELECT 1 FROM small_segments s WHERE s.segment_id = r.segment_id) "
          "AS segment_exists FROM (SELECT DISTINCT segment_id FROM readings) r")
def q_segment_exists(spark, sf):
    ids = view(spark, sf, "readings").select("segment_id").distinct()
    return integrity.exists_flag(ids, view(spark, sf, "small_segments"), "segment_id", "segment_exists")
