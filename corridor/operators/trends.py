"""Hourly speed/congestion trend report with window comparisons.

Plan shape: scan -> (optional segment filter, pushed to the scan) ->
partial hash aggregate on (day, hour) -> shuffle of at most 168 rows per
task -> final aggregate -> one small shuffle on day for the windows. The raw
readings are shuffled only after map-side combining, so a hot segment or a
hot hour costs no more than any other key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corridor.functions.numeric import mean_of, mean_parts, rnd
from corridor.functions.timeparts import day_name, day_of_week, hour_of_day


def filter_segment(readings: DataFrame, segment_id: int | None,
                   key: str = "segment_id") -> DataFrame:
    """Optional segment filter (one code path for both report variants)."""
    if segment_id is None:
        return readings
    return readings.filter(F.col(key) == F.lit(int(segment_id)))


def require_segment(segments: DataFrame, segment_id: int, key: str = "segment_id") -> None:
    """Existence test for a requested id; raises ``LookupError`` if absent."""
    if segments.filter(F.col(key) == F.lit(int(segment_id))).isEmpty():
        raise LookupError(f"no road segment {segment_id}")


_PARTS = ("exact", "fitting", "n", "total")


def hour_cells(readings: DataFrame, by: Sequence[str] = (), ts: str = "reading_ts",
               speed: str = "current_speed", score: str = "congestion_score") -> DataFrame:
    """Sums and counts of the readings per (``by``..., day_of_week, hour_of_day) that add up over any split of the rows."""
    parts = {f"{name}_{k}": v for name, c in (("speed", speed), ("score", score)) for k, v in mean_parts(F.col(c)).items()}
    return (readings.groupBy(*[F.col(c) for c in by], day_of_week(F.col(ts)).alias("day_of_week"),
                             hour_of_day(F.col(ts)).alias("hour_of_day"))
            .agg(*[v.alias(k) for k, v in parts.items()], F.count(F.lit(1)).alias("readings")))


def add_cells(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Cells of several splits added up, to the coarser key ``by``."""
    sums = [F.sum(c).cast(cells.schema[c].dataType).alias(c)
            for c in [*[f"{n}_{k}" for n in ("speed", "score") for k in _PARTS], "readings"]]
    return cells.groupBy(*by, "day_of_week", "hour_of_day").agg(*sums)


def profile_of_cells(cells: DataFrame, by: Sequence[str] = (), keep_raw: bool = False) -> DataFrame:
    """The hourly profile of cells whose key is (``by``..., day, hour)."""
    def mean(name: str) -> Column:
        return mean_of(*[F.col(f"{name}_{k}") for k in _PARTS])

    out = cells.select(*by, "day_of_week", "hour_of_day", mean("speed").alias("_speed"), mean("score").alias("_congestion"),
                       F.col("readings").cast("int").alias("reading_count"))
    cols = [*by, "day_of_week", "hour_of_day",
            rnd(F.col("_speed"), 2).alias("avg_speed"),
            rnd(F.col("_congestion"), 3).alias("avg_congestion"),
            "reading_count"]
    if keep_raw:
        cols.append("_speed")
    return out.select(*cols)


def hourly_profile(readings: DataFrame, by: Sequence[str] = (), ts: str = "reading_ts",
                   speed: str = "current_speed", score: str = "congestion_score",
                   keep_raw: bool = False) -> DataFrame:
    """Group readings by (``by``..., day_of_week, hour_of_day).

    Averages use an exact decimal sum and one division, so every layout of
    the data gives the same bits (ranks and ties are stable). The unrounded
    speed mean is kept as ``_speed`` when ``keep_raw`` for the windows.
    """
    return profile_of_cells(hour_cells(readings, by, ts, speed, score), by, keep_raw)


def _day_window(by: Sequence[str]):
    return Window.partitionBy(*by, "day_of_week")


def _whole_day(by: Sequence[str]):
    """The whole day, ordered by hour: the same partitioning and order as the
    LAG window, so Spark evaluates both in one Window operator (one sort)."""
    return (_day_window(by).orderBy("hour_of_day")
            .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))


def daily_baseline(by: Sequence[str] = ()) -> Column:
    """Unweighted mean of the hourly means of the same day of week."""
    return rnd(F.avg("_speed").over(_whole_day(by)), 2)


def speed_vs_daily(by: Sequence[str] = ()) -> Column:
    return rnd(F.col("_speed") - F.avg("_speed").over(_whole_day(by)), 2)


def speed_change_prev_hour(by: Sequence[str] = ()) -> Column:
    """Change from the previous hour *present* that day; the first hour gives 0."""
    w = _day_window(by).orderBy("hour_of_day")
    return rnd(F.col("_speed") - F.coalesce(F.lag("_speed").over(w), F.col("_speed")), 2)


def speed_rank(by: Sequence[str] = ()) -> Column:
    """1 = fastest hour of that day; ties share a rank, gaps follow."""
    w = _day_window(by).orderBy(F.col("_speed").desc())
    return F.rank().over(w).cast("int")


def traffic_trends(readings: DataFrame, segment_id: int | None = None,
                   by: Sequence[str] = (), ordered: bool = False, **cols) -> DataFrame:
    """The full trend report (network-wide, one segment, or per ``by`` key).

    ``ordered`` sorts by (``by``..., day, hour) for presentation; leave it off
    when the result feeds another operator (a sort is a range shuffle).
    """
    r = filter_segment(readings, segment_id)
    return trend_report(hourly_profile(r, by=by, keep_raw=True, **cols), by, ordered)


def trend_report(profile: DataFrame, by: Sequence[str] = (), ordered: bool = False) -> DataFrame:
    """The trend report of an hourly profile that kept its unrounded mean."""
    out = profile.select(
        *by, "day_of_week", day_name(F.col("day_of_week")).alias("day_name"), "hour_of_day",
        "avg_speed", "avg_congestion", "reading_count",
        daily_baseline(by).alias("daily_avg_speed"),
        speed_vs_daily(by).alias("speed_diff_from_daily_avg"),
        speed_change_prev_hour(by).alias("speed_change_from_prev_hour"),
        speed_rank(by).alias("speed_rank"),
    )
    return out.orderBy(*by, "day_of_week", "hour_of_day") if ordered else out
