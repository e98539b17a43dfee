"""Latest reading per segment and the segment x latest-reading left join.

The top-1 is an ordinary aggregate that Spark combines map-side before the
shuffle, so each task sends one candidate per segment it saw, and a segment
holding a third of all readings costs one row per task, not a third of the data
in one task. With an integer tiebreak the order key is one fixed-width number
(time and id) and every column a ``max_by`` on it: a hash aggregate, without a sort of the
raw rows. Other tiebreaks use ``max(struct)``.

Readings may come from a view (``reading_ts``) or from the stored table
(``timestamp``); where ``ts`` is not given, whichever is there is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LATEST_COLS = ("current_speed", "congestion_score", "reading_ts", "reading_id")


def time_column(df: DataFrame, ts: str | None, *names: str) -> str:
    """``ts``, or the first of ``names`` that ``df`` has."""
    return ts or next((n for n in names if n in df.columns), names[0])


def latest_per_segment(readings: DataFrame, key: str = "segment_id", ts: str | None = None,
                       tiebreak: str = "reading_id", cols=None) -> DataFrame:
    """Group top-1 by timestamp; equal timestamps resolved by the larger id."""
    ts = time_column(readings, ts, "reading_ts", "timestamp")
    cols = tuple(c if c != "reading_ts" else ts for c in (cols or LATEST_COLS))
    integral = isinstance(readings.schema[tiebreak].dataType, (T.IntegerType, T.LongType))
    if integral and not isinstance(readings.schema[ts].dataType, T.StringType):
        # Micros and id in one number: the id moved to 0 .. 2^64 - 1 below the micros.
        order = F.expr(f"""CAST(unix_micros(CAST(`{ts}` AS TIMESTAMP)) * CAST(18446744073709551616 AS DECIMAL(20,0))
                           + `{tiebreak}` + CAST(9223372036854775808 AS DECIMAL(20,0)) AS DECIMAL(38,0))""")
        return readings.groupBy(key).agg(*[F.max_by(c, order).alias(c) for c in cols]).select(key, *cols)
    payload = [c for c in cols if c not in (ts, tiebreak)]
    best = F.max(F.struct(F.col(ts).alias("_k1"), F.col(tiebreak).alias("_k2"),
                          *[F.col(c) for c in payload]))
    names = {ts: "_k1", tiebreak: "_k2"}
    return (readings.groupBy(key).agg(best.alias("_r"))
            .select(key, *[F.col(f"_r.{names.get(c, c)}").alias(c) for c in cols]))


def segments_with_latest(segments: DataFrame, readings: DataFrame,
                         key: str = "segment_id", selective: bool = False) -> DataFrame:
    """Every segment with its latest reading; segments without one keep NULLs.

    The aggregated side is already hash-partitioned on ``key``; Spark only
    shuffles (or, when AQE measures it small, broadcasts) the segments.

    ``selective=True`` is for a filtered segment set (a viewport, one id):
    readings are first semi-joined with the selected ids, so only their
    readings are aggregated instead of the whole table. The id list is
    broadcast when its measured size is under the threshold, otherwise the
    semi-join shuffles on the key like any join.
    """
    if selective:
        readings = readings.join(segments.select(key), key, "left_semi")
    latest = latest_per_segment(readings, key=key)
    return segments.join(latest, key, "left")
