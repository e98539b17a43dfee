"""Answers kept up to date by the stream, so that no query scans the history of readings.

Each is a table of commits (``sinks.commits``) whose rows are small summaries of a
batch, made so that the summaries of any split of the readings merge to that of all
of them: the latest reading per segment, the sums of an hour's readings, the sums of
a least-squares fit. The answer merges what is there: one folded pack per tier and the
batches since. A replayed batch's summary takes the place of its earlier one, so late, repeated and
changed batches in any order give the answer of the full history, exactly.

======================  ==========================================  =====================
kept                    summary of a batch                          answer
======================  ==========================================  =====================
``latest_readings``     latest reading per segment of the batch     ``latest_per_segment``
``hourly_cells``        sums per (day,) segment, weekday and hour   ``traffic_trends``
``training_sums``       one row of sums and products                ``model.fit``
======================  ==========================================  =====================
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corridor.operators import model, trends
from corridor.operators.latest import latest_per_segment, time_column
from corridor.sinks.commits import FAN, CommitTable


class Kept:
    """A summary table: ``part`` summarises a batch, ``fold`` merges summaries."""

    def __init__(self, spark: SparkSession, path: str, part: Callable[[DataFrame], DataFrame],
                 fold: Callable[[DataFrame], DataFrame], days: bool = False, sort: Sequence[str] = ()):
        self.table = CommitTable(spark, path, days, sort)
        self.part, self.fold = part, fold

    def add(self, rows: DataFrame, batch: int | None = None, stream: str = "batch") -> int:
        """Summarise a batch in place of any earlier attempt; returns the summary's rows."""
        return self.table.write(self.part(rows), batch, stream)

    def read(self) -> DataFrame:
        """The merged summary of all batches."""
        return self.fold(self.table.read())

    def compact(self, fan: int = FAN) -> int:
        return self.table.compact(self.fold, fan)


def latest_readings(spark: SparkSession, path: str, ts: str = "timestamp") -> Kept:
    """One row per segment and batch; ``read()`` equals ``latest_per_segment`` of all readings."""
    def newest(rows: DataFrame) -> DataFrame:
        return latest_per_segment(rows, ts=ts)

    return Kept(spark, path, newest, newest, sort=("segment_id",))


class HourlyCells(Kept):
    """Cells per day, segment, weekday and hour; the weekday report reads cells only."""

    def __init__(self, spark: SparkSession, path: str, ts: str = "timestamp"):
        key = ["dt", "segment_id"]

        def cells(rows: DataFrame) -> DataFrame:
            return trends.hour_cells(rows.withColumn("dt", F.to_date(F.col(ts))), by=key, ts=ts)

        super().__init__(spark, path, cells, lambda some: trends.add_cells(some, key), days=True, sort=("segment_id",))

    def report(self, by: Sequence[str] = (), segment_id: int | None = None, first_day: date | None = None,
               last_day: date | None = None, ordered: bool = False) -> DataFrame:
        """``traffic_trends`` of all committed readings, or of a range of days, which opens only their folders."""
        cells = trends.filter_segment(self.table.read(first_day, last_day), segment_id)
        return trends.trend_report(trends.profile_of_cells(trends.add_cells(cells, by), by, keep_raw=True), by, ordered)


def training_sums(spark: SparkSession, path: str) -> Kept:
    """The 15 sums of the travel-time fit per batch of raw training rows."""
    return Kept(spark, path, lambda rows: model.gram(model.training_rows(rows)), model.add_grams)


def fit_kept(sums: Kept, weights: dict | None = None, **options) -> dict:
    """``model.fit`` over all batches whose sums are kept; reads one row per batch or pack."""
    return model.fit_from_gram(sums.read().first().asDict(), weights, **options)


class ReadingSummaries:
    """What the traffic feed keeps next to its readings, under ``out``."""

    def __init__(self, spark: SparkSession, out: str):
        self.latest = latest_readings(spark, f"{out}/latest_readings")
        self.cells = HourlyCells(spark, f"{out}/hourly_cells")

    def add(self, readings: DataFrame, batch: int, stream: str) -> None:
        """Summaries of a committed batch of readings."""
        ts = time_column(readings, None, "timestamp")
        self.latest.add(readings.select("segment_id", "current_speed", "congestion_score", ts, "reading_id"), batch, stream)
        self.cells.add(readings, batch, stream)

    def withdraw(self, batch: int, stream: str) -> None:
        for kept in (self.latest, self.cells):
            kept.table.withdraw(batch, stream)

    def compact(self, fan: int = FAN) -> None:
        self.latest.compact(fan)
        self.cells.compact(fan)
