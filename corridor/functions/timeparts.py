"""Calendar parts of a timestamp, taken in the session zone (always UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day names for day-of-week 0..6 (0 = Sunday).
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]


def day_of_week(ts: Column) -> Column:
    """0 = Sunday ... 6 = Saturday (Spark's ``dayofweek`` is 1-based)."""
    return (F.dayofweek(ts) - 1).cast("int")


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts).cast("int")


def day_name(dow: Column) -> Column:
    """Locale-independent day name; anything outside 0..6 is 'Unknown'."""
    names = F.array(*[F.lit(n) for n in DAY_NAMES])
    return F.when(dow.between(0, 6), F.element_at(names, (dow + 1).cast("int"))) \
        .otherwise(F.lit("Unknown"))
