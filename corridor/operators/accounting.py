"""Ingest accounting: received / valid / rejected / loaded for one batch.

Computed from the validator's staged projection in one scan: rows are
grouped by their dedupe key (rejected rows share the NULL key), partially
aggregated map-side, then reduced to one row. No cross join, no driver
round trip; the NULL group is combined map-side like any other key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ingest_accounting(staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    ok = F.col("__reason") == ""
    key = F.when(ok, F.struct(*[F.col(f"__{k}") for k in keys]))
    per_key = staged.groupBy(key.alias("_key")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(ok).alias("v"))
    return per_key.agg(
        F.sum("n").cast("long").alias("received"),
        F.sum("v").cast("long").alias("valid"),
        (F.sum("n") - F.sum("v")).cast("long").alias("rejected"),
        F.count_if(F.col("v") > 0).cast("long").alias("loaded"))
