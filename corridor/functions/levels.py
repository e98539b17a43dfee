"""Congestion level label for a score in [0, 1]."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Level thresholds (score below 0.35 light, below 0.65 moderate).
LIGHT_BELOW = 0.35
MODERATE_BELOW = 0.65


def congestion_level(score: Column) -> Column:
    """'LIGHT' / 'MODERATE' / 'HEAVY'; a NULL score has no level."""
    return (F.when(score.isNull(), F.lit(None).cast("string"))
            .when(score < F.lit(LIGHT_BELOW), F.lit("LIGHT"))
            .when(score < F.lit(MODERATE_BELOW), F.lit("MODERATE"))
            .otherwise(F.lit("HEAVY")))
