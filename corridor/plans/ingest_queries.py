"""Queries over `raw_traffic`: validation, quarantine, score fill, dedupe, accounting."""

from __future__ import annotations

from pyspark.sql import functions as F

from corridor.operators import accounting, transform, validate
from corridor.plans.catalog import clamp_sql, register, rnd_sql
from corridor.plans.views import duck_with, view

_FILL = (f"CASE WHEN sc IS NULL THEN (CASE WHEN spd >= 5e1 THEN 0e0 ELSE "
         f"{clamp_sql(rnd_sql('1e0 - spd / 5e1', 2), '0e0', '1e0')} END) ELSE sc END")

_STAGED = duck_with("raw_traffic").rstrip() + """,
v AS (SELECT ordinal, segment_id, current_speed, TRY_CAST(segment_id AS BIGINT) AS seg,
        TRY_CAST(current_speed AS DOUBLE) AS spd, congestion_score AS sc, reading_ts FROM raw_traffic),
s AS (SELECT *, concat_ws(';',
   CASE WHEN segment_id IS NULL THEN 'segment_id_missing' END,
   CASE WHEN segment_id IS NOT NULL AND seg IS NULL THEN 'segment_id_invalid' END,
   CASE WHEN current_speed IS NULL THEN 'current_speed_missing' END,
   CASE WHEN current_speed IS NOT NULL AND (spd IS NULL OR isnan(spd) OR isinf(spd)) THEN 'current_speed_invalid' END,
   CASE WHEN NOT isnan(spd) AND NOT isinf(spd) AND spd < 0 THEN 'current_speed_negative' END,
   CASE WHEN sc IS NOT NULL AND isnan(sc) THEN 'congestion_score_invalid' END,
   CASE WHEN NOT isnan(sc) AND (sc < 0 OR sc > 1) THEN 'congestion_score_out_of_range' END) AS reason
   FROM v)
"""

_VALID = (_STAGED + f"SELECT ordinal, seg AS segment_id, spd AS current_speed, {_FILL} AS congestion_score, "
          f"reading_ts FROM s WHERE reason = ''")


def _validated(spark, sf, raw=None):
    raw = raw if raw is not None else view(spark, sf, "raw_traffic")
    return validate.validate_traffic(raw, ts="reading_ts")


@register("traffic_validate", _VALID)
def q_traffic_validate(spark, sf):
    return _validated(spark, sf).valid


@register("traffic_rejects", _STAGED + "SELECT ordinal, reason FROM s WHERE reason <> ''")
def q_traffic_rejects(spark, sf):
    return _validated(spark, sf).rejected.select("ordinal", "reason")


@register("congestion_fill", _STAGED + f"SELECT ordinal, spd AS current_speed, {_FILL} AS congestion_score "
          "FROM s WHERE reason = '' AND sc IS NULL")
def q_congestion_fill(spark, sf):
    raw = view(spark, sf, "raw_traffic").filter(F.col("congestion_score").isNull())
    return _validated(spark, sf, raw).valid.select("ordinal", "current_speed", "congestion_score")


@register("traffic_dedupe", _STAGED + f"""SELECT segment_id, current_speed, congestion_score, reading_ts FROM (
  SELECT seg AS segment_id, spd AS current_speed, {_FILL} AS congestion_score, reading_ts,
    ROW_NUMBER() OVER (PARTITION BY seg, reading_ts ORDER BY ordinal DESC) AS rn
  FROM s WHERE reason = '') t WHERE rn = 1""")
def q_traffic_dedupe(spark, sf):
    return transform.transform_traffic(_validated(spark, sf).valid, ts="reading_ts")


@register("ingest_accounting", _STAGED + """SELECT
  CAST((SELECT COUNT(*) FROM s) AS BIGINT) AS received,
  CAST((SELECT COUNT(*) FROM s WHERE reason = '') AS BIGINT) AS valid,
  CAST((SELECT COUNT(*) FROM s WHERE reason <> '') AS BIGINT) AS rejected,
  CAST((SELECT COUNT(*) FROM (SELECT DISTINCT seg, reading_ts FROM s WHERE reason = '') d) AS BIGINT) AS loaded""")
def q_ingest_accounting(spark, sf):
    return accounting.ingest_accounting(_validated(spark, sf).staged, ["segment_id", "reading_ts"])
