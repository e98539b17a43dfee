"""Per-record validation with a quarantine, one validator per feed.

Each validator is a single projection: typed output columns plus a
``reason`` string listing every failed rule (';'-joined, in rule order).
``valid`` and ``rejected`` are two filters of that projection, so a record
is never lost: it is either loaded or quarantined with its reasons. All
rules are column expressions, evaluated inside whole-stage codegen.

The projection carries a non-deterministic marker so Catalyst does not
inline the rules into the ``valid``/``rejected`` filters (which would run
every conversion twice). The price: later filters do not move below the
validation either, so filters on raw pass-through columns (an id, a date)
belong on the input frame, before validating.

Output contract: ``(valid_df, rejected_df)``. ``valid_df`` keeps the
pass-through columns (ids, ordinals) followed by the typed fields;
``rejected_df`` keeps the original input columns plus ``reason``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corridor.functions import fields as fl
from corridor.functions import geometry as geo
from corridor.functions import normalize as nz
from corridor.functions.numeric import clamp, rnd

# Fixed value: free-flow speed assumed when a congestion score is derived.
ASSUMED_FREE_FLOW_KMH = 50.0


def _finite(c: Column) -> Column:
    return ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))


class Validated:
    """``valid, rejected = validate_x(...)``; ``staged`` holds both, tagged.

    ``staged`` has the input columns, the typed outputs prefixed ``__`` and
    ``__reason`` ('' when valid); one scan of it serves any accounting.
    """

    def __init__(self, valid: DataFrame, rejected: DataFrame, staged: DataFrame):
        self.valid, self.rejected, self.staged = valid, rejected, staged

    def __iter__(self):
        return iter((self.valid, self.rejected))


def _split(df: DataFrame, out: dict[str, Column], rules: Sequence[tuple[str, Column]],
           keep: Sequence[str] = ()) -> Validated:
    # Rules that only loaded data has: malformed files, and keys checked against a parent table.
    extra = [("malformed_record", F.col("corrupt_record").isNotNull())] if "corrupt_record" in df.columns else []
    extra += [("segment_id_unknown", ~F.col("segment_known"))] if "segment_known" in df.columns else []
    rules = [*extra, *rules]
    reason = F.concat_ws(";", *[F.when(F.coalesce(bad, F.lit(False)), F.lit(r)) for r, bad in rules])
    keep = [c for c in keep if c in df.columns]
    # ``spark_partition_id()`` is non-deterministic, so Catalyst keeps the
    # valid/rejected filters above this projection instead of inlining the
    # rules into them: each row is validated once, not once per consumer.
    staged = df.select("*", *[c.alias(f"__{n}") for n, c in out.items()], reason.alias("__reason"),
                       F.spark_partition_id().alias("__part"))
    barrier = F.col("__part") >= 0
    valid = (staged.filter((F.col("__reason") == "") & barrier)
             .select(*keep, *[F.col(f"__{n}").alias(n) for n in out]))
    rejected = (staged.filter((F.col("__reason") != "") & barrier)
                .select(*df.columns, F.col("__reason").alias("reason")))
    return Validated(valid, rejected, staged)


def default_timestamp(df: DataFrame, ts: str, ingest_ts: Column | None, ordinal: str | None) -> Column:
    """Parsed timestamp, or the arrival time plus the record's position in microseconds.

    The arrival time is ``ingest_ts``, else the landing file's modification time
    (``file_time``, the same on a replay), else the query time. The ordinal is a
    number, or the feed readers' struct with its position as ``pos``.
    """
    parsed = fl.as_timestamp(df, ts)
    base = ingest_ts if ingest_ts is not None else (
        F.col("file_time") if "file_time" in df.columns else F.current_timestamp())
    if ordinal and ordinal in df.columns:
        place = F.col(ordinal)["pos"] if isinstance(df.schema[ordinal].dataType, T.StructType) else F.col(ordinal)
        base = F.timestamp_add("MICROSECOND", place, base)
    if fl.kind(df, ts) == fl.TIMESTAMP:
        base = base.cast(df.schema[ts].dataType)
    return F.coalesce(parsed, base)


def _ts_rules(df: DataFrame, ts: str) -> list[tuple[str, Column]]:
    if fl.kind(df, ts) == fl.TIMESTAMP:
        return []
    return [("timestamp_invalid", fl.present(df, ts) & fl.as_timestamp(df, ts).isNull())]


def fill_congestion(score: Column, speed: Column) -> Column:
    """Missing score: 0 at or above 50 km/h, else ``clamp(round(1 - speed/50, 2))``."""
    derived = F.when(speed >= F.lit(ASSUMED_FREE_FLOW_KMH), F.lit(0.0)) \
        .otherwise(clamp(rnd(F.lit(1.0) - speed / F.lit(ASSUMED_FREE_FLOW_KMH), 2), 0.0, 1.0))
    return F.when(score.isNull(), derived).otherwise(score)


def validate_traffic(raw: DataFrame, ts: str = "timestamp", ordinal: str | None = "ordinal",
                     ingest_ts: Column | None = None, keep: Sequence[str] = ("ordinal",)):
    seg = fl.as_long(raw, "segment_id")
    speed = fl.as_double(raw, "current_speed")
    score = fl.as_double(raw, "congestion_score")
    rules = [
        ("segment_id_missing", ~fl.present(raw, "segment_id")),
        ("segment_id_invalid", fl.present(raw, "segment_id") & seg.isNull()),
        ("current_speed_missing", ~fl.present(raw, "current_speed")),
        ("current_speed_invalid", fl.present(raw, "current_speed") & (speed.isNull() | ~_finite(speed))),
        ("current_speed_negative", _finite(speed) & (speed < 0)),
        ("congestion_score_invalid", fl.present(raw, "congestion_score") & (score.isNull() | F.isnan(score))),
        ("congestion_score_out_of_range", ~F.isnan(score) & ((score < 0) | (score > 1))),
        *_ts_rules(raw, ts),
    ]
    out = {"segment_id": seg, "current_speed": speed,
           "congestion_score": fill_congestion(score, speed),
           ts: default_timestamp(raw, ts, ingest_ts, ordinal)}
    return _split(raw, out, rules, keep)


def validate_weather(raw: DataFrame, ts: str = "timestamp", ordinal: str | None = "ordinal",
                     ingest_ts: Column | None = None, keep: Sequence[str] = ("ordinal", "snapshot_id")):
    lat, lon = fl.as_double(raw, "latitude"), fl.as_double(raw, "longitude")
    temp = fl.as_double(raw, "temperature")
    has_rain = fl.present(raw, "rain_intensity")
    # 'precipitation' stands in when 'rain_intensity' is null or absent.
    rain = F.when(has_rain, fl.as_double(raw, "rain_intensity")) \
        .otherwise(fl.as_double(raw, "precipitation"))
    rain_given = has_rain | fl.present(raw, "precipitation")
    vis = fl.as_double(raw, "visibility")

    def rng(name, c, lo, hi):
        return [(f"{name}_missing", ~fl.present(raw, name)),
                (f"{name}_out_of_range", fl.present(raw, name) &
                 (c.isNull() | F.isnan(c) | (c < lo) | (c > hi)))]

    rules = [
        *rng("latitude", lat, -90.0, 90.0),
        *rng("longitude", lon, -180.0, 180.0),
        ("temperature_invalid", fl.present(raw, "temperature") & temp.isNull()),
        ("rain_intensity_invalid", rain_given & (rain.isNull() | F.isnan(rain) | (rain < 0))),
        ("visibility_invalid", fl.present(raw, "visibility") & (vis.isNull() | F.isnan(vis) | (vis < 0))),
        *_ts_rules(raw, ts),
    ]
    out = {"latitude": lat, "longitude": lon, "temperature": temp, "rain_intensity": rain,
           "visibility": vis, ts: default_timestamp(raw, ts, ingest_ts, ordinal)}
    return _split(raw, out, rules, keep)


def validate_incident(raw: DataFrame, ts: str = "timestamp", ordinal: str | None = "ordinal",
                      ingest_ts: Column | None = None, keep: Sequence[str] = ("ordinal", "incident_id")):
    itype = fl.as_string(raw, "incident_type")
    desc = fl.as_string(raw, "description")
    lat, lon = fl.as_double(raw, "latitude"), fl.as_double(raw, "longitude")
    sev, sev_ok = nz.normalize_severity(raw, "severity")
    rules = [
        ("incident_type_missing", ~fl.present(raw, "incident_type")),
        ("incident_type_invalid", fl.present(raw, "incident_type") &
         (itype.isNull() | (F.length(itype) < 1))),
        ("description_invalid", fl.present(raw, "description") & ~fl.is_string(raw, "description")),
        ("latitude_missing", ~fl.present(raw, "latitude")),
        ("latitude_out_of_range", fl.present(raw, "latitude") &
         (lat.isNull() | F.isnan(lat) | (lat < -90.0) | (lat > 90.0))),
        ("longitude_missing", ~fl.present(raw, "longitude")),
        ("longitude_out_of_range", fl.present(raw, "longitude") &
         (lon.isNull() | F.isnan(lon) | (lon < -180.0) | (lon > 180.0))),
        ("severity_invalid", ~sev_ok),
        *_ts_rules(raw, ts),
    ]
    out = {"incident_type": itype, "description": desc, "latitude": lat, "longitude": lon,
           "severity": sev, "status": nz.normalize_status(raw, "status"),
           ts: default_timestamp(raw, ts, ingest_ts, ordinal)}
    return _split(raw, out, rules, keep)


def validate_construction(raw: DataFrame, ordinal: str | None = "ordinal",
                          keep: Sequence[str] = ("ordinal", "zone_id"), statuses: Sequence[str] | None = None):
    """Construction plans: geometry type, coordinate nesting, ring closing, dates.

    ``coordinates`` may be VARIANT, JSON text, or a typed nested array. Lines
    must be a flat list of >= 2 pairs; polygons a list of rings whose outer
    ring has >= 4 pairs. An open outer ring is closed by appending its first
    point (inner rings untouched). With ``statuses`` (the stored table's domain)
    any other status is rejected as well.
    """
    if fl.kind(raw, "coordinates") == fl.STRING:
        # Parse JSON text once; the nesting checks read the VARIANT several
        # times (Spark keeps an expensive expression used more than once in
        # its own projection instead of inlining it).
        raw = raw.withColumn("coordinates", F.try_parse_json(F.col("coordinates")))
    gtype = nz.normalize_geometry_type(raw, "geometry_type")
    depth, pts2, rings3 = geo.coordinate_nesting(raw, "coordinates")
    start = fl.as_timestamp(raw, "start_date")
    end = fl.as_timestamp(raw, "end_date")
    desc = fl.as_string(raw, "description")
    status = F.coalesce(fl.as_string(raw, "status"), F.lit(nz.ZONE_STATUS_DEFAULT))
    line_ok = (depth == 2) & (F.size(pts2) >= 2)
    poly_ok = (depth == 3) & (F.size(rings3) >= 1) & (F.size(rings3[0]) >= 4)
    rules = [
        ("geometry_type_invalid", gtype.isNull()),
        ("coordinates_invalid", depth.isNull()),
        ("linestring_invalid", (gtype == "LineString") & depth.isNotNull() & ~line_ok),
        ("polygon_invalid", (gtype == "Polygon") & depth.isNotNull() & ~poly_ok),
        ("description_invalid", fl.present(raw, "description") & ~fl.is_string(raw, "description")),
        ("status_invalid", (fl.present(raw, "status") & ~fl.is_string(raw, "status")) | fl.json_null(raw, "status")),
        *([("status_domain", fl.is_string(raw, "status") & ~status.isin(*statuses))] if statuses else []),
        ("start_date_missing", ~fl.present(raw, "start_date")),
        ("start_date_invalid", fl.present(raw, "start_date") & start.isNull()),
        ("end_date_invalid", fl.present(raw, "end_date") & end.isNull()),
    ]
    rings = F.when(gtype == "Polygon", geo.close_outer_ring(rings3)) \
        .otherwise(F.array(pts2))
    out = {"description": desc, "geometry_type": gtype, "rings": geo.to_xy_rings(rings),
           "status": status, "start_date": start, "end_date": end}
    return _split(raw, out, rules, keep)


def validate_prediction_request(df: DataFrame, keep: Sequence[str] = ()):
    """Inputs of the custom prediction: length>0, limit>0, score in [0,1], rain>=0.

    Rain defaults to 0 and temperature to 20 when absent or null.
    """
    length = fl.as_double(df, "length")
    limit = fl.as_double(df, "speed_limit")
    score = fl.as_double(df, "congestion_score")
    rain = F.coalesce(fl.as_double(df, "rain_intensity"), F.lit(0.0))
    temp = F.coalesce(fl.as_double(df, "temperature"), F.lit(20.0))
    rules = [
        ("length_invalid", length.isNull() | F.isnan(length) | (length <= 0)),
        ("speed_limit_invalid", limit.isNull() | F.isnan(limit) | (limit <= 0)),
        ("congestion_score_invalid", score.isNull() | F.isnan(score) | (score < 0) | (score > 1)),
        ("rain_intensity_invalid", F.isnan(rain) | (rain < 0)),
    ]
    out = {"length": length, "speed_limit": limit, "congestion_score": score,
           "rain_intensity": rain, "temperature": temp}
    return _split(df, out, rules, keep)
