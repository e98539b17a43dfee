"""Literal goldens: cases from the reference's own tests and hand arithmetic (FIXTURES.md A2)."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from corridor.functions import geometry as geo
from corridor.functions.geodesy import vincenty_np
from corridor.operators import model, spatial, transform, validate


def _json_rows(spark, rows):
    """Records as VARIANT columns, exactly as a JSON feed delivers them."""
    import json
    df = spark.createDataFrame([(json.dumps(r),) for r in rows], "j string")
    keys = sorted({k for r in rows for k in r})
    v = df.select(F.parse_json("j").alias("r"), F.monotonically_increasing_id().alias("ordinal"))
    return v.select("ordinal", *[F.try_variant_get("r", f"$.{k}", "variant").alias(k) for k in keys])


def test_traffic_coercion(spark):
    raw = _json_rows(spark, [{"segment_id": "123456", "current_speed": "45.5", "congestion_score": 0.25}])
    valid, rejected = validate.validate_traffic(raw)
    r = valid.first()
    assert (r.segment_id, r.current_speed, r.congestion_score) == (123456, 45.5, 0.25)
    assert rejected.count() == 0


@pytest.mark.parametrize("speed,score", [(10.0, 0.8), (60.0, 0.0), (50.0, 0.0), (0.0, 1.0)])
def test_congestion_fill(spark, speed, score):
    raw = _json_rows(spark, [{"segment_id": 1, "current_speed": speed}])
    assert validate.validate_traffic(raw).valid.first().congestion_score == score


def test_traffic_rejects(spark):
    raw = _json_rows(spark, [{"segment_id": "x", "current_speed": 1},
                             {"segment_id": 1, "current_speed": "bad"},
                             {"segment_id": 1, "current_speed": -1.5},
                             {"segment_id": 1, "current_speed": 5, "congestion_score": 1.5},
                             {"current_speed": 5},
                             {"segment_id": "12.0", "current_speed": 5},
                             {"segment_id": 12.5, "current_speed": 5}])
    valid, rejected = validate.validate_traffic(raw)
    reasons = {r.ordinal: r.reason for r in rejected.collect()}
    assert sorted(reasons.values()) == sorted([
        "segment_id_invalid", "current_speed_invalid", "current_speed_negative",
        "congestion_score_out_of_range", "segment_id_missing", "segment_id_invalid"])
    assert [r.segment_id for r in valid.collect()] == [12]


def test_default_timestamp_per_record(spark):
    raw = _json_rows(spark, [{"segment_id": 1, "current_speed": 5}, {"segment_id": 1, "current_speed": 6}])
    valid, _ = validate.validate_traffic(raw, ingest_ts=F.lit(dt.datetime(2024, 1, 1)).cast("timestamp"))
    assert valid.select("timestamp").distinct().count() == 2
    assert transform.transform_traffic(valid).count() == 2


def test_rain_alias(spark):
    raw = _json_rows(spark, [{"latitude": 37.7, "longitude": -122.4, "precipitation": 2.5}])
    assert validate.validate_weather(raw).valid.first().rain_intensity == 2.5


@pytest.mark.parametrize("sev,status,exp_sev,exp_status", [
    (4, "OPEN", "critical", "active"),
    ("minor road spill", "clear", "low", "cleared"),
    ("4", "pending", "medium", "resolved"),
    (True, 3, "low", "active"),
    (None, None, "medium", "active"),
    (" Fatal crash ", "Closed", "critical", "resolved"),
])
def test_normalizers(spark, sev, status, exp_sev, exp_status):
    raw = _json_rows(spark, [{"incident_type": "accident", "latitude": 37.7, "longitude": -122.4,
                              "severity": sev, "status": status}])
    r = validate.validate_incident(raw).valid.first()
    assert (r.severity, r.status) == (exp_sev, exp_status)


def test_severity_array_rejected(spark):
    raw = _json_rows(spark, [{"incident_type": "accident", "latitude": 37.7, "longitude": -122.4,
                              "severity": [1, 2]}])
    valid, rejected = validate.validate_incident(raw)
    assert valid.count() == 0 and rejected.first().reason == "severity_invalid"


@pytest.mark.parametrize("gtype,coords,ok,npts", [
    ("linestring", [[0, 0], [1, 1]], True, 2),
    ("polygon", [[[0, 0], [1, 0], [1, 1], [0, 0]]], True, 4),
    ("polyline", [[0, 0], [1, 1]], True, 2),
    ("circle", [[0, 0], [1, 1]], False, None),
    ("linestring", [[0, 0]], False, None),
    ("polygon", [[[0, 0], [1, 0], [1, 1]]], False, None),
    ("polygon", [[[0, 0], [1, 0], [1, 1], [0, 1]]], True, 5),
    ("polygon", [[0, 0], [1, 0], [1, 1], [0, 1]], False, None),
    ("linestring", [[[0, 0], [1, 1]]], False, None),
])
def test_construction_geometry(spark, gtype, coords, ok, npts):
    raw = _json_rows(spark, [{"geometry_type": gtype, "coordinates": coords, "start_date": "2024-03-01T00:00:00Z"}])
    valid, rejected = validate.validate_construction(raw)
    if not ok:
        assert valid.count() == 0 and rejected.count() == 1
        return
    r = valid.first()
    ring = r.rings[0]
    assert len(ring) == npts
    if gtype == "polygon":
        assert (ring[0].x, ring[0].y) == (ring[-1].x, ring[-1].y)


def test_dedupe_keep_last(spark):
    t = dt.datetime(2024, 1, 1, 8)
    df = spark.createDataFrame([(0, 1, 30.0, 0.4, t), (1, 1, 25.0, 0.5, t), (2, 2, 50.0, 0.0, t)],
                               "ordinal long, segment_id long, current_speed double, congestion_score double, "
                               "timestamp timestamp")
    out = {r.segment_id: (r.current_speed, r.congestion_score) for r in transform.transform_traffic(df).collect()}
    assert out == {1: (25.0, 0.5), 2: (50.0, 0.0)}


def test_ewkt(spark):
    df = spark.createDataFrame([(37.7749, -122.4194)], "lat double, lon double")
    assert df.select(geo.ewkt_point(F.col("lon"), F.col("lat"))).first()[0] == "SRID=4326;POINT(-122.4194 37.7749)"
    line = F.array(geo.xy(F.lit(-122.4), F.lit(37.7)), geo.xy(F.lit(-122.5), F.lit(37.8)))
    assert df.select(geo.ewkt_linestring(line)).first()[0] == "SRID=4326;LINESTRING(-122.4 37.7, -122.5 37.8)"
    rings = F.array(F.array(geo.xy(F.lit(0.5), F.lit(1.0)), geo.xy(F.lit(2.0), F.lit(1.0)),
                            geo.xy(F.lit(0.5), F.lit(1.0))))
    text = df.select(geo.ewkt_polygon(rings).alias("t")).first().t
    assert text == "SRID=4326;POLYGON((0.5 1.0, 2.0 1.0, 0.5 1.0))"
    back = df.select(geo.parse_ewkt(F.lit(text)).alias("g")).first().g
    assert back.srid == 4326 and back.type == "Polygon" and back.rings[0][1].x == 2.0


def test_bad_viewport():
    with pytest.raises(ValueError):
        geo.check_box(10, 0, 5, 1)
    with pytest.raises(ValueError):
        geo.check_box(0, 1, 1, 1)


@pytest.mark.parametrize("a,b,hit", [
    ((-1, 0.5), (2, 0.5), True),      # horizontal through
    ((1, 1), (2, 2), True),           # touches the corner
    ((0.2, 0.2), (0.8, 0.7), True),   # inside
    ((-1, 0.5), (0.5, 2.1), False),   # diagonal past the corner
    ((2, 0), (3, 1), False),          # outside
])
def test_line_box(spark, a, b, hit):
    pts = F.array(geo.xy(F.lit(float(a[0])), F.lit(float(a[1]))), geo.xy(F.lit(float(b[0])), F.lit(float(b[1]))))
    got = spark.range(1).select(geo.line_box_intersects(pts, (0.0, 0.0, 1.0, 1.0))).first()[0]
    assert got == hit


def _predict(spark, length, limit, c, rain, temp):
    df = spark.createDataFrame([(length, limit, c, rain, temp)],
                               "length double, speed_limit double, congestion_score double, "
                               "rain_intensity double, temperature double")
    r = model.predict_response(*[F.col(x) for x in df.columns])
    return df.select(*[v.alias(k) for k, v in r.items()]).first()


def test_predict(spark):
    assert _predict(spark, 1000.0, 36.0, 0.0, 0.0, 20.0).predicted_time_seconds == 100.0
    assert _predict(spark, 1000.0, 36.0, 1.0, 0.0, 20.0).predicted_time_seconds == 400.0
    r = _predict(spark, 5000.0, 100.0, 0.5, 2.0, 15.0)
    assert (r.predicted_time_seconds, r.free_flow_time_seconds, r.congestion_multiplier) == (477.0, 180.0, 2.65)
    r = _predict(spark, 6500.0, 100.0, 0.28, 0.0, 16.5)
    assert (r.predicted_time_seconds, r.free_flow_time_seconds) == (438.75, 234.0)


def test_non_positive_length_rejected(spark):
    df = spark.createDataFrame([(0.0, 50.0, 0.5)], "length double, speed_limit double, congestion_score double")
    valid, rejected = validate.validate_prediction_request(df)
    assert valid.count() == 0 and rejected.first().reason == "length_invalid"


def _fit_rows():
    return [(1000.0, 36.0, i / 100, float(i % 5), 20.0, 100 * (1.2 + 2.5 * (i / 100) + 0.1 * (i % 5)))
            for i in range(100)]


def _per_row_gd(rows, w, epochs, lr):
    """Brute force: the per-sample update loop, row by row."""
    feats, ys = [], []
    for length, limit, c, rain, temp, actual in rows:
        ff = length / (limit / 3.6)
        feats.append((1.0, max(0.0, min(1.0, c)), max(0.0, rain), abs(temp - 20.0)))
        ys.append(actual / ff)
    w = list(w)
    n = len(feats)
    for _ in range(epochs):
        g = [0.0] * 4
        for x, y in zip(feats, ys):
            e = sum(wi * xi for wi, xi in zip(w, x)) - y
            for j in range(4):
                g[j] += (2.0 / n) * e * x[j]
        w = [w[j] - lr * g[j] for j in range(4)]
        w = [max(0.5, w[0]), max(0.0, w[1]), max(0.0, w[2]), max(0.0, w[3])]
    return w


def test_fit(spark):
    df = spark.createDataFrame(_fit_rows(), "length double, speed_limit double, congestion_score double, "
                                            "rain_intensity double, temperature double, actual_time double")
    res = model.fit(df, epochs=1000, lr=0.05)
    w = res["weights"]
    assert res["status"] == "success" and res["samples"] == 100
    assert abs(w["w0"] - 1.2) < 0.3 and abs(w["w1"] - 2.5) < 0.3 and abs(w["w2"] - 0.1) < 0.1
    tight = (1.19959772, 2.50067932, 0.10001996, 0.01)
    assert all(abs(a - b) < 1e-7 for a, b in zip((w["w0"], w["w1"], w["w2"], w["w3"]), tight))
    assert [h["epoch"] for h in res["history"]] == [0, 100, 200, 300, 400, 500, 600, 700, 800, 900, 999]
    assert res["history"][-1]["mse"] == res["final_loss"]
    brute = _per_row_gd(_fit_rows(), model.DEFAULT_WEIGHTS.values(), 1000, 0.05)
    assert all(abs(a - b) < 1e-8 for a, b in zip((w["w0"], w["w1"], w["w2"], w["w3"]), brute))


def test_fit_empty(spark):
    df = spark.createDataFrame([(1000.0, 36.0, None)], "length double, speed_limit double, actual_time double")
    res = model.fit(df)
    assert res["status"] == "skipped" and res["weights"] == model.DEFAULT_WEIGHTS
    assert res["reason"] == "no usable rows"
    assert model.fit(df.limit(0))["reason"] == "empty input"


def test_spheroid_distance():
    def dms(d, m, s):
        return d + m / 60 + s / 3600
    d = vincenty_np([dms(144, 25, 29.52440)], [-dms(37, 57, 3.72030)],
                    [dms(143, 55, 35.38390)], [-dms(37, 39, 10.15610)])[0]
    assert abs(d - 54972.271) < 1e-3
    assert abs(vincenty_np([0.0], [0.0], [1.0], [0.0])[0] - 111319.491) < 1e-3
    assert math.isfinite(vincenty_np([0.0], [0.0], [179.7], [0.3])[0])


def test_nearest_to_point_ties(spark):
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    df = spark.createDataFrame([(1, 0.0, 0.0, t1), (2, 0.0, 0.0, t2), (3, 0.0, 0.0, t2), (4, 5.0, 5.0, t2)],
                               "id long, longitude double, latitude double, timestamp timestamp")
    assert spatial.nearest_to_point(df, 0.1, 0.1).first().id == 2


def test_features_are_written_one_per_line(spark, tmpdir_path):
    from corridor.operators import incidents as inc
    from corridor.sinks import tables
    df = spark.createDataFrame([(1, 0.5, 1.0), (2, 2.0, 3.0)], "id long, lon double, lat double")
    feats = df.select("id", inc.point_feature(F.col("lon"), F.col("lat"), {"id": F.col("id")}).alias("feature"))
    import json
    tables.write_features(feats, f"{tmpdir_path}/features")
    parsed = sorted((json.loads(r.value) for r in spark.read.text(f"{tmpdir_path}/features").collect()),
                    key=lambda f: f["properties"]["id"])
    assert [f["type"] for f in parsed] == ["Feature", "Feature"]
    assert [f["properties"]["id"] for f in parsed] == [1, 2]
    assert parsed[0]["geometry"] == {"type": "Point", "coordinates": [0.5, 1.0]}


def test_require_segment(spark):
    from corridor.operators import trends
    segs = spark.createDataFrame([(1,), (2,)], "segment_id long")
    trends.require_segment(segs, 2)
    with pytest.raises(LookupError):
        trends.require_segment(segs, 3)


def test_integer_field_edge_values(spark):
    from corridor.functions import fields as fl
    df = spark.createDataFrame([(1, 12.0), (2, float("nan")), (3, float("inf")), (4, 1e30), (5, 12.5)],
                               "i long, v double")
    got = {r.i: r.x for r in df.select("i", fl.as_long(df, "v").alias("x")).collect()}
    assert got == {1: 12, 2: None, 3: None, 4: None, 5: None}


def test_incident_filter_arguments(spark):
    from corridor.operators import incidents as inc
    df = spark.createDataFrame([(1, "active", "high", -122.4, 37.7, dt.datetime(2024, 1, 2)),
                                (2, "active", "low", -122.4, 37.7, dt.datetime(2024, 1, 3)),
                                (3, "cleared", "high", -122.4, 37.7, dt.datetime(2024, 1, 4)),
                                (4, "active", "high", 10.0, 10.0, dt.datetime(2024, 1, 1))],
                               "incident_id long, status string, severity string, longitude double, "
                               "latitude double, created_at timestamp")
    assert [r.incident_id for r in inc.active_incidents(df).collect()] == [2, 1, 4]      # newest first
    box = (-123.0, 37.0, -122.0, 38.0)
    assert [r.incident_id for r in inc.active_incidents(df, "high", box).collect()] == [1]
    with pytest.raises(ValueError):
        inc.active_incidents(df, severity="urgent")
    with pytest.raises(ValueError):
        inc.active_incidents(df, box=(-123.0, None, -122.0, 38.0))
    with pytest.raises(ValueError):
        inc.active_incidents(df, box=(-122.0, 37.0, -123.0, 38.0))
    assert inc.active_incidents(df, box=(None, None, None, None)).count() == 3


def test_validators_on_typed_columns(spark):
    t = dt.datetime(2024, 1, 1, 8)
    raw = spark.createDataFrame([(0, 5, 40.0, None, t), (1, 6, float("nan"), None, t), (2, 7, 55.0, 1.2, t)],
                                "ordinal long, segment_id int, current_speed double, congestion_score double, "
                                "timestamp timestamp")
    valid, rejected = validate.validate_traffic(raw)
    assert [(r.segment_id, r.congestion_score) for r in valid.collect()] == [(5, 0.2)]
    assert sorted(r.reason for r in rejected.collect()) == ["congestion_score_out_of_range",
                                                            "current_speed_invalid"]
    inc = spark.createDataFrame([(0, "debris", 37.7, -122.4, 2, True)],
                                "ordinal long, incident_type string, latitude double, longitude double, "
                                "severity int, status boolean")
    r = validate.validate_incident(inc).valid.first()
    assert (r.severity, r.status) == ("medium", "active")


def test_trend_window_semantics(spark):
    """Monday 2024-01-01: 08:00 speeds 10 and 20, 09:00 40, 11:00 40 (no 10:00).
    Hourly means 15, 40, 40; the daily mean is unweighted (95/3); LAG uses
    the previous hour present (11:00 compares with 09:00); equal speeds share
    a rank and the next rank skips."""
    from corridor.operators.trends import traffic_trends
    day = dt.datetime(2024, 1, 1)
    rows = [(1, 1, 10.0, 0.2, day.replace(hour=8)), (2, 1, 20.0, 0.4, day.replace(hour=8, minute=30)),
            (3, 2, 40.0, None, day.replace(hour=9)), (4, 1, 40.0, 0.1, day.replace(hour=11))]
    df = spark.createDataFrame(rows, "reading_id long, segment_id long, current_speed double, "
                                     "congestion_score double, reading_ts timestamp")
    got = [(r.day_name, r.hour_of_day, r.avg_speed, r.avg_congestion, r.reading_count, r.daily_avg_speed,
            r.speed_diff_from_daily_avg, r.speed_change_from_prev_hour, r.speed_rank)
           for r in traffic_trends(df, ordered=True).collect()]
    assert got == [("Monday", 8, 15.0, 0.3, 2, 31.67, -16.67, 0.0, 3),
                   ("Monday", 9, 40.0, None, 1, 31.67, 8.33, 25.0, 1),
                   ("Monday", 11, 40.0, 0.1, 1, 31.67, 8.33, 0.0, 1)]
