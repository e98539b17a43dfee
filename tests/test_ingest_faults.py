"""Ingest without losses: untimed readings, JSON Lines, malformed files, constraints, restarts, and the loop to queries."""

import json
import os

import pytest
from pyspark.sql import functions as F

from corridor.operators import latest, segments, spatial, trends, validate
from corridor.sinks import tables
from corridor.sources.feeds import read_feed
from corridor.streaming import ingest
from tests.test_goldens import _json_rows


def land(folder, *texts):
    os.makedirs(folder, exist_ok=True)
    for i, t in enumerate(texts):
        with open(os.path.join(folder, f"f{i}.json"), "w") as f:
            f.write(t if isinstance(t, str) else json.dumps(t))


def reading(segment, speed, **more):
    return {"segment_id": segment, "current_speed": speed, **more}


def test_untimed_readings_of_two_files_stay_apart(spark, tmpdir_path):
    land(f"{tmpdir_path}/l", {"data": [reading(1, 10)]}, {"data": [reading(1, 10)]}, {"data": [reading(1, 10), reading(1, 11)]})
    for out in ("a", "b"):
        res = ingest.process_traffic(read_feed(spark, f"{tmpdir_path}/l", "traffic"), 0, f"{tmpdir_path}/{out}")
        assert res == {"loaded": 4, "rejected": 0}
    a, b = (sorted((r.reading_id, r.timestamp) for r in spark.read.parquet(f"{tmpdir_path}/{o}/traffic_readings").collect())
            for o in ("a", "b"))
    assert a == b and len({i for i, _ in a}) == 4


def test_json_lines_keep_the_last_record(spark, tmpdir_path):
    t = "2024-01-01T08:00:00Z"
    lines = "\n".join(json.dumps({"data": [reading(1, v, timestamp=t)]}) for v in (10.0, 50.0, 99.0))
    land(f"{tmpdir_path}/l", lines)
    batch = read_feed(spark, f"{tmpdir_path}/l", "traffic", multi_line=False)
    assert ingest.process_traffic(batch, 0, tmpdir_path)["loaded"] == 1
    assert spark.read.parquet(f"{tmpdir_path}/traffic_readings").first().current_speed == 99.0
    q = ingest.start_feed(spark, "traffic", f"{tmpdir_path}/l", f"{tmpdir_path}/s", f"{tmpdir_path}/ck", available_now=True,
                          multi_line=False)
    q.awaitTermination(120)
    assert spark.read.parquet(f"{tmpdir_path}/s/traffic_readings").first().current_speed == 99.0
    row = spark.read.parquet(f"{tmpdir_path}/s/ingest_log").first()
    assert (row.received, row.loaded, row.deduped, row.rejected) == (3, 1, 2, 0)


def test_malformed_file_reaches_the_quarantine(spark, tmpdir_path):
    land(f"{tmpdir_path}/l", '{"data": [{"segment_id": 1, "curr', {"data": [reading(2, 5.0)]})
    res = ingest.process_traffic(read_feed(spark, f"{tmpdir_path}/l", "traffic"), 0, tmpdir_path)
    assert res == {"loaded": 1, "rejected": 1}
    bad = spark.read.parquet(f"{tmpdir_path}/quarantine/traffic").first()
    assert bad.reason.startswith("malformed_record") and bad.source_file == "f0.json" and "curr" in bad.corrupt_record


def test_default_arguments_compose(spark, tmpdir_path):
    land(f"{tmpdir_path}/l", {"data": [reading(1, 5.0)]})
    valid, rejected = validate.validate_traffic(read_feed(spark, f"{tmpdir_path}/l", "traffic"))
    assert valid.count() == 1 and rejected.count() == 0


def test_constraints_at_load(spark, tmpdir_path):
    known = spark.createDataFrame([(1,)], "segment_id long")
    land(f"{tmpdir_path}/t", {"data": [reading(1, 5.0), reading(2, 5.0), reading("x", 5.0)]})
    batch = read_feed(spark, f"{tmpdir_path}/t", "traffic")
    assert ingest.process_traffic(batch, 0, tmpdir_path, segments=known) == {"loaded": 1, "rejected": 2}
    reasons = {r.reason for r in spark.read.parquet(f"{tmpdir_path}/quarantine/traffic").collect()}
    assert reasons == {"segment_id_unknown", "segment_id_invalid"}
    with pytest.raises(tables.BatchRejected):
        ingest.process_traffic(batch, 0, f"{tmpdir_path}/x", strict=True, segments=known)
    zone = {"geometry_type": "LineString", "coordinates": [[0, 0], [1, 1]], "start_date": "2024-03-01"}
    land(f"{tmpdir_path}/c", {"plans": [zone, {**zone, "status": "paused"}, {**zone, "status": None}, {**zone, "status": "active"}]})
    assert ingest.process_construction(read_feed(spark, f"{tmpdir_path}/c", "construction"), 0, tmpdir_path) == {
        "loaded": 2, "rejected": 2}
    reasons = {r.reason for r in spark.read.parquet(f"{tmpdir_path}/quarantine/construction").collect()}
    assert reasons == {"status_domain", "status_invalid"}


def test_coercion_is_exact(spark):
    rows = [reading(9007199254740993, 1), reading("9007199254740993", "1_000"), reading(1, "45d"), reading(1, "1__0"),
            reading(1, " 1e2 "), reading(1, 5, timestamp="12:30"), reading(1, 6, timestamp=1704096000),
            reading(1, 7, timestamp=1704096000000), reading(1, 8, timestamp="2024-01-01T08:00:00Z")]
    valid, rejected = validate.validate_traffic(_json_rows(spark, rows))
    got = {r.ordinal: r for r in valid.collect()}
    assert [r.segment_id for r in (got[k] for k in sorted(got)[:2])] == [9007199254740993] * 2
    assert sorted(r.current_speed for r in got.values()) == [1.0, 6.0, 7.0, 8.0, 100.0, 1000.0]
    assert len({r.timestamp for r in got.values() if r.current_speed in (6.0, 7.0, 8.0)}) == 1
    assert sorted(r.reason for r in rejected.collect()) == ["current_speed_invalid", "current_speed_invalid", "timestamp_invalid"]


def test_strict_batch_is_parked_and_the_feed_goes_on(spark, tmpdir_path):
    land(f"{tmpdir_path}/l", {"data": [reading(1, 5.0), reading(1, "bad")]})
    q = ingest.start_feed(spark, "traffic", f"{tmpdir_path}/l", f"{tmpdir_path}/o", f"{tmpdir_path}/ck", available_now=True,
                          strict=True)
    q.awaitTermination(120)
    assert q.exception() is None and spark.read.parquet(f"{tmpdir_path}/o/parked/traffic").count() == 2
    row = spark.read.parquet(f"{tmpdir_path}/o/ingest_log").first()
    assert (row.received, row.loaded, row.parked) == (2, 0, 2)


def test_failed_feed_is_restarted_and_others_go_on(spark, tmpdir_path, monkeypatch):
    land(f"{tmpdir_path}/l/traffic", {"data": [reading(1, 5.0)]})
    land(f"{tmpdir_path}/l/weather", {"snapshots": [{"latitude": 1.0, "longitude": 2.0}]})
    calls = []
    real = ingest.process_traffic

    def flaky(*a, **kw):
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("first try fails")
        return real(*a, **kw)
    monkeypatch.setitem(ingest.PROCESSORS, "traffic", flaky)

    def start(name):
        return ingest.start_feed(spark, name, f"{tmpdir_path}/l/{name}", f"{tmpdir_path}/o", f"{tmpdir_path}/ck/{name}",
                                 available_now=True)
    assert ingest.supervise(start, ("traffic", "weather"), pause=0.1) == {"traffic": None, "weather": None}
    assert len(calls) == 2 and spark.read.parquet(f"{tmpdir_path}/o/traffic_readings").count() == 1
    assert spark.read.parquet(f"{tmpdir_path}/o/weather_snapshots").count() == 1

    def broken(name):
        raise OSError("no such feed")
    assert ingest.supervise(broken, ("traffic",), max_restarts=1, pause=0.0) == {"traffic": "no such feed"}


def test_ingested_tables_feed_the_queries(spark, tmpdir_path):
    t = "2024-01-01T08:00:00Z"
    land(f"{tmpdir_path}/t", {"data": [reading(1, 30.0, timestamp=t, congestion_score=0.4), reading(2, 60.0, timestamp=t)]})
    land(f"{tmpdir_path}/w", {"snapshots": [{"latitude": 0.5, "longitude": 0.5, "temperature": 10.0, "rain_intensity": 2.0,
                                             "timestamp": t},
                                            {"latitude": 9.0, "longitude": 9.0, "temperature": 30.0, "timestamp": t}]})
    land(f"{tmpdir_path}/i", {"incidents": [{"incident_type": "debris", "latitude": 0.2, "longitude": 0.2, "timestamp": t}]})
    land(f"{tmpdir_path}/c", {"plans": [{"geometry_type": "LineString", "coordinates": [[0, 0], [1, 1]], "start_date": "2024-03-01"}]})
    for feed, short in (("traffic", "t"), ("weather", "w"), ("incidents", "i"), ("construction", "c")):
        res = ingest.PROCESSORS[feed](read_feed(spark, f"{tmpdir_path}/{short}", feed), 0, tmpdir_path)
        assert res["rejected"] == 0
    stored = {n: spark.read.parquet(f"{tmpdir_path}/{n}") for n in (
        "traffic_readings", "weather_snapshots", "incidents", "construction_zones")}
    assert stored["weather_snapshots"].select("snapshot_id").distinct().count() == 2
    assert {"incident_id"} <= set(stored["incidents"].columns) and {"zone_id"} <= set(stored["construction_zones"].columns)
    roads = spark.sql("""SELECT * FROM VALUES (1L, 10L, 'a', 50, 1000D, 0D, 0D, 1D, 1D), (2L, 20L, 'b', 30, 500D, 5D, 5D, 6D, 6D)
                         AS t(segment_id, osm_id, name, speed_limit, length, x0, y0, x1, y1)""")
    pts = F.array(*[F.struct(F.col(f"x{i}").alias("x"), F.col(f"y{i}").alias("y")) for i in (0, 1)])
    roads = roads.withColumn("pts", pts)
    readings, weather = stored["traffic_readings"], stored["weather_snapshots"]
    assert trends.traffic_trends(readings, ts="timestamp").count() == 1
    assert latest.segments_with_latest(roads, readings).where("current_speed IS NOT NULL").count() == 2
    assert spatial.segments_in_viewport(roads, (0.0, 0.0, 2.0, 2.0)).count() == 1
    feats = {r.segment_id: r for r in segments.segment_features(roads, readings, weather).collect()}
    assert feats[1].temperature == 10.0 and feats[1].rain_intensity == 2.0 and float(feats[1].congestion_score) == 0.4
    one = segments.predict_segment(roads, readings, weather, 1).collect()
    assert len(one) == 1 and one[0].predicted_time_seconds > one[0].free_flow_time_seconds
    with pytest.raises(LookupError):
        segments.predict_segment(roads, readings, weather, 99)
    assert segments.prediction_log(segments.score_segments(segments.segment_features(roads, readings, weather)), "r").count() == 2
    assert spatial.nearest_one(weather, 0.4, 0.4, tiebreak="snapshot_id").temperature == 10.0
    with pytest.raises(ValueError):
        spatial.nearest_one(weather, 0.0, 91.0, tiebreak="snapshot_id")
    with pytest.raises(LookupError):
        spatial.nearest_one(weather.limit(0), 0.0, 1.0, tiebreak="snapshot_id")


def test_average_of_real_speeds(spark):
    rows = [(1, v, "2024-01-01 08:10:00") for v in (10.003, 10.004, 10.009)] + [(1, 1e17, "2024-01-01 09:00:00"),
                                                                               (1, 1e25, "2024-01-01 10:00:00")]
    df = spark.createDataFrame(rows, "segment_id long, current_speed double, t string").withColumn(
        "reading_ts", F.col("t").cast("timestamp")).withColumn("congestion_score", F.lit(None).cast("double"))
    got = {r.hour_of_day: r.avg_speed for r in trends.traffic_trends(df).collect()}
    assert got[8] == 10.01 and got[9] == 1e17 and got[10] == 1e25


def test_upsert_keeps_the_last_of_repeated_keys(spark):
    base = spark.sql("SELECT 1L AS id, 'a' AS status, TIMESTAMP '2024-01-01' AS created_at, TIMESTAMP '2024-01-01' AS updated_at")
    inc = spark.sql("""SELECT * FROM VALUES (1L, 'x', TIMESTAMP '2024-02-01', TIMESTAMP '2024-02-01', 1),
                       (1L, 'y', TIMESTAMP '2024-02-01', TIMESTAMP '2024-02-01', 2) AS t(id, status, created_at, updated_at, ordinal)""")
    out = tables.upsert_touch(base, inc, "id").collect()
    assert len(out) == 1 and out[0].status == "y"


def test_knn_with_one_dense_cluster(spark):
    """A dense cluster among sparse stations: the join stays exact, by broadcast and by leaves."""
    import random
    rng = random.Random(6)
    stations = [(i, rng.uniform(-60, 60), rng.uniform(-120, 120)) for i in range(800)]
    stations += [(1000 + i, 10 + rng.random() * 2e-4, 20 + rng.random() * 2e-4) for i in range(200)]
    points = [(i, rng.uniform(-60, 60), rng.uniform(-120, 120)) for i in range(300)] + [(900, 10.0001, 20.0001)]
    st = spark.createDataFrame(stations, "id string, latitude double, longitude double").withColumn(
        "timestamp", F.lit("2024-01-01").cast("timestamp"))
    pt = spark.createDataFrame(points, "pid long, py double, px double")
    want = {p: str(min(stations, key=lambda s: ((s[1] - y) ** 2 + (s[2] - x) ** 2, str(s[0])))[0]) for p, y, x in points}
    for options in ({}, {"broadcast_rows": 0, "leaf_rows": 50}):
        assert {r.pid: r.id for r in spatial.nearest_join(pt, st, "pid", "px", "py", **options).collect()} == want
