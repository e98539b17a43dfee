"""Streaming ingest = batch ingest on the same files; replays are idempotent; sinks."""

import json
import os

import pytest
from pyspark.sql import functions as F

from corridor.operators import model
from corridor.sinks import tables
from corridor.sources.feeds import read_feed
from corridor.streaming import ingest

TRAFFIC_FILES = [
    {"data": [{"segment_id": "1", "current_speed": 30.0, "timestamp": "2024-01-01T08:00:00Z"},
              {"segment_id": 1, "current_speed": 25.0, "congestion_score": 0.5, "timestamp": "2024-01-01T08:00:00Z"},
              {"segment_id": 2, "current_speed": "bad"},
              {"segment_id": 3, "current_speed": 12.0, "timestamp": "2024-01-02T09:30:00+00:00"}]},
    {"data": [{"segment_id": 4, "current_speed": 55.0, "timestamp": "2023-06-01T00:00:00Z"}]},
    {"other": []},
]


def _land(d, files):
    os.makedirs(d, exist_ok=True)
    for i, f in enumerate(files):
        with open(os.path.join(d, f"feed-{i}.json"), "w") as fh:
            json.dump(f, fh)


def test_stream_equals_batch_and_replay(spark, tmpdir_path):
    landing, out, ck = (os.path.join(tmpdir_path, p) for p in ("landing", "out", "ck"))
    _land(landing, TRAFFIC_FILES)
    q = ingest.start_feed(spark, "traffic", landing, out, ck, available_now=True, max_files_per_trigger=1)
    q.awaitTermination(120)
    assert q.exception() is None
    streamed = spark.read.parquet(f"{out}/traffic_readings")
    got = sorted((r.segment_id, r.current_speed) for r in streamed.collect())
    assert got == [(1, 25.0), (3, 12.0), (4, 55.0)]   # keep-last, reject 'bad', late row kept
    assert spark.read.parquet(f"{out}/quarantine/traffic").count() == 1
    from corridor.operators.latest import latest_per_segment
    from corridor.operators.trends import traffic_trends
    lat = latest_per_segment(streamed, ts="timestamp", cols=("current_speed", "timestamp", "reading_id"))
    assert sorted(r.segment_id for r in lat.collect()) == [1, 3, 4]
    assert traffic_trends(streamed, ts="timestamp").count() == 3
    acc = spark.read.parquet(f"{out}/ingest_log").collect()
    # One file per micro-batch: three batches, totals as for the whole set.
    assert len(acc) == 3 and {r.feed for r in acc} == {"traffic"}
    assert (sum(r.loaded for r in acc), sum(r.rejected for r in acc)) == (3, 1)

    # Batch path over the same files gives the same rows.
    out2 = os.path.join(tmpdir_path, "out2")
    res = ingest.process_traffic(read_feed(spark, landing, "traffic"), 0, out2)
    assert res == {"loaded": 3, "rejected": 1}
    # Replaying the same batch id replaces its own output.
    res = ingest.process_traffic(read_feed(spark, landing, "traffic"), 0, out2)
    assert spark.read.parquet(f"{out2}/traffic_readings").count() == 3


def test_strict_mode_rejects_batch(spark, tmpdir_path):
    landing = os.path.join(tmpdir_path, "landing")
    _land(landing, TRAFFIC_FILES)
    with pytest.raises(tables.BatchRejected):
        ingest.process_traffic(read_feed(spark, landing, "traffic"), 0, os.path.join(tmpdir_path, "o"), strict=True)


def test_other_feeds_batch(spark, tmpdir_path):
    land = os.path.join(tmpdir_path, "w")
    _land(land, [{"snapshots": [{"latitude": 37.7, "longitude": -122.4, "precipitation": 1.5,
                                 "timestamp": "2024-01-01T00:00:00Z"},
                                {"latitude": 137.7, "longitude": -122.4}]}])
    assert ingest.process_weather(read_feed(spark, land, "weather"), 0, tmpdir_path) == {"loaded": 1, "rejected": 1}
    land = os.path.join(tmpdir_path, "i")
    _land(land, [{"incidents": [{"incident_type": "accident", "latitude": 37.7, "longitude": -122.4,
                                 "severity": 4, "status": "OPEN", "timestamp": "2024-01-01T00:00:00Z"}]}])
    assert ingest.process_incidents(read_feed(spark, land, "incidents"), 0, tmpdir_path)["loaded"] == 1
    inc = spark.read.parquet(f"{tmpdir_path}/incidents").first()
    assert (inc.severity, inc.status, inc.description) == ("critical", "active", "Traffic incident of type: accident")
    land = os.path.join(tmpdir_path, "c")
    _land(land, [{"plans": [{"geometry_type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 1]]],
                             "start_date": "2024-03-01T00:00:00Z", "status": "active"},
                            {"geometry_type": "circle", "coordinates": [[0, 0], [1, 1]],
                             "start_date": "2024-03-01T00:00:00Z"}]}])
    assert ingest.process_construction(read_feed(spark, land, "construction"), 0, tmpdir_path) == \
        {"loaded": 1, "rejected": 1}
    zone = spark.read.parquet(f"{tmpdir_path}/construction_zones").first()
    assert len(zone.rings[0]) == 5 and zone.geometry.startswith("SRID=4326;POLYGON((0.0 0.0, 1.0 0.0")


def test_empty_batch_writes_nothing(spark, tmpdir_path):
    land = os.path.join(tmpdir_path, "e")
    _land(land, [{"data": []}])
    assert ingest.process_traffic(read_feed(spark, land, "traffic"), 0, tmpdir_path) == {"loaded": 0, "rejected": 0}


def test_weights_roundtrip(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "weights")
    assert model.load_weights(spark, p) == model.DEFAULT_WEIGHTS
    model.save_weights(spark, {"w0": 1.5, "w1": 2.0, "w2": 0.1, "w3": 0.0}, p)
    assert model.load_weights(spark, p) == {"w0": 1.5, "w1": 2.0, "w2": 0.1, "w3": 0.0}
    partial = os.path.join(tmpdir_path, "partial")
    os.makedirs(partial)
    with open(os.path.join(partial, "w.json"), "w") as fh:
        fh.write('{"w1": 9.0}')
    assert model.load_weights(spark, partial) == {**model.DEFAULT_WEIGHTS, "w1": 9.0}


def test_upsert_touch(spark):
    import datetime as dt
    t0, now = dt.datetime(2024, 1, 1), dt.datetime(2024, 6, 1)
    base = spark.createDataFrame([(1, "active", t0, t0), (2, "active", t0, t0)],
                                 "id long, status string, created_at timestamp, updated_at timestamp")
    inc = spark.createDataFrame([(2, "cleared", now, now), (3, "active", now, now)],
                                "id long, status string, created_at timestamp, updated_at timestamp")
    out = {r.id: r for r in tables.upsert_touch(base, inc, "id", now=F.lit(now)).collect()}
    assert out[1].status == "active" and out[1].updated_at == t0
    assert out[2].status == "cleared" and out[2].created_at == t0 and out[2].updated_at == now
    assert out[3].created_at == now


def test_segments_table_and_lookup(spark, tmpdir_path):
    from corridor.functions import geometry as geo
    from corridor.operators import spatial
    from corridor.sources.feeds import lookup_one, read_table
    df = spark.createDataFrame([(1, 0.0, 0.0, 1.0, 1.0), (2, 5.0, 5.0, 6.0, 6.0)],
                               "segment_id long, x0 double, y0 double, x1 double, y1 double")
    seg = df.select("segment_id", geo.line_from_columns("x0", "y0", "x1", "y1").alias("pts"))
    p = os.path.join(tmpdir_path, "road_segments")
    tables.write_segments(seg, p)
    stored = read_table(spark, p)
    assert {"min_x", "max_y"} <= set(stored.columns)
    hits = spatial.segments_in_viewport(stored, (0.5, 0.5, 2.0, 2.0))
    assert [r.segment_id for r in hits.collect()] == [1]
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = spark.read.parquet(p).transform(lambda d: spatial.segments_in_viewport(d, (0.5, 0.5, 2.0, 2.0))) \
        ._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(max_x,0.5)" in plan and "LessThanOrEqual(min_x,2.0)" in plan, plan
    assert lookup_one(stored, "segment_id", 2).segment_id == 2
    with pytest.raises(LookupError):
        lookup_one(stored, "segment_id", 99)


def test_start_all_isolates_feeds(spark, tmpdir_path):
    """Four independent queries; a feed whose landing folder is missing fails
    alone and the other feeds still load."""
    root, out, ck = (os.path.join(tmpdir_path, p) for p in ("landing", "out", "ck"))
    _land(os.path.join(root, "traffic"), TRAFFIC_FILES[:1])
    _land(os.path.join(root, "weather"), [{"snapshots": [{"latitude": 37.7, "longitude": -122.4}]}])
    _land(os.path.join(root, "incidents"), [{"incidents": [{"incident_type": "debris", "latitude": 37.7,
                                                             "longitude": -122.4}]}])
    # no construction folder at all
    queries = ingest.start_all(spark, root, out, ck, available_now=True)
    for q in queries.values():
        q.awaitTermination(120)
    assert {"traffic", "weather", "incidents"} <= set(queries)
    assert spark.read.parquet(f"{out}/traffic_readings").count() == 2
    assert spark.read.parquet(f"{out}/weather_snapshots").count() == 1
    assert spark.read.parquet(f"{out}/incidents").count() == 1
    assert not os.path.exists(f"{out}/construction_zones")


def test_reload_prediction_log_and_score_storage(spark, tmpdir_path):
    import datetime as dt
    from corridor.operators import segments as sg
    # K8: full reload replaces the table.
    p = os.path.join(tmpdir_path, "t")
    tables.full_reload(spark.createDataFrame([(1,), (2,)], "a long"), p)
    tables.full_reload(spark.createDataFrame([(3,)], "a long"), p)
    assert [r.a for r in spark.read.parquet(p).collect()] == [3]
    # K9: the audit log keeps start/end points, a NULL actual time and stable ids.
    scored = spark.createDataFrame([(7, 37.7, -122.4, 37.8, -122.5, 438.75)],
                                   "segment_id long, start_lat double, start_lon double, end_lat double, "
                                   "end_lon double, predicted_time_seconds double")
    log = sg.prediction_log(scored, "run-1")
    assert log.first().prediction_id != sg.prediction_log(scored, "run-2").first().prediction_id
    lp = os.path.join(tmpdir_path, "predictions")
    at = F.lit(dt.datetime(2024, 1, 1, 12)).cast("timestamp")
    assert tables.append_predictions(log, lp, batch_id=0, at=at) == 1
    assert tables.append_predictions(log, lp, batch_id=0, at=at) == 1      # replay: replaced
    r = spark.read.parquet(lp).collect()
    assert len(r) == 1 and r[0].actual_time is None and r[0].origin_lng == -122.4
    assert r[0].prediction_id == log.first().prediction_id
    # C5: scores are stored as NUMERIC(3,2), rounded half up.
    t = dt.datetime(2024, 1, 1, 8)
    rd = spark.createDataFrame([(1, 30.0, 0.125, t), (2, 30.0, 0.994, t)],
                               "segment_id long, current_speed double, congestion_score double, timestamp timestamp")
    rp = os.path.join(tmpdir_path, "readings")
    tables.load_traffic_readings(rd, rp, batch_id=0)
    got = sorted((r.segment_id, float(r.congestion_score)) for r in spark.read.parquet(rp).collect())
    assert got == [(1, 0.13), (2, 0.99)]


def test_ingest_command_line(spark, tmpdir_path):
    root, out, ck = (os.path.join(tmpdir_path, p) for p in ("landing", "out", "ck"))
    _land(os.path.join(root, "traffic"), TRAFFIC_FILES)
    for feed in ("weather", "incidents", "construction"):
        _land(os.path.join(root, feed), [{}])
    assert ingest.main([root, out, ck, "--available-now"]) == 0
    assert spark.read.parquet(f"{out}/traffic_readings").count() == 3


def test_missing_keys(spark):
    from corridor.sources.feeds import missing_keys
    table = spark.createDataFrame([(1,), (2,)], "segment_id long")
    req = spark.createDataFrame([(2,), (3,), (3,), (9,)], "segment_id long")
    assert sorted(r.segment_id for r in missing_keys(req, table, "segment_id").collect()) == [3, 9]
