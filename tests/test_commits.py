"""Commits by stream and batch, compaction, and the summaries the stream keeps."""

import json
import os
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from corridor.operators import model
from corridor.operators.latest import latest_per_segment
from corridor.operators.trends import traffic_trends
from corridor.sinks import tables
from corridor.sinks.commits import AlreadyPacked, CommitTable, ConcurrentChange
from corridor.streaming import ingest, kept

SCHEMA = "reading_id long, segment_id long, current_speed double, congestion_score double, timestamp timestamp"
START = datetime(2024, 1, 1)


def readings(spark, rng, n, days=3, first=0):
    rows = [(first + i, rng.randrange(5), rng.uniform(0, 90), rng.choice([None, 0.1, 0.5, 0.77]),
             START + timedelta(hours=rng.randrange(24 * days), minutes=rng.randrange(3))) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df):
    return sorted((tuple(str(v) for v in r) for r in df.collect()))


def land(folder, name, records):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        json.dump({"data": records}, f)


def reading(segment, day):
    return {"segment_id": segment, "current_speed": 10.0 + segment, "timestamp": f"2024-01-0{day}T08:00:00Z"}


def ingest_all(spark, base, landing, checkpoint, **options):
    q = ingest.start_feed(spark, "traffic", f"{base}/{landing}", f"{base}/out", f"{base}/{checkpoint}", available_now=True,
                          max_files_per_trigger=1, **options)
    q.awaitTermination(300)
    assert q.exception() is None


def test_two_checkpoints_into_one_table_keep_both(spark, tmpdir_path):
    land(f"{tmpdir_path}/a", "1.json", [reading(1, 1), reading(2, 1), reading(3, 1), {"segment_id": "x"}])
    land(f"{tmpdir_path}/b", "1.json", [reading(4, 1), reading(5, 1), reading(6, 2), {"segment_id": "y"}])
    ingest_all(spark, tmpdir_path, "a", "ck-a")
    ingest_all(spark, tmpdir_path, "b", "ck-b")
    table = tables.committed(spark, f"{tmpdir_path}/out/traffic_readings", "traffic_readings")
    assert sorted(r.segment_id for r in table.read().collect()) == [1, 2, 3, 4, 5, 6]
    assert spark.read.parquet(f"{tmpdir_path}/out/traffic_readings").count() == 6
    assert spark.read.parquet(f"{tmpdir_path}/out/quarantine/traffic").count() == 2
    log = spark.read.parquet(f"{tmpdir_path}/out/ingest_log").collect()
    assert len(log) == 2 and sum(r.received for r in log) == 8 and len({r.stream for r in log}) == 2
    latest = kept.ReadingSummaries(spark, f"{tmpdir_path}/out").latest.read()
    assert rows_of(latest) == rows_of(latest_per_segment(table.read()))
    # The same checkpoint goes on under its own name.
    land(f"{tmpdir_path}/a", "2.json", [reading(7, 2)])
    ingest_all(spark, tmpdir_path, "a", "ck-a")
    assert table.read().count() == 7 and len({m["stream"] for m in table.manifests()}) == 2


def test_changed_replay_leaves_nothing_of_the_first_attempt(spark, tmpdir_path):
    from corridor.sources.feeds import read_feed
    land(f"{tmpdir_path}/l", "1.json", [reading(1, 1), reading(2, 2), reading(3, 3), {"segment_id": "x"}])
    batch = read_feed(spark, f"{tmpdir_path}/l", "traffic")
    known = spark.createDataFrame([(1,), (2,), (3,)], "segment_id long")
    assert ingest.process_traffic(batch, 0, tmpdir_path, segments=known) == {"loaded": 3, "rejected": 1}
    assert ingest.process_traffic(batch, 1, tmpdir_path, segments=known)["loaded"] == 3
    fewer = spark.createDataFrame([(2,)], "segment_id long")
    assert ingest.process_traffic(batch, 0, tmpdir_path, segments=fewer) == {"loaded": 1, "rejected": 3}
    path = f"{tmpdir_path}/traffic_readings"
    stored = tables.committed(spark, path, "traffic_readings").read()
    assert sorted((r.segment_id, str(r.dt)) for r in stored.collect()) == [
        (1, "2024-01-01"), (2, "2024-01-02"), (2, "2024-01-02"), (3, "2024-01-03")]
    assert spark.read.parquet(path).count() == 4
    clean = batch.where("pos < 3")
    assert ingest.process_traffic(clean, 0, tmpdir_path, segments=known) == {"loaded": 3, "rejected": 0}
    assert spark.read.parquet(f"{tmpdir_path}/quarantine/traffic").where("batch_id = 0").count() == 0


def test_strict_replay_takes_back_the_other_outcome(spark, tmpdir_path):
    land(f"{tmpdir_path}/l", "1.json", [reading(1, 1), {"segment_id": "x"}])
    batch = spark.read.schema("data array<variant>, corrupt_record string").option("multiLine", True).json(f"{tmpdir_path}/l")
    batch = batch.select(F.col("data").alias("_records"), "corrupt_record", F.current_timestamp().alias("file_time"),
                         F.lit("1.json").alias("source_file"), F.lit(0).cast("long").alias("_block"))
    out = f"{tmpdir_path}/out"
    for strict in (False, True, False):
        ingest.batch_function("traffic", out, strict=strict)(batch, 0)
        n = [CommitTable(spark, f"{out}/{t}") for t in ("traffic_readings", "quarantine/traffic", "parked/traffic", "hourly_cells")]
        assert [sum(m["rows"] for m in t.manifests()) for t in n] == ([0, 0, 2, 0] if strict else [1, 1, 0, 1])
        assert sum(m["rows"] for m in CommitTable(spark, f"{out}/ingest_log/feed=traffic").manifests()) == 1


def test_failed_attempt_is_invisible(spark, tmpdir_path):
    table = CommitTable(spark, f"{tmpdir_path}/t", days=True)
    frame = spark.sql("SELECT id, DATE '2024-01-01' AS dt FROM range(3)")
    table.write(frame, 0, "s")

    def boom(*_, **__):
        raise OSError("store gone")
    put, table.files.put = table.files.put, boom
    with pytest.raises(OSError):
        table.write(frame.limit(2), 0, "s")
    with pytest.raises(OSError):
        table.write(frame, 1, "s")
    table.files.put = put
    assert table.read().count() == 3 and len(table.manifests()) == 1
    assert table.write(frame.limit(1), 1, "s") == 1 and table.read().count() == 4
    assert len(table.files.names("commit=s~1~*")) == 1      # the failed attempt's folder is gone
    assert table.vacuum(0.0) == 1 and table.read().count() == 4


def test_days_open_only_their_folders(spark, tmpdir_path):
    table = CommitTable(spark, f"{tmpdir_path}/t", days=True)
    for k in range(4):
        table.write(spark.sql(f"SELECT id, DATE '2024-01-0{k + 1}' AS dt FROM range(5)"), k, "s")
    some = table.read(date(2024, 1, 2), date(2024, 1, 3))
    assert some.count() == 10 and len(some.inputFiles()) == 2
    assert table.read(date(2025, 1, 1)).count() == 0 and table.read().columns == ["id", "dt"]
    with pytest.raises(LookupError):
        CommitTable(spark, f"{tmpdir_path}/none").read()


def test_compaction_keeps_rows_and_bounds_files(spark, tmpdir_path):
    rng = random.Random(3)
    table = tables.committed(spark, f"{tmpdir_path}/t", "traffic_readings")
    want = []
    for k in range(10):
        df = readings(spark, rng, 20, first=100 * k).withColumn("dt", F.to_date("timestamp"))
        table.write(df, k, "s")
        want += rows_of(df)
        if k % 4 == 3:
            table.compact(fan=3)
            # The newest batch may still be replayed, with other rows; older ones cannot be any more.
            again = readings(spark, rng, 7, first=100 * k + 50).withColumn("dt", F.to_date("timestamp"))
            want = [r for r in want if int(r[0]) // 100 != k] + rows_of(again)
            table.write(again, k, "s")
            with pytest.raises(AlreadyPacked):
                table.write(df, k - 2, "s")
    table.write(df.limit(3))
    want += rows_of(df.limit(3))
    reader = table.read()                      # planned before the next compaction
    table.compact(fan=2)
    assert rows_of(table.read()) == sorted(want) == rows_of(reader)
    packs = [m for m in table.manifests() if m["kind"] == "pack"]
    assert len(table.manifests()) <= 4 and max(m["tier"] for m in packs) >= 1
    assert len(table.read().inputFiles()) <= 4 * 3
    assert table.vacuum(0.0) > 0 and rows_of(table.read()) == sorted(want)
    assert spark.read.parquet(f"{tmpdir_path}/t").count() == len(want)


def test_two_compactions_at_once(spark, tmpdir_path):
    one, other = (CommitTable(spark, f"{tmpdir_path}/t") for _ in range(2))
    for k in range(4):
        one.write(spark.range(5), k, "s")
    live = other.manifests()
    real, other.files.names = other.files.names, lambda p: [] if "pack~" in p else real(p)   # sees the log as it was
    one.compact(fan=2)
    with pytest.raises(ConcurrentChange):
        other._pack(live[:3], 0, None)
    assert one.read().count() == 20


def test_kept_summaries_equal_the_full_history(spark, tmpdir_path):
    rng = random.Random(11)
    out = f"{tmpdir_path}/o"
    summaries = kept.ReadingSummaries(spark, out)
    batches = {(s, k): readings(spark, rng, 30, first=1000 * k + 100 * (s == "b")) for s in "ab" for k in range(3)}
    order = [(s, k) for s in "ab" for k in range(3)]
    for s, k in order[::-1]:                               # newest first: all later ones are late
        summaries.add(batches[s, k], k, s)
        if (s, k) in (("b", 1), ("a", 2)):
            batches[s, k] = readings(spark, rng, 10, first=7000 + k)
            summaries.add(batches[s, k], k, s)             # a replay with other rows
    every = batches["a", 0]
    for key in order[1:]:
        every = every.unionByName(batches[key])

    def same():
        assert rows_of(summaries.latest.read()) == rows_of(latest_per_segment(every))
        assert rows_of(summaries.cells.report()) == rows_of(traffic_trends(every, ts="timestamp"))
        assert rows_of(summaries.cells.report(by=["segment_id"])) == rows_of(traffic_trends(every, by=["segment_id"], ts="timestamp"))
        assert rows_of(summaries.cells.report(segment_id=3)) == rows_of(traffic_trends(every, segment_id=3, ts="timestamp"))
        day = date(2024, 1, 2)
        assert rows_of(summaries.cells.report(first_day=day, last_day=day)) == rows_of(
            traffic_trends(every.where(F.to_date("timestamp") == F.lit(day)), ts="timestamp"))
    same()
    summaries.compact(fan=2)
    same()
    batches["a", 2] = readings(spark, rng, 12, first=9000)
    summaries.add(batches["a", 2], 2, "a")                 # the stream's last batch, after compaction
    every = batches["a", 0]
    for key in order[1:]:
        every = every.unionByName(batches[key])
    same()
    assert len(summaries.latest.table.manifests()) <= 3


def test_kept_training_sums(spark, tmpdir_path):
    rng = random.Random(2)
    rows = [(rng.uniform(100, 900), 50.0, rng.random(), rng.uniform(0, 5), rng.uniform(-5, 35), rng.uniform(10, 200)) for _ in range(90)]
    schema = "length double, speed_limit double, congestion_score double, rain_intensity double, temperature double, actual_time double"
    sums = kept.training_sums(spark, f"{tmpdir_path}/t")
    for k in (2, 0, 1):
        sums.add(spark.createDataFrame(rows[30 * k:30 * k + 30], schema), k)
    sums.add(spark.createDataFrame(rows[:30], schema), 0)
    want = model.fit(spark.createDataFrame(rows, schema))
    for _ in range(2):
        got = kept.fit_kept(sums)
        assert got["samples"] == want["samples"] == 90
        assert all(abs(got["weights"][k] - want["weights"][k]) < 1e-9 for k in want["weights"])
        sums.compact(fan=2)


def test_equal_json_lines_have_ids_of_their_own(spark, tmpdir_path):
    from corridor.sources.feeds import read_feed
    os.makedirs(f"{tmpdir_path}/l")
    line = json.dumps({"incidents": [{"incident_type": "debris", "latitude": 1.0, "longitude": 2.0}]})
    with open(f"{tmpdir_path}/l/f.json", "w") as f:
        f.write("\n".join([line] * 5))
    ids = [[r.record_id for r in read_feed(spark, f"{tmpdir_path}/l", "incidents", multi_line=False).collect()] for _ in range(2)]
    assert len(set(ids[0])) == 5 and sorted(ids[0]) == sorted(ids[1])


def test_unreachable_weights_are_an_error(spark, tmpdir_path):
    assert model.load_weights(spark, f"{tmpdir_path}/none") == model.DEFAULT_WEIGHTS
    os.makedirs(f"{tmpdir_path}/bad")
    with open(f"{tmpdir_path}/bad/w.json", "w") as f:
        f.write("{broken")
    assert model.load_weights(spark, f"{tmpdir_path}/bad") == model.DEFAULT_WEIGHTS
    with pytest.raises(Exception, match="(?i)nosuchfs|scheme"):
        model.load_weights(spark, "nosuchfs://host/weights")
