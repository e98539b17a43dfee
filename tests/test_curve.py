"""Curve layout: same rows as the plain tests, few row groups for a small box."""

import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from corridor.functions import curve
from corridor.functions import geometry as geo
from corridor.operators import spatial
from corridor.sinks import tables


def lines(rng, n):
    out = []
    for i in range(n):
        x, y = rng.uniform(-180, 180), rng.uniform(-90, 90)
        w = rng.choice([0.0, 1e-5, 0.01, 0.5, 10.0, 200.0])
        out.append((i, x, y, max(-180.0, min(180.0, x + rng.uniform(-w, w))), max(-90.0, min(90.0, y + rng.uniform(-w, w)))))
    out += [(n, -180.0, -90.0, 180.0, 90.0), (n + 1, 180.0, 90.0, 180.0, 90.0), (n + 2, 0.0, 0.0, 0.0, 0.0)]
    return out


def boxes(rng, n):
    for _ in range(n):
        w = rng.choice([1e-4, 0.01, 1.0, 30.0, 170.0])
        x, y = rng.uniform(-180, 179), rng.uniform(-90, 89)
        yield x, y, min(180.0, x + w), min(90.0, y + w)
    yield -180.0, -90.0, 180.0, 90.0
    yield -0.5, -0.5, 0.0, 0.0


@pytest.fixture(scope="module")
def keyed(spark):
    rows = lines(random.Random(4), 4000)
    df = spark.createDataFrame(rows, "id long, x0 double, y0 double, x1 double, y1 double")
    b = [F.least("x0", "x1"), F.least("y0", "y1"), F.greatest("x0", "x1"), F.greatest("y0", "y1")]
    return [(*r[1:5], r.k) for r in df.select("*", curve.curve_key(*b).alias("k")).collect()]


def test_ranges_hold_every_box_that_overlaps(keyed):
    some = 0
    for x1, y1, x2, y2 in boxes(random.Random(5), 60):
        ranges = curve.key_ranges((x1, y1, x2, y2))
        assert ranges == sorted(ranges) and all(a <= b < c for (a, b), (c, _) in zip(ranges, ranges[1:]))
        for ax, ay, bx, by, k in keyed:
            if max(ax, bx) >= x1 and min(ax, bx) <= x2 and max(ay, by) >= y1 and min(ay, by) <= y2:
                assert any(a <= k <= b for a, b in ranges)
                some += 1
    assert some > 1000


def test_key_by_hand(keyed):
    for ax, ay, bx, by, k in keyed[:500]:
        extent = max(abs(ax - bx), abs(ay - by))
        level = max(l for l in range(curve.FINEST + 1) if l == 0 or extent <= 360 / 2 ** l)
        x, y = curve._cell_of(min(ax, bx), level), curve._cell_of(min(ay, by), level)
        bits = "".join(f"{y >> i & 1}{x >> i & 1}" for i in range(20, -1, -1))
        assert k == (level << 42) + int(bits, 2)


def test_viewport_over_the_layout(spark, tmpdir_path):
    rng = random.Random(7)
    rows = [(i, rng.uniform(-123, -121), rng.uniform(37, 39)) for i in range(30_000)]
    rows = [(i, x, y, x + rng.uniform(-1e-3, 1e-3), y + rng.uniform(-1e-3, 1e-3)) for i, x, y in rows]
    rows += [(30_000 + i, -123.0 + i / 50, 37.0, -121.0, 39.0) for i in range(50)] + [(40_000, None, None, None, None)]
    df = spark.createDataFrame(rows, "segment_id long, x0 double, y0 double, x1 double, y1 double")
    df = df.withColumn("pts", F.when(F.col("x0").isNotNull(), geo.line_from_columns("x0", "y0", "x1", "y1")))
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size", str(64 << 10))
    try:
        tables.write_segments(df, f"{tmpdir_path}/s")
        tables.write_points(df.select("segment_id", "x0", "y0"), f"{tmpdir_path}/p", "x0", "y0")
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.block.size")
    stored, points = spark.read.parquet(f"{tmpdir_path}/s"), spark.read.parquet(f"{tmpdir_path}/p")
    groups = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in stored.inputFiles()]
    stats = [m.row_group(i).column(m.schema.names.index("curve")).statistics for m in groups for i in range(m.num_row_groups)]
    for box in ((-122.05, 38.0, -122.0, 38.05), (-121.5, 37.2, -121.46, 37.24), (-123.0, 37.0, -121.0, 39.0)):
        want = sorted(r.segment_id for r in spatial.segments_in_viewport(df, box).collect())
        assert sorted(r.segment_id for r in spatial.segments_in_viewport(stored, box).collect()) == want and want
        dots = df.where(geo.point_in_box(F.col("x0"), F.col("y0"), box))
        assert spatial.within_box(points, box, "x0", "y0").count() == dots.count() > 0
        ranges = curve.key_ranges(box)
        opened = sum(any(a <= s.max and b >= s.min for a, b in ranges) for s in stats)
        if box[2] - box[0] < 1:
            assert len(stats) > 30 and opened <= 0.25 * len(stats), (opened, len(stats))


def test_ranges_reach_the_scan(spark, tmpdir_path):
    df = spark.createDataFrame([(1, 0.5, 0.5)], "id long, longitude double, latitude double")
    tables.write_points(df, f"{tmpdir_path}/p")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = spatial.within_box(spark.read.parquet(f"{tmpdir_path}/p"), (0.0, 0.0, 1.0, 1.0))._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(curve" in plan and "PushedFilters" in plan
