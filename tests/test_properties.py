"""Property tests against brute force on small random fixtures.

Each property batches many random cases into one DataFrame, so one Spark
job checks them all.
"""

import datetime as dt
import random

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corridor.functions import geometry as geo
from corridor.operators import spatial, transform


def _clip_hits(ax, ay, bx, by, box):
    """Brute force: Liang-Barsky clipping of the segment against the closed box."""
    x1, y1, x2, y2 = box
    dx, dy = bx - ax, by - ay
    t0, t1 = 0.0, 1.0
    for p, q in ((-dx, ax - x1), (dx, x2 - ax), (-dy, ay - y1), (dy, y2 - ay)):
        if p == 0:
            if q < 0:
                return False
        else:
            t = q / p
            if p < 0:
                t0 = max(t0, t)
            else:
                t1 = min(t1, t)
            if t0 > t1:
                return False
    return True


coord = st.integers(-8, 8).map(lambda v: v / 4)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(coord, coord, coord, coord), min_size=50, max_size=120))
def test_segment_box_matches_clipping(spark, segs):
    box = (-0.5, -0.25, 1.0, 0.75)
    df = spark.createDataFrame([(i, *s) for i, s in enumerate(segs)],
                               "i long, ax double, ay double, bx double, by double")
    pts = F.array(geo.xy(F.col("ax"), F.col("ay")), geo.xy(F.col("bx"), F.col("by")))
    got = {r.i: r.hit for r in df.select("i", geo.line_box_intersects(pts, box).alias("hit")).collect()}
    for i, (ax, ay, bx, by) in enumerate(segs):
        assert got[i] == _clip_hits(ax, ay, bx, by, box), (ax, ay, bx, by)


def test_knn_matches_brute_force(spark):
    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    # Stations on a coarse lattice (equal distances happen), repeated snapshots.
    stations = [(sid, rnd.randint(0, 30) / 10, rnd.randint(0, 20) / 10,
                 base + dt.timedelta(minutes=rnd.randint(0, 5)), float(sid))
                for sid in range(400)]
    points = [(pid, rnd.uniform(-3, 6), rnd.uniform(-2, 4)) for pid in range(300)]
    sdf = spark.createDataFrame(stations, "snapshot_id long, longitude double, latitude double, "
                                          "observed_at timestamp, temperature double")
    pdf = spark.createDataFrame(points, "pid long, x double, y double")
    got = {r.pid: r.snapshot_id for r in
           spatial.nearest_join(pdf, sdf, "pid", "x", "y", ts="observed_at", tiebreak="snapshot_id",
                                broadcast_rows=0, leaf_rows=4).collect()}
    for pid, x, y in points:
        best = min(stations, key=lambda s: ((s[1] - x) * (s[1] - x) + (s[2] - y) * (s[2] - y),
                                            -s[3].timestamp(), s[0]))
        assert got[pid] == best[0], pid


def test_knn_far_points_and_single_cell(spark):
    base = dt.datetime(2024, 1, 1)
    sdf = spark.createDataFrame([(1, 0.0, 0.0, base), (2, 0.0, 0.0, base), (3, 50.0, 50.0, base)],
                                "snapshot_id long, longitude double, latitude double, observed_at timestamp")
    pdf = spark.createDataFrame([(1, 100.0, 100.0), (2, -20.0, 1.0), (3, 0.0, 0.0)], "pid long, x double, y double")
    got = {r.pid: r.snapshot_id for r in spatial.nearest_join(pdf, sdf, "pid", "x", "y", ts="observed_at",
                                                              tiebreak="snapshot_id").collect()}
    assert got == {1: 3, 2: 1, 3: 1}


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 3), st.floats(0, 100, allow_nan=False)),
                min_size=1, max_size=60))
def test_keep_last_idempotent_and_matches_pandas(spark, rows):
    t0 = dt.datetime(2024, 1, 1)
    data = [(i, seg, t0 + dt.timedelta(hours=h), v) for i, (seg, h, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "ordinal long, segment_id long, ts timestamp, v double")
    once = transform.keep_last(df, ["segment_id", "ts"], "ordinal")
    twice = transform.keep_last(once, ["segment_id", "ts"], "ordinal")
    a = sorted(tuple(r) for r in once.select("segment_id", "ts", "v").collect())
    assert a == sorted(tuple(r) for r in twice.select("segment_id", "ts", "v").collect())
    p = pd.DataFrame(data, columns=["ordinal", "segment_id", "ts", "v"]).sort_values("ordinal")
    exp = p.groupby(["segment_id", "ts"], as_index=False).last()
    assert a == sorted((int(r.segment_id), r.ts.to_pydatetime(), r.v) for r in exp.itertuples())


@settings(max_examples=3, deadline=None)
@given(st.lists(st.decimals(min_value=-10000, max_value=10000, places=4, allow_nan=False,
                            allow_infinity=False), min_size=20, max_size=80))
def test_rnd_half_away_from_zero(spark, values):
    """rnd(x, 2) equals decimal half-up rounding of the printed value, and is
    within half a unit of x."""
    from decimal import ROUND_HALF_UP, Decimal

    from corridor.functions.numeric import rnd
    xs = [float(v) for v in values]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i long, x double")
    got = {r.i: r.r for r in df.select("i", rnd(F.col("x"), 2).alias("r")).collect()}
    for i, x in enumerate(xs):
        exp = float(Decimal(repr(x)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))
        assert got[i] == exp, (x, got[i], exp)
        assert abs(got[i] - x) <= 0.005 + 1e-9


def test_knn_far_pass_is_exact(spark):
    """With a station per leaf almost every point's bound crosses into other leaves."""
    rnd = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    stations = [(sid, rnd.uniform(0, 10), rnd.uniform(0, 10), base, 0.0) for sid in range(30)]
    points = [(pid, rnd.uniform(-20, 30), rnd.uniform(-20, 30)) for pid in range(60)]
    sdf = spark.createDataFrame(stations, "snapshot_id long, longitude double, latitude double, "
                                          "observed_at timestamp, temperature double")
    pdf = spark.createDataFrame(points, "pid long, x double, y double")
    got = {r.pid: r.snapshot_id for r in spatial.nearest_join(
        pdf, sdf, "pid", "x", "y", ts="observed_at", tiebreak="snapshot_id", broadcast_rows=0, leaf_rows=1).collect()}
    assert len(got) == len(points)
    for pid, x, y in points:
        best = min(stations, key=lambda s: ((s[1] - x) ** 2 + (s[2] - y) ** 2, s[0]))
        assert got[pid] == best[0]


def test_knn_dense_cluster_and_remote_points(spark):
    """A dense cluster in small leaves (leaf_rows=4); remote points and
    points just outside the cluster are still answered exactly."""
    rnd = random.Random(11)
    base = dt.datetime(2024, 1, 1)
    cluster = [(i, 10 + rnd.uniform(0, 0.01), 50 + rnd.uniform(0, 0.01)) for i in range(300)]
    sparse = [(300 + i, rnd.uniform(-170, 170), rnd.uniform(-80, 80)) for i in range(20)]
    stations = [(sid, x, y, base + dt.timedelta(seconds=sid % 7)) for sid, x, y in cluster + sparse]
    points = ([(i, rnd.uniform(-179, 179), rnd.uniform(-89, 89)) for i in range(80)] +
              [(100 + i, 10 + rnd.uniform(-0.02, 0.03), 50 + rnd.uniform(-0.02, 0.03)) for i in range(80)])
    sdf = spark.createDataFrame(stations, "snapshot_id long, longitude double, latitude double, observed_at timestamp")
    pdf = spark.createDataFrame(points, "pid long, x double, y double")
    got = {r.pid: r.snapshot_id for r in spatial.nearest_join(
        pdf, sdf, "pid", "x", "y", ts="observed_at", tiebreak="snapshot_id", broadcast_rows=0, leaf_rows=4).collect()}
    assert len(got) == len(points)
    for pid, x, y in points:
        best = min(stations, key=lambda s: ((s[1] - x) * (s[1] - x) + (s[2] - y) * (s[2] - y),
                                            -s[3].timestamp(), s[0]))
        assert got[pid] == best[0], pid


def _severity_py(v):
    """The severity rules, stated plainly, for text input."""
    if v is None:
        return "medium"
    s = v.strip().lower()
    if s in ("low", "medium", "high", "critical"):
        return s
    for words, label in ((("minor", "light"), "low"), (("major", "severe"), "high"),
                         (("block", "fatal", "extreme"), "critical")):
        if any(w in s for w in words):
            return label
    return "medium"


def _status_py(v):
    """The status rules, stated plainly, for text input."""
    if v is None:
        return "active"
    s = v.strip().lower()
    if s in ("active", "resolved", "cleared"):
        return s
    for words, label in ((("open", "report"), "active"), (("close", "end"), "resolved"),
                         (("clear", "done"), "cleared")):
        if any(w in s for w in words):
            return label
    return "active"


_FRAGS = ["minor", "LIGHT", "major", "Severe", "block", "fatal", "extreme", "low", "medium", "High",
          "critical", "open", "Report", "close", "pending", "clear", "done", "active", "resolved",
          "cleared", "x", " ", "\t", "4"]


@settings(max_examples=3, deadline=None)
@given(st.lists(st.one_of(st.none(), st.lists(st.sampled_from(_FRAGS), min_size=1, max_size=4).map("".join)),
                min_size=30, max_size=80))
def test_normalizers_match_stated_rules(spark, values):
    from corridor.functions import normalize as nz
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, v string")
    sev, _ = nz.normalize_severity(df, "v")
    got = {r.i: (r.sev, r.st) for r in df.select("i", sev.alias("sev"),
                                                nz.normalize_status(df, "v").alias("st")).collect()}
    for i, v in enumerate(values):
        assert got[i] == (_severity_py(v), _status_py(v)), repr(v)


@settings(max_examples=3, deadline=None)
@given(st.lists(st.lists(st.tuples(st.floats(-180, 180, allow_nan=False), st.floats(-90, 90, allow_nan=False)),
                         min_size=2, max_size=6), min_size=5, max_size=30))
def test_ewkt_round_trip(spark, lines):
    """Writing a line as EWKT and parsing it back gives the same doubles."""
    df = spark.createDataFrame([(i, [(float(x), float(y)) for x, y in pts]) for i, pts in enumerate(lines)],
                               "i long, pts array<struct<x: double, y: double>>")
    back = df.select("i", geo.parse_ewkt(geo.ewkt_linestring(F.col("pts"))).alias("g"))
    got = {r.i: [(p.x, p.y) for p in r.g.rings[0]] for r in back.collect()}
    for i, pts in enumerate(lines):
        assert got[i] == [(float(x) + 0.0, float(y) + 0.0) for x, y in pts]


def _close_py(ring):
    """Stated rule: >= 4 points, else rejected; open beyond 1e-7 -> append the first."""
    if len(ring) < 4:
        return None
    (x0, y0), (xn, yn) = ring[0], ring[-1]
    if abs(x0 - xn) > 1e-7 or abs(y0 - yn) > 1e-7:
        return ring + [ring[0]]
    return ring


@settings(max_examples=3, deadline=None)
@given(st.lists(st.tuples(st.lists(st.tuples(st.integers(-5, 5), st.integers(-5, 5)), min_size=2, max_size=6),
                          st.sampled_from([0.0, 5e-8, 2e-7, None])), min_size=10, max_size=40))
def test_polygon_rule(spark, cases):
    import json
    from corridor.operators import validate
    rows, expect = [], {}
    for i, (pts, nudge) in enumerate(cases):
        ring = [[float(x), float(y)] for x, y in pts]
        if nudge is not None:                       # end near (or at) the first point
            ring = ring + [[ring[0][0] + nudge, ring[0][1]]]
        rows.append((i, "Polygon", json.dumps([ring]), "2024-01-01T00:00:00Z"))
        expect[i] = _close_py([tuple(p) for p in ring])
    df = spark.createDataFrame(rows, "zone_id long, geometry_type string, coordinates string, start_date string")
    valid, rejected = validate.validate_construction(df, keep=("zone_id",))
    got = {r.zone_id: [(p.x, p.y) for p in r.rings[0]] for r in valid.collect()}
    bad = {r.zone_id for r in rejected.collect()}
    for i, exp in expect.items():
        if exp is None:
            assert i in bad
        else:
            assert got[i] == [tuple(p) for p in exp], (i, got[i], exp)
