"""Nearest-neighbour join over k-d cuts: dense, remote, collinear, tied and hot inputs against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corridor.operators import nearest, spatial
from corridor.operators.nearest import Cuts

SHAPES = {
    "even": lambda rng: (rng.uniform(-10, 10), rng.uniform(-10, 10)),
    "dense": lambda rng: (5 + rng.gauss(0, 1e-4), 5 + rng.gauss(0, 1e-4)) if rng.random() < 0.9 else (rng.uniform(-170, 170), rng.uniform(-80, 80)),
    "collinear": lambda rng: (rng.uniform(-10, 10), 3.0),
    "diagonal": lambda rng: (lambda v: (v, v))(rng.randrange(-40, 40) / 4),
    "lattice": lambda rng: (float(rng.randrange(6)), float(rng.randrange(5))),
    "circle": lambda rng: (lambda a: (10 * math.cos(a), 10 * math.sin(a)))(rng.uniform(0, 6.283)),
    "one": lambda rng: (1.0, 2.0),
}


def brute(x, y, px, py):
    d2 = (x - px[:, None]) ** 2 + (y - py[:, None]) ** 2
    return d2.min(axis=1), d2.argmin(axis=1)


@pytest.mark.parametrize("shape", sorted(SHAPES))
def test_tree_equals_brute_force(shape):
    rng = random.Random(shape)
    for n, bucket in ((1, 4), (3, 1), (700, 4), (700, 32)):
        x, y = (np.array(c, float) for c in zip(*[SHAPES[shape](rng) for _ in range(n)]))
        px, py = (np.array(c, float) for c in zip(*[SHAPES[rng.choice(sorted(SHAPES))](rng) for _ in range(400)] + [(500.0, -500.0)]))
        cuts = Cuts(x, y, bucket)
        d2, row = cuts.nearest(px, py)
        want = brute(x, y, px, py)
        assert np.array_equal(d2, want[0]) and np.array_equal(row, want[1])
        assert sorted(cuts.order) == list(range(n)) and set(cuts.leaf_of(x, y)) == set(cuts.leaves())
        if len(set(zip(x, y))) == n:
            assert max(b - a for k, (a, b) in enumerate(cuts.range) if cuts.axis[k] < 0) <= bucket


def test_leaves_within_a_bound():
    rng = random.Random(2)
    x, y = (np.array(c) for c in zip(*[SHAPES["dense"](rng) for _ in range(500)]))
    px, py = (np.array(c) for c in zip(*[SHAPES["even"](rng) for _ in range(100)]))
    cuts = Cuts(x, y, 20)
    bound = brute(x, y, px, py)[0]
    leaf, own = cuts.leaf_of(x, y), cuts.leaf_of(px, py)
    for i, found in enumerate(cuts.within(px, py, bound, own)):
        best = (x - px[i]) ** 2 + (y - py[i]) ** 2 == bound[i]
        assert set(leaf[best]) <= set(found) | {own[i]} and own[i] not in found


@pytest.mark.parametrize("shape", ["circle", "collinear", "dense", "lattice"])
def test_join_equals_brute_force(spark, shape):
    rng = random.Random(shape)
    stations = [(f"s{i:04d}", *SHAPES[shape](rng), rng.randrange(3)) for i in range(500)]
    points = [(i, *SHAPES[rng.choice(sorted(SHAPES))](rng)) for i in range(250)] + [(900, 400.0, -300.0), (901, 1.0, 2.0)]
    st = spark.createDataFrame(stations, "id string, longitude double, latitude double, t long").withColumn("timestamp", F.timestamp_seconds("t"))
    pt = spark.createDataFrame([*points, (950, None, 1.0), (951, float("nan"), 1.0)], "pid long, px double, py double")
    want = {p: min(stations, key=lambda s: ((s[1] - x) ** 2 + (s[2] - y) ** 2, -s[3], s[0]))[0] for p, x, y in points}
    for options in ({}, {"broadcast_rows": 0, "leaf_rows": 40}):
        got = spatial.nearest_join(pt, st, "pid", "px", "py", **options)
        assert got.columns == ["pid", "longitude", "latitude", "id", "t", "timestamp", "d2"]
        assert {r.pid: r.id for r in got.collect()} == want
        if shape == "lattice":
            assert spatial.nearest_join(pt, st.limit(0), "pid", "px", "py", **options).count() == 0
            assert spatial.nearest_join(pt.limit(0), st, "pid", "px", "py", **options).count() == 0


def test_a_hot_leaf_is_searched_in_parts(spark, monkeypatch):
    monkeypatch.setattr(nearest, "POINTS", 100)
    st = spark.range(300).select(F.col("id"), (F.col("id") % 20).cast("double").alias("longitude"),
                                 (F.col("id") / 20).alias("latitude"), F.lit(0).cast("timestamp").alias("timestamp"))
    pt = spark.range(2000).select(F.col("id").alias("pid"), F.lit(3.1).alias("px"), F.lit(4.1).alias("py"))
    got = spatial.nearest_join(pt, st, "pid", "px", "py", broadcast_rows=0, leaf_rows=30)
    assert got.count() == 2000 and got.select("id").distinct().count() == 1
