"""Exact nearest-neighbour join over adaptive k-d cuts.

1. Stations are collapsed to one row per location (``latest_per_location``).
2. Few locations (BROADCAST_ROWS, counted) go to every task, which searches
   them through a k-d tree; nothing of the points is shuffled.
3. More are cut into leaves: a k-d tree over a sample of at most some SAMPLE locations
   puts equal numbers into each leaf, however uneven the map is. Locations and points
   are dealt to leaves; a leaf with many points is salted, with its
   locations in each part. Each part is searched through a k-d tree of its own,
   which gives every point a best location and so a bound.
4. A point goes on to another leaf only if the bounding box of that leaf's
   locations is no farther than its bound; the minimum over its leaves is exact.

Squared planar distances are computed by one formula here and in Spark, and a box or
a cut is skipped only if it is strictly farther: rounding is monotone, so ties
survive. Equal distances are decided by the later time, then the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corridor.session import checkpoint_dir

BROADCAST_ROWS = 50_000     # locations sent to every task: two doubles each
SAMPLE = 1 << 17            # locations that the cuts are drawn from, about
LEAF_ROWS = 20_000          # locations per leaf, until MAX_LEAVES are reached
MAX_LEAVES = 1 << 13
POINTS = 200_000            # points searched together
_BUCKET = 32                # stations compared directly
_PAIRS = 1 << 20            # distances computed at once
_SHARES = 1_000_003


class Cuts:
    """A k-d tree over points: median cuts of the wider axis down to ``bucket`` points."""

    def __init__(self, x: np.ndarray, y: np.ndarray, bucket: int = _BUCKET):
        self.at = (x, y)
        self.order = np.arange(len(x))
        self.axis, self.value, self.kids, self.range, self.box = [], [], [], [], []
        todo = [(0, len(x), -1, 0)]
        while todo:
            lo, hi, up, side = todo.pop()
            node, own = len(self.axis), self.order[lo:hi]
            if up >= 0:
                self.kids[up][side] = node
            xs, ys = x[own], y[own]
            box = (xs.min(), ys.min(), xs.max(), ys.max()) if hi > lo else (np.inf, np.inf, -np.inf, -np.inf)
            wide = int(box[3] - box[1] > box[2] - box[0])
            c = (xs, ys)[wide]
            self.kids.append([-1, -1])
            self.range.append((lo, hi))
            self.box.append(box)
            self.value.append(0.0)
            self.axis.append(-1)
            if hi - lo <= bucket or box[2 + wide] == box[wide]:
                continue
            cut = np.partition(c, len(c) // 2)[len(c) // 2]
            if cut == box[wide]:
                cut = c[c > cut].min()              # many at the least value: they go left together
            left = c < cut
            # Both halves keep the order of their rows, so that of equals the first is found first.
            self.order[lo:hi] = np.concatenate([own[left], own[~left]])
            middle = lo + int(left.sum())
            self.axis[node], self.value[node] = wide, float(cut)
            todo += [(middle, hi, node, 1), (lo, middle, node, 0)]
        self.box = np.array(self.box)

    def leaves(self) -> list[int]:
        return [n for n, a in enumerate(self.axis) if a < 0]

    def leaf_of(self, px: np.ndarray, py: np.ndarray) -> np.ndarray:
        """The leaf whose side of all cuts each point is on."""
        out = np.zeros(len(px), np.int64)
        todo = [(0, np.arange(len(px)))]
        while todo:
            node, own = todo.pop()
            if not len(own):
                continue
            if self.axis[node] < 0:
                out[own] = node
                continue
            left = (px, py)[self.axis[node]][own] < self.value[node]
            todo += [(self.kids[node][0], own[left]), (self.kids[node][1], own[~left])]
        return out

    def _far(self, node: int, px: np.ndarray, py: np.ndarray) -> np.ndarray:
        x0, y0, x1, y1 = self.box[node]
        dx = np.maximum(0.0, np.maximum(x0 - px, px - x1))
        dy = np.maximum(0.0, np.maximum(y0 - py, py - y1))
        return dx * dx + dy * dy

    def nearest(self, px: np.ndarray, py: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(squared distance, first row number among the nearest) for every point."""
        x, y = self.at
        best, row = np.full(len(px), np.inf), np.full(len(px), len(x))
        todo = [(0, np.arange(len(px)))]
        while todo:
            node, own = todo.pop()
            own = own[self._far(node, px[own], py[own]) <= best[own]]
            if not len(own):
                continue
            if self.axis[node] < 0:
                rows = np.sort(self.order[slice(*self.range[node])])
                step = max(1, _PAIRS // max(1, len(rows)))
                for i in range(0, len(own) if len(rows) else 0, step):
                    some = own[i:i + step]
                    dx, dy = x[rows] - px[some, None], y[rows] - py[some, None]
                    d2 = dx * dx + dy * dy
                    k = d2.argmin(axis=1)
                    d2, k = d2[np.arange(len(some)), k], rows[k]
                    nearer = (d2 < best[some]) | ((d2 == best[some]) & (k < row[some]))
                    best[some[nearer]], row[some[nearer]] = d2[nearer], k[nearer]
                continue
            left = (px, py)[self.axis[node]][own] < self.value[node]
            a, b = self.kids[node]
            # The near side is searched first; what it finds spares most of the far side.
            todo += [(b, own[left]), (a, own[~left]), (a, own[left]), (b, own[~left])]
        return best, row

    def within(self, px: np.ndarray, py: np.ndarray, bound: np.ndarray, skip: np.ndarray) -> list[list[int]]:
        """For every point the leaves, other than ``skip``, whose box is no farther than ``bound``."""
        out: list[list[int]] = [[] for _ in px]
        todo = [(0, np.arange(len(px)))]
        while todo:
            node, own = todo.pop()
            own = own[self._far(node, px[own], py[own]) <= bound[own]]
            if not len(own):
                continue
            if self.axis[node] < 0:
                for i in own[skip[own] != node].tolist():
                    out[i].append(node)
                continue
            todo += [(k, own) for k in self.kids[node]]
        return out

    def fit_boxes(self, boxes: dict[int, tuple]) -> None:
        """Give leaves the boxes of all rows that fell to them, and inner nodes those of their leaves."""
        nothing = (np.inf, np.inf, -np.inf, -np.inf)
        for node in range(len(self.axis) - 1, -1, -1):      # kids come after their parent
            if self.axis[node] < 0:
                self.box[node] = boxes.get(node, nothing)
            else:
                a, b = (self.box[k] for k in self.kids[node])
                self.box[node] = (*np.minimum(a, b)[:2], *np.maximum(a, b)[2:])


def _doubles(a: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return a.to_numpy(zero_copy_only=False) if isinstance(a, pa.Array) else a.to_numpy()


def _by_broadcast(points: DataFrame, locs: DataFrame) -> DataFrame:
    """(_p, _px, _py, _x, _y, d2) with all locations in every task, the preferred ones first."""
    rows = locs.orderBy("_t", "_id").select("_x", "_y").collect()
    shared = points.sparkSession.sparkContext.broadcast(np.array([tuple(r) for r in rows], float).reshape(-1, 2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, y = shared.value[:, 0].copy(), shared.value[:, 1].copy()
        cuts = Cuts(x, y)
        for b in batches:
            d2, row = cuts.nearest(_doubles(b.column(1)), _doubles(b.column(2)))
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(x[row]), pa.array(y[row]), pa.array(d2)], _FOUND)

    return points.mapInArrow(run, _schema(points))


_FOUND = ["_p", "_px", "_py", "_x", "_y", "d2"]


def _schema(points: DataFrame) -> T.StructType:
    pid = points.schema["_p"].dataType
    return T.StructType([T.StructField("_p", pid), *[T.StructField(c, T.DoubleType()) for c in _FOUND[1:]]])


def _search(points: DataFrame, locs: DataFrame) -> DataFrame:
    """Best location per point among those of its leaf; both sides have ``_leaf``.

    Parts of POINTS points are searched together; a leaf's locations go to each of its parts.
    """
    spark = points.sparkSession
    counts = points.groupBy("_leaf").count().collect()          # one row per leaf: at most MAX_LEAVES
    parts = spark.createDataFrame([(r["_leaf"], -(-r["count"] // POINTS)) for r in counts], "_leaf long, _parts long")
    dealt = points.join(F.broadcast(parts), "_leaf").withColumn("_part", F.pmod(F.xxhash64("_p", "_px", "_py"), F.col("_parts")))
    copies = (locs.join(F.broadcast(parts), "_leaf")
              .withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1))))

    def run(some: pa.Table, stations: pa.Table) -> pa.Table:
        stations = stations.take(pc.sort_indices(stations, sort_keys=[("_t", "ascending"), ("_id", "ascending")], null_placement="at_start"))
        x, y = _doubles(stations["_x"]), _doubles(stations["_y"])
        if not len(x):
            return pa.table([some[c].slice(0, 0) for c in _FOUND[:3]] + [pa.array([], pa.float64())] * 3, _FOUND)
        d2, row = Cuts(x, y).nearest(_doubles(some["_px"]), _doubles(some["_py"]))
        return pa.table([some["_p"], some["_px"], some["_py"], pa.array(x[row]), pa.array(y[row]), pa.array(d2)], _FOUND)

    return (dealt.select("_leaf", "_part", "_p", "_px", "_py").groupBy("_leaf", "_part")
            .cogroup(copies.select("_leaf", "_part", "_x", "_y", "_t", "_id").groupBy("_leaf", "_part"))
            .applyInArrow(run, _schema(points)))


def _by_leaves(points: DataFrame, locs: DataFrame, n: int, leaf_rows: int) -> DataFrame:
    """As ``_by_broadcast``, with locations and points dealt to the leaves of sampled cuts."""
    sc = points.sparkSession.sparkContext
    share = int(min(1.0, SAMPLE / n) * _SHARES) + 1
    sample = locs.where(F.pmod(F.xxhash64("_x", "_y"), F.lit(_SHARES)) < share).select("_x", "_y").limit(2 * SAMPLE).collect()
    xy = np.array([tuple(r) for r in sample], float).reshape(-1, 2)
    leaves = min(MAX_LEAVES, -(-n // leaf_rows))
    cuts = Cuts(xy[:, 0].copy(), xy[:, 1].copy(), max(1, len(xy) // leaves))
    plain = sc.broadcast(cuts)

    @F.arrow_udf("long")
    def leaf_of(x: pa.Array, y: pa.Array) -> pa.Array:
        return pa.array(plain.value.leaf_of(_doubles(x), _doubles(y)))

    locs = locs.withColumn("_leaf", leaf_of("_x", "_y")).checkpoint()
    boxes = locs.groupBy("_leaf").agg(F.min("_x"), F.min("_y"), F.max("_x"), F.max("_y")).collect()
    cuts.fit_boxes({r[0]: tuple(r)[1:] for r in boxes})
    fitted = sc.broadcast(cuts)

    @F.arrow_udf("array<long>")
    def others(x: pa.Array, y: pa.Array, bound: pa.Array) -> pa.Array:
        px, py = _doubles(x), _doubles(y)
        c = fitted.value
        return pa.array(c.within(px, py, _doubles(bound), c.leaf_of(px, py)), pa.list_(pa.int64()))

    # A point whose own side of the cuts holds no location starts at any leaf that has one.
    some = min(r[0] for r in boxes)
    full = F.broadcast(points.sparkSession.createDataFrame([(r[0],) for r in boxes], "_leaf long").withColumn("_full", F.lit(True)))
    own = points.withColumn("_leaf", leaf_of("_px", "_py")).join(full, "_leaf", "left").withColumn(
        "_leaf", F.when(F.col("_full"), F.col("_leaf")).otherwise(F.lit(some))).drop("_full")
    first = _search(own, locs).checkpoint()
    crossing = first.select("_p", "_px", "_py", F.explode(others("_px", "_py", "d2")).alias("_leaf")).checkpoint()
    if crossing.isEmpty():
        return first
    return first.unionByName(_search(crossing, locs))


def nearest_locations(points: DataFrame, locs: DataFrame, pid: str, px: str, py: str, sx: str, sy: str,
                      order: tuple[Column, Column], broadcast_rows: int = BROADCAST_ROWS, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """``pid``, the columns of the nearest of ``locs`` (one row per location) and ``d2``.

    ``order`` decides between equal distances, smaller values first. Points without
    coordinates, and all points where there is no location, are absent. Counts the
    locations, samples and checkpoints while the frame is built.
    """
    checkpoint_dir(points.sparkSession)
    there = lambda *cs: [F.col(c).isNotNull() & ~F.isnan(F.col(c)) for c in cs]
    wanted = points.select(F.col(pid).alias("_p"), F.col(px).cast("double").alias("_px"), F.col(py).cast("double").alias("_py"))
    wanted = wanted.where(there("_px", "_py")[0] & there("_px", "_py")[1])
    keyed = locs.select(F.col(sx).cast("double").alias("_x"), F.col(sy).cast("double").alias("_y"),
                        order[0].alias("_t"), order[1].alias("_id"))
    keyed = keyed.where(there("_x", "_y")[0] & there("_x", "_y")[1])
    n = keyed.count()
    if not n:
        fields = [points.schema[pid], *locs.schema.fields, T.StructField("d2", T.DoubleType())]
        return points.sparkSession.createDataFrame([], T.StructType(fields))
    found = _by_broadcast(wanted, keyed) if n <= broadcast_rows else _by_leaves(wanted, keyed, n, leaf_rows)
    payload = locs.select(F.col(sx).cast("double").alias("_lx"), F.col(sy).cast("double").alias("_ly"),
                          F.struct(order[0].alias("_t"), order[1].alias("_id")).alias("_o"), *[F.col(f"`{c}`") for c in locs.columns])
    told = found.join(payload, (F.col("_x") == F.col("_lx")) & (F.col("_y") == F.col("_ly")))
    if n <= broadcast_rows:
        return told.select(F.col("_p").alias(pid), *[F.col(f"`{c}`") for c in locs.columns], "d2")
    best = told.groupBy("_p", "_px", "_py").agg(F.min(F.struct("d2", "_o", *[F.col(f"`{c}`") for c in locs.columns])).alias("_b"))
    return best.select(F.col("_p").alias(pid), *[F.col(f"_b.`{c}`") for c in locs.columns], F.col("_b.d2"))
