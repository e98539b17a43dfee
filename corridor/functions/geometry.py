"""Geometry as nested arrays of ``struct<x: double, y: double>`` (lon, lat).

Spark has no spatial predicates, so the few the reference needs are column
expressions: EWKT text in and out, ring closing, bounding boxes, an exact
segment/box intersection test and planar distance. Everything stays inside
codegen; nothing runs in Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corridor.functions import fields as fl

SRID = 4326
# Fixed value: tolerance for "first point equals last point" of a ring.
RING_CLOSE_TOLERANCE = 1e-7

_NUM = r"(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL\(\d+,\d+\))"


def _pairs_ok(pts: Column) -> Column:
    """Every element is a pair of non-null numbers."""
    return F.forall(pts, lambda p: (F.size(p) == 2) & p[0].isNotNull() & p[1].isNotNull())


def coordinate_nesting(df: DataFrame, name: str = "coordinates"):
    """Return ``(depth, points, rings)`` for a coordinates field.

    depth is 2 for a flat list of pairs, 3 for a list of rings of pairs,
    NULL when the value is neither. ``points`` is ``array<array<double>>``
    (depth 2) and ``rings`` is ``array<array<array<double>>>`` (depth 3).
    """
    k = fl.kind(df, name)
    c = fl.raw(df, name)
    a2 = T.ArrayType(T.ArrayType(T.DoubleType()))
    a3 = T.ArrayType(a2)
    if k == fl.STRING:
        v = F.try_parse_json(c)
    elif k == fl.VARIANT:
        v = c
    elif k == fl.ARRAY:
        t = df.schema[name].dataType
        depth = 0
        while isinstance(t, T.ArrayType):
            depth, t = depth + 1, t.elementType
        if depth == 2:
            pts = c.cast(a2)
            return F.when(_pairs_ok(pts), F.lit(2)), pts, F.lit(None).cast(a3)
        if depth == 3:
            rings = c.cast(a3)
            ok = F.forall(rings, lambda r: _pairs_ok(r))
            return F.when(ok, F.lit(3)), F.lit(None).cast(a2), rings
        return F.lit(None).cast("int"), F.lit(None).cast(a2), F.lit(None).cast(a3)
    else:
        return F.lit(None).cast("int"), F.lit(None).cast(a2), F.lit(None).cast(a3)
    t = F.schema_of_variant(v)
    pts = F.try_variant_get(v, "$", "array<array<double>>")
    rings = F.try_variant_get(v, "$", "array<array<array<double>>>")
    is2 = t.rlike(rf"^ARRAY<ARRAY<{_NUM}>>$") & _pairs_ok(pts)
    is3 = t.rlike(rf"^ARRAY<ARRAY<ARRAY<{_NUM}>>>$") & F.forall(rings, lambda r: _pairs_ok(r))
    empty = t == "ARRAY<VOID>"
    depth = F.when(is2 | empty, F.lit(2)).when(is3, F.lit(3))
    pts = F.when(empty, F.array().cast(a2)).otherwise(pts)
    return depth, pts, rings


def close_outer_ring(rings: Column) -> Column:
    """Append the first point to the outer ring when first and last differ."""
    def fix(r, i):
        first, last = r[0], F.element_at(r, -1)
        open_ = ((F.abs(first[0] - last[0]) > RING_CLOSE_TOLERANCE) |
                 (F.abs(first[1] - last[1]) > RING_CLOSE_TOLERANCE))
        return F.when((i == 0) & open_, F.array_append(r, first)).otherwise(r)
    return F.transform(rings, fix)


def xy(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def to_xy_rings(rings: Column) -> Column:
    """``array<array<array<double>>>`` -> ``array<array<struct<x,y>>>``."""
    return F.transform(rings, lambda r: F.transform(r, lambda p: xy(p[0], p[1])))


def line_from_columns(*cols: str) -> Column:
    """Build a line from scalar columns ``x0, y0, x1, y1, ...``."""
    return F.array(*[xy(F.col(cols[i]), F.col(cols[i + 1])) for i in range(0, len(cols), 2)])


# --- EWKT -----------------------------------------------------------------

def _num(c: Column) -> Column:
    return c.cast("string")


def _coords_text(pts: Column) -> Column:
    return F.array_join(F.transform(pts, lambda p: F.concat(_num(p.x), F.lit(" "), _num(p.y))), ", ")


def ewkt_point(lon: Column, lat: Column) -> Column:
    return F.concat(F.lit(f"SRID={SRID};POINT("), _num(lon), F.lit(" "), _num(lat), F.lit(")"))


def ewkt_linestring(pts: Column) -> Column:
    return F.concat(F.lit(f"SRID={SRID};LINESTRING("), _coords_text(pts), F.lit(")"))


def ewkt_polygon(rings: Column) -> Column:
    body = F.array_join(F.transform(rings, lambda r: F.concat(F.lit("("), _coords_text(r), F.lit(")"))), ", ")
    return F.concat(F.lit(f"SRID={SRID};POLYGON("), body, F.lit(")"))


def ewkt_geometry(gtype: Column, rings: Column) -> Column:
    """EWKT for a zone: LineString uses the single ring as the line."""
    return F.when(gtype == "Polygon", ewkt_polygon(rings)).otherwise(ewkt_linestring(rings[0]))


def _parse_points(text: Column) -> Column:
    return F.transform(F.split(F.trim(text), r",\s*"),
                       lambda p: xy(F.split(F.trim(p), r"\s+")[0].try_cast("double"),
                                    F.split(F.trim(p), r"\s+")[1].try_cast("double")))


def parse_ewkt(text: Column) -> Column:
    """EWKT -> ``struct<srid, type, rings array<array<struct<x,y>>>>``.

    A point is one ring of one point, a line is one ring.
    """
    m = r"^SRID=(\d+);([A-Za-z]+)\((.*)\)$"
    srid = F.regexp_extract(text, m, 1).try_cast("int")
    gtype = F.upper(F.regexp_extract(text, m, 2))
    body = F.regexp_extract(text, m, 3)
    ring_texts = F.split(F.regexp_replace(F.regexp_replace(body, r"^\s*\(", ""), r"\)\s*$", ""),
                         r"\)\s*,\s*\(")
    rings = (F.when(gtype == "POLYGON", F.transform(ring_texts, _parse_points))
             .otherwise(F.array(_parse_points(body))))
    name = (F.when(gtype == "POINT", F.lit("Point")).when(gtype == "LINESTRING", F.lit("LineString"))
            .when(gtype == "POLYGON", F.lit("Polygon")))
    return F.struct(srid.alias("srid"), name.alias("type"), rings.alias("rings"))


# --- boxes, intersection, distance ----------------------------------------

def bbox(pts: Column) -> tuple[Column, Column, Column, Column]:
    """(min_x, min_y, max_x, max_y). ``pts.x`` extracts a field from every
    element without a lambda, so this stays in generated code."""
    xs, ys = pts.getField("x"), pts.getField("y")
    return F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys)


def check_box(min_lon: float, min_lat: float, max_lon: float, max_lat: float) -> None:
    """Viewport argument check: ordered, within lon/lat ranges."""
    if not (-180.0 <= min_lon <= 180.0 and -180.0 <= max_lon <= 180.0 and
            -90.0 <= min_lat <= 90.0 and -90.0 <= max_lat <= 90.0):
        raise ValueError("viewport coordinates out of range")
    if min_lon >= max_lon:
        raise ValueError("min_lon must be strictly less than max_lon.")
    if min_lat >= max_lat:
        raise ValueError("min_lat must be strictly less than max_lat.")


def point_in_box(x: Column, y: Column, box) -> Column:
    """Closed box test (boundary counts)."""
    x1, y1, x2, y2 = (F.lit(float(v)) for v in box)
    return x.between(x1, x2) & y.between(y1, y2)


def segment_box_intersects(a: Column, b: Column, box) -> Column:
    """Exact closed test of segment a-b against an axis-aligned box.

    Separating-axis form: the bounding boxes overlap, and the four box corners
    are not all strictly on one side of the line through a and b. A zero
    length segment degenerates to the point test.
    """
    x1, y1, x2, y2 = (F.lit(float(v)) for v in box)
    overlap = ((F.greatest(a.x, b.x) >= x1) & (F.least(a.x, b.x) <= x2) &
               (F.greatest(a.y, b.y) >= y1) & (F.least(a.y, b.y) <= y2))
    dx, dy = b.x - a.x, b.y - a.y
    f = [dx * (cy - a.y) - dy * (cx - a.x) for cx, cy in ((x1, y1), (x2, y1), (x1, y2), (x2, y2))]
    return overlap & (F.least(*f) <= 0) & (F.greatest(*f) >= 0)


def line_box_intersects(pts: Column, box) -> Column:
    """Does any piece of the line touch the closed box?

    The pieces are ``arrays_zip`` of the line with itself shifted by one, so
    the line is evaluated once per row, outside the lambda.
    """
    n = F.size(pts)
    pairs = F.arrays_zip(F.slice(pts, 1, n - 1).alias("a"), F.slice(pts, 2, n - 1).alias("b"))
    pieces = F.exists(pairs, lambda z: segment_box_intersects(z.getField("a"), z.getField("b"), box))
    return F.when(n >= 2, pieces).when(n == 1, point_in_box(pts[0].x, pts[0].y, box)) \
        .otherwise(F.lit(False))


def planar_d2(x: Column, y: Column, x0: Column, y0: Column) -> Column:
    """Squared planar distance in degrees (the ``<->`` ordering)."""
    return (x - x0) * (x - x0) + (y - y0) * (y - y0)


# Fixed value: mean Earth radius (m) for the haversine approximation.
EARTH_RADIUS_M = 6371008.8


def haversine_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dp, dl = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    h = F.pow(F.sin(dp / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), 2)
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(h))
