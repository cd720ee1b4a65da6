"""Geometry as Column expressions. A ring is an array of struct<x double, y double> whose last vertex repeats the first."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Units of the two acreage conventions in use, and of miles: fixed values.
ACRES_PER_M2_EXACT = 1 / 4046.856
ACRES_PER_M2_ROUNDED = 0.000247105
METRES_PER_MILE = 1609.34


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def box_ring(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    """Counter-clockwise ring of an axis-parallel box."""
    return F.array(point(xmin, ymin), point(xmax, ymin), point(xmax, ymax), point(xmin, ymax), point(xmin, ymin))


def segments(ring: Column) -> Column:
    """Pairs of neighbouring vertices: array of struct<a, b>."""
    n = F.size(ring)
    return F.when(n > 1, F.zip_with(F.slice(ring, 1, F.greatest(n - 1, F.lit(0))), F.slice(ring, 2, F.greatest(n - 1, F.lit(0))), lambda a, b: F.struct(a.alias("a"), b.alias("b")))).otherwise(F.array().cast("array<struct<a:struct<x:double,y:double>,b:struct<x:double,y:double>>>"))


def _sum(parts: Column, term) -> Column:
    return F.aggregate(parts, F.lit(0.0), lambda acc, s: acc + term(s))


def _cross(s: Column) -> Column:
    return s["a"]["x"] * s["b"]["y"] - s["b"]["x"] * s["a"]["y"]


def signed_area(ring: Column) -> Column:
    return _sum(segments(ring), _cross) / 2


def area(ring: Column) -> Column:
    """Shoelace area; rings in either direction."""
    return F.abs(signed_area(ring))


def length(ring: Column) -> Column:
    return _sum(segments(ring), lambda s: F.hypot(s["b"]["x"] - s["a"]["x"], s["b"]["y"] - s["a"]["y"]))


def centroid(ring: Column) -> Column:
    """Area centroid; the first vertex where the area is 0."""
    a = signed_area(ring) * 6
    cx = _sum(segments(ring), lambda s: (s["a"]["x"] + s["b"]["x"]) * _cross(s))
    cy = _sum(segments(ring), lambda s: (s["a"]["y"] + s["b"]["y"]) * _cross(s))
    return F.when(a != 0, F.struct((cx / a).alias("x"), (cy / a).alias("y"))).otherwise(F.get(ring, 0))


def shape_centroid(rings: Column) -> Column:
    """Area centroid of outlines, whose holes run the other way; null where the area is 0. Moments are taken from the first
    vertex, as large coordinates would swamp them."""
    o = F.get(F.get(rings, 0), 0)
    near = F.transform(rings, lambda r: F.transform(r, lambda p: point(p["x"] - o["x"], p["y"] - o["y"])))
    total = lambda term: F.aggregate(F.transform(near, lambda r: _sum(segments(r), term)), F.lit(0.0), lambda a, v: a + v)
    a = total(_cross) * 3
    x, y = total(lambda s: (s["a"]["x"] + s["b"]["x"]) * _cross(s)), total(lambda s: (s["a"]["y"] + s["b"]["y"]) * _cross(s))
    return F.when(a != 0, F.struct((o["x"] + x / a).alias("x"), (o["y"] + y / a).alias("y")))


def bounds(ring: Column) -> Column:
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"), F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax"))


def vertex_count(ring: Column) -> Column:
    return F.size(ring)


def point_segment_distance(x: Column, y: Column, s: Column) -> Column:
    dx, dy = s["b"]["x"] - s["a"]["x"], s["b"]["y"] - s["a"]["y"]
    d2 = dx * dx + dy * dy
    t = F.when(d2 > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), ((x - s["a"]["x"]) * dx + (y - s["a"]["y"]) * dy) / d2))).otherwise(0.0)
    return F.hypot(x - (s["a"]["x"] + t * dx), y - (s["a"]["y"] + t * dy))


def contains(ring: Column, x: Column, y: Column) -> Column:
    """True strictly inside, by ray casting; the boundary belongs to no polygon."""
    def crosses(s):
        up = (s["a"]["y"] > y) != (s["b"]["y"] > y)
        return (up & (x < (s["b"]["x"] - s["a"]["x"]) * (y - s["a"]["y"]) / (s["b"]["y"] - s["a"]["y"]) + s["a"]["x"])).cast("int")

    on = F.exists(segments(ring), lambda s: point_segment_distance(x, y, s) == 0)
    return ~on & (F.aggregate(segments(ring), F.lit(0), lambda acc, s: acc + F.coalesce(crosses(s), F.lit(0))) % 2 == 1)


def covers(ring: Column, x: Column, y: Column) -> Column:
    """Inside or on the boundary."""
    return contains(ring, x, y) | F.exists(segments(ring), lambda s: point_segment_distance(x, y, s) == 0)


def distance(ring: Column, x: Column, y: Column, is_area: bool = True) -> Column:
    """Metres from a point to a line or, with is_area, to a polygon (0 inside)."""
    edge = F.array_min(F.transform(segments(ring), lambda s: point_segment_distance(x, y, s)))
    return F.when(contains(ring, x, y), F.lit(0.0)).otherwise(edge) if is_area else edge


def same_within(a: Column, b: Column, tolerance: float = 0.001) -> Column:
    """Equal vertex by vertex up to a tolerance."""
    far = F.zip_with(a, b, lambda p, q: F.greatest(F.abs(p["x"] - q["x"]), F.abs(p["y"] - q["y"])))
    return (F.size(a) == F.size(b)) & (F.coalesce(F.array_max(far), F.lit(0.0)) <= tolerance)


def snap(ring: Column, grid: float = 1.0) -> Column:
    """Vertices on a grid, repeated neighbours dropped."""
    moved = F.transform(ring, lambda p: point(F.rint(p["x"] / grid) * grid, F.rint(p["y"] / grid) * grid))
    return F.aggregate(moved, F.array().cast("array<struct<x:double,y:double>>"), lambda acc, p: F.when((F.size(acc) > 0) & (F.element_at(acc, -1) == p), acc).otherwise(F.concat(acc, F.array(p))))


def is_valid(ring: Column) -> Column:
    """Closed, with area."""
    return (F.size(ring) >= 4) & (F.get(ring, 0) == F.element_at(ring, -1)) & (area(ring) > 0)


def clip_ring(ring: list[tuple[float, float]], xmin: float, ymin: float, xmax: float, ymax: float) -> list[tuple[float, float]]:
    """Sutherland-Hodgman clip of a closed ring to a box, closed; empty if nothing is left."""
    for axis, bound, sign in ((0, xmin, 1), (0, xmax, -1), (1, ymin, 1), (1, ymax, -1)):
        out = []
        for p, q in zip(ring[:-1], ring[1:], strict=True):
            p_in, q_in = sign * (p[axis] - bound) >= 0, sign * (q[axis] - bound) >= 0
            if p_in != q_in:
                t = (bound - p[axis]) / (q[axis] - p[axis])
                cut = [p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])]
                cut[axis] = bound
                out.append(tuple(cut))
            if q_in:
                out.append(q)
        ring = [*out, out[0]] if out else []
    return ring


def clip_to_box(ring: Column, xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    """clip_ring on Arrow batches: as an expression, each of the four cuts would repeat the ones before it."""

    @F.pandas_udf("array<struct<x:double,y:double>>")
    def clip(rings: pd.Series, a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
        def one(ring, *box):
            if ring is None:
                return None
            return [{"x": x, "y": y} for x, y in clip_ring([(p["x"], p["y"]) for p in ring], *box)]

        return pd.Series([one(*v) for v in zip(rings, a, b, c, d, strict=True)], dtype=object)

    return clip(ring, *[v.cast("double") for v in (xmin, ymin, xmax, ymax)])


def hull_ring(points: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """Counter-clockwise convex hull, closed; vertices on its edges are left out. Points on one line, or fewer than three: empty."""
    ordered, sides = sorted(set(points)), []
    for run in (ordered, ordered[::-1]):
        side: list[tuple[float, float]] = []
        for x, y in run:
            while len(side) > 1 and (side[-1][0] - side[-2][0]) * (y - side[-2][1]) <= (side[-1][1] - side[-2][1]) * (x - side[-2][0]):
                side.pop()
            side.append((x, y))
        sides += side[:-1]
    return [*sides, sides[0]] if len(sides) > 2 else []


def convex_hull(ring: Column) -> Column:
    """hull_ring on Arrow batches; null stays null."""

    @F.pandas_udf("array<struct<x:double,y:double>>")
    def hull(rings: pd.Series) -> pd.Series:
        return pd.Series([None if r is None else [{"x": x, "y": y} for x, y in hull_ring([(p["x"], p["y"]) for p in r])] for r in rings], dtype=object)

    return hull(ring)


def hull_area(ring: Column, hull: Column) -> Column:
    """Area of the convex hull, no less than the ring's own."""
    return F.greatest(area(hull), area(ring))


def hull_ratio(ring: Column, hull: Column) -> Column:
    """Share of its convex hull that a ring fills; 1 where the hull has no area, null for a null ring."""
    whole = hull_area(ring, hull)
    return F.when(ring.isNotNull(), F.when(whole > 0, area(ring) / whole).otherwise(1.0))


def wkt(ring: Column) -> Column:
    return F.concat(F.lit("POLYGON (("), F.array_join(F.transform(ring, lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"))), ", "), F.lit("))"))


def square(x: Column, y: Column, acres: Column) -> Column:
    """Square of an acreage around a point."""
    half = F.sqrt(acres * 4046.856) / 2
    return box_ring(x - half, y - half, x + half, y + half)


#: NAD83 CONUS Albers (EPSG:5070): ellipsoid and standard parallels, fixed values.
A, INV_F, LAT1, LAT2, LAT0, LON0 = 6378137.0, 298.257222101, 29.5, 45.5, 23.0, -96.0
_E2 = (2 - 1 / INV_F) / INV_F
_E = math.sqrt(_E2)


def _m(lat: float) -> float:
    return math.cos(lat) / math.sqrt(1 - _E2 * math.sin(lat) ** 2)


def _q(lat: float) -> float:
    s = math.sin(lat)
    return (1 - _E2) * (s / (1 - _E2 * s * s) - math.log((1 - _E * s) / (1 + _E * s)) / (2 * _E))


_N = (_m(math.radians(LAT1)) ** 2 - _m(math.radians(LAT2)) ** 2) / (_q(math.radians(LAT2)) - _q(math.radians(LAT1)))
_C = _m(math.radians(LAT1)) ** 2 + _N * _q(math.radians(LAT1))
_RHO0 = A * math.sqrt(_C - _N * _q(math.radians(LAT0))) / _N


def albers(lon: Column, lat: Column) -> Column:
    """EPSG:4326 degrees to EPSG:5070 metres."""
    s = F.sin(F.radians(lat))
    q = (1 - _E2) * (s / (1 - _E2 * s * s) - F.log((1 - _E * s) / (1 + _E * s)) / (2 * _E))
    rho, theta = A * F.sqrt(_C - _N * q) / _N, _N * F.radians(lon - LON0)
    return F.struct((rho * F.sin(theta)).alias("x"), (_RHO0 - rho * F.cos(theta)).alias("y"))


def inverse_albers(x: Column, y: Column) -> Column:
    """EPSG:5070 metres to EPSG:4326 degrees, by the authalic latitude series."""
    rho = F.hypot(x, _RHO0 - y)
    q = (_C - rho * rho * _N * _N / (A * A)) / _N
    pole = 1 - (1 - _E2) / (2 * _E) * math.log((1 - _E) / (1 + _E))
    beta = F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), q / pole)))
    e2, e4, e6 = _E2, _E2**2, _E2**3
    lat = beta + (e2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040) * F.sin(2 * beta) + (23 * e4 / 360 + 251 * e6 / 3780) * F.sin(4 * beta) + 761 * e6 / 45360 * F.sin(6 * beta)
    return F.struct((LON0 + F.degrees(F.atan2(x, _RHO0 - y)) / _N).alias("lon"), F.degrees(lat).alias("lat"))


def great_circle(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Metres on the mean sphere: for discs of a few kilometres around a station."""
    h = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * 6371008.8 * F.asin(F.sqrt(F.least(F.lit(1.0), h)))
