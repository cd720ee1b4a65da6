"""Shapes as cells of a quadtree: cells wholly inside need no test and add up before they meet points; cells along an outline are
of one small size, and only there a point is tested against a shape.

A shape costs cells along its outline, not over its area, and a point looks up one cell a level, so that sums, counts, minima
and maxima over all shapes around a point never list the pairs. All joins shuffle: Catalyst's size of a side whose rows were
exploded is that of its file, so it would send millions of rows through the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry, sweep
from ..functions.overlay import RINGS, unpacked
from .shared import spread

#: Levels at most, and points to a smallest cell.
DEEPEST, IN_A_CELL = 12, 16
CELL = ["_l", "_cx", "_cy"]
MERGED = {"sum": F.sum, "min": F.min, "max": F.max}


class Kind:
    """What shapes are. bounds: their box. given: columns that `held` needs, and how arrays are made of them. held(of, i, x0, y0, x1,
    y1), in numpy, for shapes i and a box of each: -1 where a shape misses all of it, the band (1 or more) that all of it is in,
    and 0 where it can't be told. at(x, y): the band of a point, null outside."""

    def __init__(self, bounds: tuple[Column, ...], given: list[Column], read: Callable[..., object], held: Callable[..., np.ndarray], at: Callable[..., Column]):
        self.bounds, self.given, self.read, self.held, self.at = bounds, given, read, held, at


def floats(*columns: pa.Array) -> list[np.ndarray]:
    return [c.to_numpy(zero_copy_only=False) for c in columns]


def boxes(xmin: str = "xmin", ymin: str = "ymin", xmax: str = "xmax", ymax: str = "ymax", closed: bool = False) -> Kind:
    """The inside of boxes, with their edges if closed."""
    a, b, c, d = (F.col(n) for n in (xmin, ymin, xmax, ymax))

    def held(of, i, x0, y0, x1, y1):
        west, south, east, north = (v[i] for v in of)
        found = np.where((x1 >= west) & (x0 <= east) & (y1 >= south) & (y0 <= north), 0, -1)
        found[(x0 > west) & (x1 < east) & (y0 > south) & (y1 < north)] = 1
        return found

    def at(x, y):
        return F.when((x >= a) & (x <= c) & (y >= b) & (y <= d) if closed else (x > a) & (x < c) & (y > b) & (y < d), 1)

    return Kind((a, b, c, d), [v.cast("double") for v in (a, b, c, d)], floats, held, at)


def discs(x: str, y: str, limits: list[float]) -> Kind:
    """Rings around points: band i + 1 reaches from the limit before up to limits[i], squared distances in ascending order."""
    cx, cy = F.col(x), F.col(y)
    far, ends = math.sqrt(limits[-1]), np.array(limits, float)

    def held(of, i, x0, y0, x1, y1):
        px, py = (v[i] for v in of)
        near = [np.maximum(0, np.maximum(a - c, c - b)) for c, a, b in ((px, x0, x1), (py, y0, y1))]
        out = [np.maximum(np.abs(c - a), np.abs(c - b)) for c, a, b in ((px, x0, x1), (py, y0, y1))]
        # room for rounding: what can't be told is measured exactly
        low, high = np.searchsorted(ends, (near[0] ** 2 + near[1] ** 2) * (1 - 1e-9)), np.searchsorted(ends, (out[0] ** 2 + out[1] ** 2) * (1 + 1e-9))
        return np.where(low == len(ends), -1, np.where(low == high, low + 1, 0))

    def at(px, py):
        dx, dy = px - cx, py - cy
        d2 = dx * dx + dy * dy
        out = F.when(d2 <= limits[0], 1)
        for k, limit in enumerate(limits[1:], 2):
            out = out.when(d2 <= limit, k)
        return out

    return Kind((cx - far, cy - far, cx + far, cy + far), [cx.cast("double"), cy.cast("double")], floats, held, at)


def polygons(rings: str) -> Kind:
    """The inside of polygons by the even-odd rule over all rings, without their outlines."""
    shape = F.col(rings)
    b = geometry.bounds(F.flatten(shape))

    def read(column):
        edges = [sweep.segments_of(r) for r in unpacked(column)]
        return np.concatenate([*edges, np.empty((0, 4))]), np.cumsum([0, *map(len, edges)])

    def listed(of, i):
        n = of[1][i + 1] - of[1][i]
        k = np.repeat(np.arange(len(i)), n)
        return k, of[0][np.arange(len(k)) - np.repeat(np.cumsum(n) - n, n) + of[1][i][k]].T

    def held(of, i, x0, y0, x1, y1):
        margin = (np.abs(x0) + np.abs(y0) + (x1 - x0)) * 1e-12
        k, (ax, ay, bx, by) = listed(of, i)
        m, mx, my, half = margin[k], (x0 + x1)[k] / 2, (y0 + y1)[k] / 2, (x1 - x0)[k] / 2
        near = (np.maximum(ax, bx) >= x0[k] - m) & (np.minimum(ax, bx) <= x1[k] + m) & (np.maximum(ay, by) >= y0[k] - m) & (np.minimum(ay, by) <= y1[k] + m)
        # the box's middle against the edge's line, and how far the box reaches across it
        near &= np.abs((bx - ax) * (my - ay) - (by - ay) * (mx - ax)) <= (np.abs(bx - ax) + np.abs(by - ay)) * (half + m) * (1 + 1e-9)
        found = np.full(len(i), -1)
        with np.errstate(divide="ignore", invalid="ignore"):
            crosses = ((ay > my) != (by > my)) & (mx < (bx - ax) * (my - ay) / (by - ay) + ax)
        found[np.bincount(k[crosses], minlength=len(i)) % 2 == 1] = 1
        found[k[near]] = 0
        return found

    def at(x, y):
        return F.when(F.aggregate(F.transform(shape, lambda r: geometry.contains(r, x, y).cast("int")), F.lit(0), lambda s, v: s + v) % 2 == 1, 1)

    return Kind((b["xmin"], b["ymin"], b["xmax"], b["ymax"]), [shape.cast(RINGS)], read, held, at)


def grid_for(points: DataFrame, x: str, y: str, shapes: DataFrame, kind: Kind) -> tuple[float, int] | None:
    """The smallest cell, a power of two that holds some points where they lie evenly, and the levels up to the largest shape."""
    xmin, ymin, xmax, ymax = kind.bounds
    p = points.agg(F.count(F.lit(1)), F.max(x) - F.min(x), F.max(y) - F.min(y)).first()
    widest = shapes.agg(F.max(F.greatest(xmax - xmin, ymax - ymin))).first()[0]
    if not p[0] or widest is None:
        return None
    widest, across = max(float(widest), 1e-9), max(float(p[1]), float(p[2]), 1e-9)
    size = 2.0 ** math.ceil(math.log2(max(across * math.sqrt(IN_A_CELL / p[0]), 1e-9)))
    size = max(min(size, 2.0 ** math.ceil(math.log2(widest))), 2.0 ** (math.ceil(math.log2(widest)) - DEEPEST))
    return size, max(0, math.ceil(math.log2(widest / size)))


def covering(shapes: DataFrame, kind: Kind, size: float, top: int, whole: bool) -> DataFrame:
    """shapes with _l, _cx, _cy, band: with whole the largest cells that are wholly in a band, else the smallest ones (level 0, band
    0) where it can't be told."""
    read, held = kind.read, kind.held  # without the columns, which can't be sent to tasks

    @F.arrow_udf("array<struct<l:int,x:bigint,y:bigint,band:int>>")
    def run(*columns: pa.Array) -> pa.Array:
        of, box = read(*columns[4:]), np.stack(floats(*columns[:4]))
        known_ = np.isfinite(box).all(0)
        low, high = (np.floor(np.where(known_, v, 0) / (size * 2.0**top)).astype(np.int64) for v in (box[:2], box[2:]))
        wide = np.where(known_, np.maximum(high - low + 1, 0), 0)
        i = np.repeat(np.arange(box.shape[1]), wide.prod(0))
        k = np.arange(len(i)) - np.repeat(np.cumsum(wide.prod(0)) - wide.prod(0), wide.prod(0))
        x, y = low[0, i] + k % np.maximum(wide[0, i], 1), low[1, i] + k // np.maximum(wide[0, i], 1)
        out = []
        for level in range(top, -1, -1):
            step = size * 2.0**level
            band = held(of, i, x * step, y * step, (x + 1) * step, (y + 1) * step)
            keep = band > 0 if whole else (band == 0) & (level == 0)
            out.append((i[keep], np.full(keep.sum(), level), x[keep], y[keep], band[keep]))
            rest = band == 0
            i, x, y = np.repeat(i[rest], 4), (x[rest, None] * 2 + [0, 0, 1, 1]).ravel(), (y[rest, None] * 2 + [0, 1, 0, 1]).ravel()
        i, *fields = (np.concatenate(v) for v in zip(*out, strict=True))
        order = np.argsort(i, kind="stable")
        values = pa.StructArray.from_arrays([pa.array(v[order], t) for v, t in zip(fields, (pa.int32(), pa.int64(), pa.int64(), pa.int32()), strict=True)], names=["l", "x", "y", "band"])
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.bincount(i, minlength=box.shape[1]))]), pa.int32()), values)

    found = run(*(v.cast("double") for v in kind.bounds), *kind.given)
    df = spread(shapes).select("*", F.explode(found).alias("_c"))
    return df.select(*shapes.columns, F.col("_c.l").alias("_l"), F.col("_c.x").alias("_cx"), F.col("_c.y").alias("_cy"), F.col("_c.band").alias("band"))


def placed(points: DataFrame, x: str, y: str, size: float) -> DataFrame:
    """points with their smallest cell."""
    return points.withColumn("_cx", F.floor(F.col(x) / size).cast("long")).withColumn("_cy", F.floor(F.col(y) / size).cast("long"))


def at_levels(points: DataFrame, top: int) -> DataFrame:
    """Placed points, one row for the cell of each level."""
    up = points.withColumn("_l", F.explode(F.array(*map(F.lit, range(top + 1)))))
    return up.withColumn("_cx", F.expr("shiftright(_cx, _l)")).withColumn("_cy", F.expr("shiftright(_cy, _l)"))


def known(points: DataFrame, x: str, y: str) -> DataFrame:
    return points.filter(F.col(x).isNotNull() & F.col(y).isNotNull())


def folded(points: DataFrame, shapes: DataFrame, kind: Kind, x: str, y: str, values: dict[str, tuple[str, Column]]) -> DataFrame:
    """Each distinct place (x, y) that a shape holds, with aggregates over all shapes around it. values: sum, min or max, and what
    of a shape, in its columns and `band`."""
    places = known(points, x, y).select(x, y).distinct()
    grid = grid_for(known(points, x, y), x, y, shapes, kind)
    if grid is None:
        empty = known(points, x, y).limit(0).crossJoin(shapes.withColumn("band", F.lit(1)).limit(0))
        return empty.groupBy(x, y).agg(*(MERGED[how](v).alias(n) for n, (how, v) in values.items()))
    size, top = grid
    cells = lambda whole: covering(shapes, kind, size, top, whole)
    merged = [MERGED[how](n).alias(n) for n, (how, _) in values.items()]
    inside = cells(True).groupBy(CELL).agg(*(MERGED[how](v).alias(n) for n, (how, v) in values.items()))
    at = placed(places, x, y, size)
    one = at_levels(at, top).join(inside.hint("merge"), CELL).select(x, y, *values)
    along = at.join(cells(False).drop("band", "_l").hint("merge"), ["_cx", "_cy"])
    two = along.withColumn("band", kind.at(F.col(x), F.col(y))).filter("band is not null").groupBy(x, y).agg(*(MERGED[how](v).alias(n) for n, (how, v) in values.items()))
    return one.groupBy(x, y).agg(*merged).unionByName(two).groupBy(x, y).agg(*merged)


def surely(points: DataFrame, shapes: DataFrame, kind: Kind, x: str, y: str) -> DataFrame:
    """Distinct places (x, y) in a cell that some shape holds wholly: no pair is looked at, and places beside outlines, which may be
    held too, are left out."""
    places = known(points, x, y).select(x, y).distinct()
    grid = grid_for(known(points, x, y), x, y, shapes, kind)
    if grid is None:
        return places.limit(0)
    size, top = grid
    inside = covering(shapes, kind, size, top, True).select(CELL).distinct()
    return at_levels(placed(places, x, y, size), top).join(inside.hint("merge"), CELL, "left_semi").select(x, y).distinct()


def pairs(points: DataFrame, shapes: DataFrame, kind: Kind, x: str, y: str) -> DataFrame:
    """Points beside each shape that holds them, with `band`; column names must differ."""
    grid = grid_for(known(points, x, y), x, y, shapes, kind)
    if grid is None:
        return points.limit(0).crossJoin(shapes.withColumn("band", F.lit(1)).limit(0))
    size, top = grid
    cells = lambda whole: covering(shapes, kind, size, top, whole)
    at = placed(spread(known(points, x, y)), x, y, size)
    one = at_levels(at, top).join(cells(True).hint("merge"), CELL).drop(*CELL)
    along = at.join(cells(False).drop("band", "_l").hint("merge"), ["_cx", "_cy"]).drop("_cx", "_cy")
    return one.unionByName(along.withColumn("band", kind.at(F.col(x), F.col(y))).filter("band is not null"))


def gathered(shapes: DataFrame, points: DataFrame, kind: Kind, key: str, x: str, y: str, values: dict[str, tuple[str, Column]]) -> DataFrame:
    """Each shape that holds a point, by its key, with aggregates over all points in it. values: sum, min or max, and what of a
    point, in its columns."""
    grid = grid_for(known(points, x, y), x, y, shapes, kind)
    all_ = [MERGED[how](v).alias(n) for n, (how, v) in values.items()]
    merged = [MERGED[how](n).alias(n) for n, (how, _) in values.items()]
    if grid is None:
        return shapes.limit(0).crossJoin(points.limit(0)).groupBy(key).agg(*all_)
    size, top = grid
    cells = lambda whole: covering(shapes, kind, size, top, whole)
    at = placed(known(points, x, y).groupBy(x, y).agg(*all_), x, y, size)
    levels = at_levels(at, top).groupBy(CELL).agg(*merged)
    one = cells(True).select(key, *CELL).join(levels.hint("merge"), CELL).select(key, *values)
    along = cells(False).drop("band", "_l").join(at.hint("merge"), ["_cx", "_cy"])
    two = along.filter(kind.at(F.col(x), F.col(y)).isNotNull()).select(key, *values)
    return one.unionByName(two).groupBy(key).agg(*merged)
