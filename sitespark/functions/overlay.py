"""Intersection, union and difference of polygons, areas, distances and simplification, on flat coordinates in Arrow batches.

A polygon is an array of rings (array<array<struct<x, y>>>) filled by the even-odd rule, so holes are rings inside others and
several parts are rings beside each other. Results are outlines: outer rings counter-clockwise, holes clockwise (functions.sweep).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import batches, sweep

RINGS = "array<array<struct<x:double,y:double>>>"
ARROW_RINGS = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))
OPERATIONS = {"intersection": np.logical_and, "union": np.logical_or, "difference": lambda a, b: a & np.logical_not(b)}


def overlay(a: list[np.ndarray], b: list[np.ndarray], operation: str) -> list[np.ndarray]:
    """Outlines of a and b combined; b may be empty."""
    return sweep.overlay(a, b, OPERATIONS[operation])


def rings_area(rings: list[np.ndarray]) -> float:
    """Of rings whose holes run the other way than what they are in."""
    total = 0.0
    for ring in rings:
        x, y = (ring - ring[:1]).T
        total += float((x[:-1] * y[1:] - x[1:] * y[:-1]).sum()) / 2
    return abs(total)


def ring_area(ring: np.ndarray) -> float:
    x, y = (ring - ring[:1]).T
    return abs(float((x[:-1] * y[1:] - x[1:] * y[:-1]).sum())) / 2


def unpacked(column: pa.Array) -> Iterator[list[np.ndarray]]:
    """The polygons of a column as coordinate arrays, cut from one flat array; null is empty."""
    rings = column.flatten()
    points = rings.flatten()
    flat = np.column_stack([points.field("x").to_numpy(zero_copy_only=False), points.field("y").to_numpy(zero_copy_only=False)]) if len(points) else np.empty((0, 2))
    sizes = np.diff(np.append(rings.offsets.to_numpy(), 0)[:-1]) if len(rings) else np.empty(0, int)
    ends = np.cumsum(sizes)
    counts = [0 if n is None else n for n in pa.compute.list_value_length(column).to_pylist()]
    at = 0
    for n in counts:
        yield [flat[ends[k] - sizes[k] : ends[k]] for k in range(at, at + n)]
        at += n


def packed(polygons: list[list[np.ndarray]]) -> pa.Array:
    """The opposite of unpacked, from flat arrays."""
    rings = [r for p in polygons for r in p]
    flat = np.concatenate(rings) if rings else np.empty((0, 2))
    points = pa.StructArray.from_arrays([pa.array(flat[:, 0], pa.float64()), pa.array(flat[:, 1], pa.float64())], names=["x", "y"])
    ends = lambda sizes: pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
    return pa.ListArray.from_arrays(ends([len(p) for p in polygons]), pa.ListArray.from_arrays(ends([len(r) for r in rings]), points))


def combined(a: Column, b: Column, operation: str) -> Column:
    """a combined with b: intersection, union or difference."""

    @F.arrow_udf(RINGS)
    def run(left: pa.Array, right: pa.Array) -> pa.Array:
        (found,), alone = batches.overlays(batches.read(left), batches.read(right), [OPERATIONS[operation]])
        return replaced(found, left, right, alone, lambda x, y: overlay(x, y, operation))

    return run(a.cast(RINGS), b.cast(RINGS))


def replaced(found: batches.Shapes, left: pa.Array, right: pa.Array, rows: np.ndarray, one: Callable[[list, list], list]) -> pa.Array:
    """found as a column, with what `one` makes of the marked rows."""
    column = batches.write(found)
    if not rows.any():
        return column
    marked = pa.array(np.flatnonzero(rows))
    made = packed([one(x, y) for x, y in zip(unpacked(left.take(marked)), unpacked(right.take(marked)), strict=True)])
    index = np.arange(len(rows))
    index[rows] = len(rows) + np.arange(len(marked))
    return pa.concat_arrays([column, made]).take(pa.array(index))


def difference_ladder(a: Column, b: Column, grids: tuple[float, ...] = (1.0, 5.0, 10.0)) -> Column:
    """a less b on a coarse grid: both snapped to the finest one that holds, then to coarser ones; a as it is where none does.

    A grid holds if the result can be told from its own areas: what is left and what is cut away must add up to a. The
    sweep has no failures of its own, so the first grid nearly always holds.
    """

    @F.arrow_udf(RINGS)
    def run(left: pa.Array, right: pa.Array) -> pa.Array:
        found, rest = first_rung(batches.read(left), batches.read(right), grids[0])
        return replaced(found, left, right, rest, lambda x, y: ladder(x, y, grids))

    return run(a.cast(RINGS), b.cast(RINGS))


def first_rung(a: batches.Shapes, b: batches.Shapes, grid: float) -> tuple[batches.Shapes, np.ndarray]:
    """The ladder's result of all rows on its finest grid, and the rows that don't hold there."""
    snapped = [s._replace(flat=np.round(s.flat / grid) * grid) for s in (a, b)]
    ((p,), one), ((q,), two) = (batches.overlays(s, batches.none(len(s.counts)), [OPERATIONS["union"]]) for s in snapped)
    (rest, cut), three = batches.overlays(p, q, [OPERATIONS["difference"], OPERATIONS["intersection"]])
    whole = batches.areas(p)
    holds = np.abs(batches.areas(rest) + batches.areas(cut) - whole) <= 1e-6 * np.maximum(1.0, whole)
    return rest, one | two | three | ~holds


def ladder(a: list[np.ndarray], b: list[np.ndarray], grids: tuple[float, ...]) -> list[np.ndarray]:
    for grid in grids:
        p, q = (overlay([np.round(r / grid) * grid for r in rings], [], "union") for rings in (a, b))
        rest = overlay(p, q, "difference")
        cut, whole = rings_area(overlay(p, q, "intersection")), rings_area(p)
        if abs(rings_area(rest) + cut - whole) <= 1e-6 * max(1.0, whole):
            return rest
    return a


def repaired(a: Column) -> Column:
    """The area that a polygon covers by the even-odd rule, whatever crosses what: a zero-width buffer's repair."""
    return combined(a, F.array().cast(RINGS), "union")


def total_area(a: Column) -> Column:
    """The area of outlines: holes run the other way than the rings they are in, and count off. Vertices are taken from each ring's
    first, as far from the origin products would lose digits."""
    from .geometry import segments

    def twice(r: Column) -> Column:
        x, y = r[0]["x"], r[0]["y"]
        return F.aggregate(segments(r), F.lit(0.0), lambda t, e: t + (e["a"]["x"] - x) * (e["b"]["y"] - y) - (e["b"]["x"] - x) * (e["a"]["y"] - y))

    return F.abs(F.aggregate(F.transform(a, twice), F.lit(0.0), lambda s, x: s + x)) / 2


def largest_part(a: Column) -> Column:
    from .geometry import area

    return F.element_at(F.array_sort(F.transform(a, lambda r: F.struct(area(r).alias("a"), r.alias("r")))), -1)["r"]


def regular_ring(x: Column, y: Column, radius: Column, per_quadrant: int = 8) -> Column:
    """A disc as a ring of 4 * per_quadrant vertices on its edge."""
    n = 4 * per_quadrant
    return F.transform(F.sequence(F.lit(0), F.lit(n)), lambda k: F.struct((x + radius * F.cos(k % n * F.lit(2 * np.pi / n))).alias("x"), (y + radius * F.sin(k % n * F.lit(2 * np.pi / n))).alias("y")))


def simplified_ring(ring: np.ndarray, tolerance: float) -> np.ndarray:
    """Douglas and Peucker's choice of vertices: none left out is further than the tolerance from the line that skips it."""
    keep = np.zeros(len(ring), bool)
    keep[[0, -1]] = True
    far = int(np.argmax(((ring - ring[0]) ** 2).sum(1))) if len(ring) else 0
    todo = [(0, far), (far, len(ring) - 1)]
    while todo:
        i, j = todo.pop()
        keep[[i, j]] = True
        if j - i < 2:
            continue
        d = ring[j] - ring[i]
        t = np.clip(((ring[i + 1 : j] - ring[i]) @ d) / max(float(d @ d), 1e-300), 0, 1)
        off = np.hypot(*(ring[i + 1 : j] - ring[i] - t[:, None] * d).T)
        k = int(np.argmax(off))
        if off[k] > tolerance:
            todo += [(i, i + 1 + k), (i + 1 + k, j)]
    return ring[keep]


def simplified(a: Column, tolerance: float) -> Column:
    """Rings with fewer vertices; those that would lose their area stay as they are."""

    @F.arrow_udf(RINGS)
    def run(column: pa.Array) -> pa.Array:
        out = []
        for rings in unpacked(column):
            found = [simplified_ring(r, tolerance) for r in rings]
            out.append([s if len(s) > 3 and ring_area(s) > 0 else r for s, r in zip(found, rings, strict=True)])
        return packed(out)

    return run(a.cast(RINGS))


def _inside(rings: list[np.ndarray], point: np.ndarray) -> bool:
    e = sweep.segments_of(rings)
    up = (e[:, 1] <= point[1]) != (e[:, 3] <= point[1])
    x = e[up, 0] + (point[1] - e[up, 1]) * (e[up, 2] - e[up, 0]) / (e[up, 3] - e[up, 1])
    return bool((x > point[0]).sum() % 2)


def gap_of(a: list[np.ndarray], b: list[np.ndarray]) -> float | None:
    """Distance between two shapes, 0 where they touch; closed rings are areas, open ones lines."""
    a, b = [r for r in a if len(r)], [r for r in b if len(r)]
    if not a or not b:
        return None
    areas = [[r for r in x if len(r) > 3 and (r[0] == r[-1]).all()] for x in (a, b)]
    if (areas[0] and any(_inside(areas[0], r[0]) for r in b)) or (areas[1] and any(_inside(areas[1], r[0]) for r in a)):
        return 0.0
    ea, eb = (np.concatenate([np.hstack([r[:-1], r[1:]]) if len(r) > 1 else np.hstack([r, r]) for r in x]) for x in (a, b))
    return sweep.edge_distance(ea, eb)


def shape_distance(a: Column, b: Column) -> Column:
    @F.arrow_udf("double")
    def run(left: pa.Array, right: pa.Array) -> pa.Array:
        return pa.array([gap_of(x, y) for x, y in zip(unpacked(left), unpacked(right), strict=True)], pa.float64())

    return run(a.cast(RINGS), b.cast(RINGS))


def flat_edges(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all polygons at once: edges, how many each has, which are of closed rings, the first points of rings, how many each has."""
    rings = column.flatten()
    points = rings.flatten()
    flat = np.column_stack([points.field(c).to_numpy(zero_copy_only=False) for c in "xy"]) if len(points) else np.empty((0, 2))
    sizes = pa.compute.fill_null(pa.compute.list_value_length(rings), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    counts = pa.compute.fill_null(pa.compute.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    owner, start = np.repeat(np.arange(len(counts)), counts)[sizes > 0], (np.cumsum(sizes) - sizes)[sizes > 0]
    sizes = sizes[sizes > 0]
    n = np.maximum(sizes - 1, 1)  # a ring of one point is an edge from it to itself
    ring = np.repeat(np.arange(len(n)), n)
    a = start[ring] + np.arange(len(ring)) - np.repeat(np.cumsum(n) - n, n)
    b = np.where(sizes[ring] > 1, a + 1, a)
    closed = (sizes > 3) & (flat[start] == flat[start + sizes - 1]).all(1)
    per = lambda rows: np.bincount(rows, minlength=len(counts)).astype(np.int64)
    return np.hstack([flat[a], flat[b]]), per(owner[ring]), closed[ring], flat[start], per(owner)


Edges = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _product_of(m: np.ndarray, i: np.ndarray, n: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """_product for pairs (i, j) of rows whose things are listed once: pair, and indices into all things and all others."""
    pair = np.repeat(np.arange(len(i)), m[i] * n[j])
    k = np.arange(len(pair)) - np.repeat(np.cumsum(m[i] * n[j]) - m[i] * n[j], m[i] * n[j])
    return pair, (np.cumsum(m) - m)[i][pair] + k // n[j][pair], (np.cumsum(n) - n)[j][pair] + k % n[j][pair]


def _edges_meet(left: Edges, right: Edges, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    pair, p, q = _product_of(left[1], i, right[1], j)
    a, b = left[0], right[0]
    low = lambda s, k: np.minimum(s[:, k], s[:, k + 2])
    high = lambda s, k: np.maximum(s[:, k], s[:, k + 2])
    near = np.ones(len(pair), bool)
    for k in range(2):
        near &= (low(a, k)[p] <= high(b, k)[q]) & (low(b, k)[q] <= high(a, k)[p])
    pair, a, b = pair[near], a[p[near]].T, b[q[near]].T
    turn = lambda s, x, y: np.sign((s[2] - s[0]) * (y - s[1]) - (s[3] - s[1]) * (x - s[0]))
    found = np.zeros(len(i), bool)
    found[pair[(turn(a, b[0], b[1]) * turn(a, b[2], b[3]) <= 0) & (turn(b, a[0], a[1]) * turn(b, a[2], a[3]) <= 0)]] = True
    return found


def _starts_inside(of: Edges, other: Edges, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether the first point of a ring of i is inside j."""
    points, per = of[3], of[4]
    pair, at, e = _product_of(per, i, other[1], j)
    (x, y), (x0, y0, x1, y1) = points[at].T, other[0][e].T
    with np.errstate(divide="ignore", invalid="ignore"):
        crosses = other[2][e] & ((y0 <= y) != (y1 <= y)) & (x0 + (y - y0) * (x1 - x0) / (y1 - y0) > x)
    start = np.cumsum(per[i]) - per[i]  # one number for each point of each pair
    number = start[pair] + at - (np.cumsum(per) - per)[i][pair]
    inside = np.bincount(number[crosses], minlength=per[i].sum()) % 2 == 1
    found = np.zeros(len(i), bool)
    found[np.repeat(np.arange(len(i)), per[i])[inside]] = True
    return found


#: Edges of a convex shape at most, for its half-planes to be looked at one by one.
SIDES = 16


def half_planes(shapes: Edges) -> tuple[np.ndarray, list[tuple[np.ndarray, ...]]]:
    """Which shapes are one convex ring of few edges; and their edges by number: dx, dy, dx * y - dy * x of a point on the edge, the
    inside on the left, and the shape's greatest coordinate. Shapes with fewer edges have their last one again."""
    edges, n, closed, _, per = shapes
    first = np.cumsum(n) - n
    most = int(n[n <= SIDES].max(initial=0))
    ok = (per == 1) & (n > 2) & (n <= SIDES)
    if not most or not ok.any():
        return np.zeros(len(n), bool), []
    at = np.where(ok[:, None], first[:, None] + np.minimum(np.arange(most), n[:, None] - 1), 0)
    e = edges[at]
    ok &= closed[at[:, 0]]
    d = e[..., 2:] - e[..., :2]
    real = np.arange(most) < n[:, None]
    after = np.where(np.arange(most) + 1 < n[:, None], np.arange(most) + 1, 0)
    f = np.take_along_axis(d, after[..., None].repeat(2, 2), 1)
    turn = np.where(real, d[..., 0] * f[..., 1] - d[..., 1] * f[..., 0], 0)
    around = np.where(real, np.arctan2(turn, (d * f).sum(2)), 0).sum(1)
    ok &= ((turn >= 0).all(1) | (turn <= 0).all(1)) & (np.abs(np.abs(around) - 2 * np.pi) < 0.1)
    d = d * np.where(around < 0, -1, 1)[:, None, None]
    far = np.abs(e).max((1, 2))
    return ok, [(d[:, k, 0], d[:, k, 1], d[:, k, 0] * e[:, k, 1] - d[:, k, 1] * e[:, k, 0], far) for k in range(most)]


def told(boxes: list[np.ndarray], planes: tuple[np.ndarray, list[tuple[np.ndarray, ...]]], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Of boxes (xmin, ymin, xmax, ymax) and convex shapes: 1 where all of box
    i is inside shape j, -1 where it is beyond one of its edges, else 0."""
    ok, sides = planes
    out = np.zeros(len(i), np.int8)
    rest = np.flatnonzero(ok[j]) if sides else np.empty(0, np.int64)
    i, j = i[rest], j[rest]
    w, s, e, n = (v[i] for v in boxes)
    inside, beyond = np.ones(len(i), bool), np.zeros(len(i), bool)
    reach = np.maximum.reduce([np.abs(v) for v in (w, s, e, n)])
    for dx, dy, base, far in sides:
        dx, dy, base = dx[j], dy[j], base[j]
        room = (np.abs(dx) + np.abs(dy)) * np.maximum(far[j], reach) * 1e-14  # what rounding needs
        up, right = dx > 0, dy > 0
        beyond |= dx * np.where(up, n, s) - dy * np.where(right, w, e) - base < -room
        inside &= dx * np.where(up, s, n) - dy * np.where(right, e, w) - base > room
    out[rest] = inside.astype(np.int8) - beyond
    return out


def pairs_meet(left: Edges, right: Edges, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs of shapes i, j intersect, touching included: edges that have a point in common, or a ring's first point inside
    the other shape. That of most pairs is told by the points."""
    found = np.zeros(len(i), bool)
    for test in (lambda m, n: _starts_inside(left, right, m, n), lambda m, n: _starts_inside(right, left, n, m), lambda m, n: _edges_meet(left, right, m, n)):
        rest = np.flatnonzero(~found)
        found[rest] = test(i[rest], j[rest])
    return found


def meet(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Which shapes intersect, row by row."""
    rows = np.arange(len(left))
    return pairs_meet(flat_edges(left), flat_edges(right), rows, rows)


def pairs_inside(points: np.ndarray, shapes: Edges, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which points i are strictly inside shapes j, by the even-odd rule over closed rings."""
    pair, at, e = _product_of(np.ones(len(points), np.int64), i, shapes[1], j)
    (x, y), (x0, y0, x1, y1) = points[at].T, shapes[0][e].T
    side = (x1 - x0) * (y - y0) - (y1 - y0) * (x - x0)
    crosses = ((y0 > y) != (y1 > y)) & ((side > 0) == (y1 > y0)) & (side != 0)
    on = (side == 0) & (np.minimum(x0, x1) <= x) & (x <= np.maximum(x0, x1)) & (np.minimum(y0, y1) <= y) & (y <= np.maximum(y0, y1))
    hit = np.bincount(pair[crosses], minlength=len(i)) % 2 == 1
    hit[pair[on]] = False
    return hit


#: Pairs of edges compared at once; shapes with more between them are measured by blocks instead.
AT_ONCE = 1 << 21


def shapes_meet(a: Column, b: Column) -> Column:
    """Whether shapes intersect, touching included; closed rings are areas, open ones lines."""

    @F.arrow_udf("boolean")
    def run(left: pa.Array, right: pa.Array) -> pa.Array:
        work = flat_edges(left)[1] * flat_edges(right)[1]
        found, at, large = np.zeros(len(left), bool), 0, work > AT_ONCE
        part = np.cumsum(np.where(large, 0, work)) // AT_ONCE
        while at < len(left):
            to = int(np.searchsorted(part, part[at], "right"))
            rows = np.arange(at, to)[~large[at:to]]
            if len(rows):
                found[rows] = meet(left.take(pa.array(rows)), right.take(pa.array(rows)))
            at = to
        for k in np.flatnonzero(large):
            found[k] = gap_of(next(unpacked(left.slice(k, 1))), next(unpacked(right.slice(k, 1)))) == 0
        return pa.array(found)

    return run(a.cast(RINGS), b.cast(RINGS))
