"""Joins and aggregates on true shapes: an equi-join on grid cells finds who may meet, an exact predicate decides.

Shapes are arrays of rings, lines arrays of open ones. A shape is listed for the cells of its bounds, so cells should be about
as large as shapes usually are; a pair that meets in several cells is kept in the first of them only, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import geometry, sweep
from ..functions.overlay import AT_ONCE, RINGS, flat_edges, gap_of, half_planes, overlay, packed, pairs_inside, pairs_meet, told, total_area, unpacked
from . import covers, dissolve, spatial
from .shared import checkpointed, spread


def _at(v: Column, size: float) -> Column:
    return F.floor(v / F.lit(size)).cast("long")


def listed(df: DataFrame, rings: str, size: float, margin: float = 0.0) -> DataFrame:
    """df with cx, cy for each cell that the bounds, widened by a margin, meet; lx, ly is the first of them."""
    b = geometry.bounds(F.flatten(rings))
    df = df.withColumn("lx", _at(b["xmin"] - margin, size)).withColumn("ly", _at(b["ymin"] - margin, size))
    df = df.withColumn("cx", F.explode(F.sequence("lx", _at(b["xmax"] + margin, size))))
    return df.withColumn("cy", F.explode(F.sequence("ly", _at(b["ymax"] + margin, size))))


#: Rows of the left and the right of a cell that are compared together, and pairs tested at once.
ROWS, TESTED = (2048, 512), 1 << 17
#: Cells of its bounds over which a polygon counts as large, and is met by cells along its outline.
LARGE = 64


def _paired(left: DataFrame, right: DataFrame, columns: list[str] | None, find: Callable[[pa.Table, pa.Table], Iterator[tuple[np.ndarray, np.ndarray]]], carried: list[str]) -> DataFrame:
    """Pairs of rows of a cell (cx, cy), as `find` lists them by their places, in both sides' columns less `carried`. A cell with many
    rows is dealt over blocks, so that no task holds more of it than ROWS; only cells with rows on both sides are kept."""
    count = lambda df, n, most: df.groupBy("cx", "cy").agg(F.ceil(F.count(F.lit(1)) / most).alias(n))
    cells = checkpointed(count(left, "_nl", ROWS[0]).join(count(right, "_nr", ROWS[1]).hint("merge"), ["cx", "cy"]), "met")

    def dealt(df: DataFrame, own: str, others: str, n: str, m: str) -> DataFrame:
        # any number of a row will do, as long as it is one
        df = df.withColumn("_id", F.monotonically_increasing_id()).join(cells.hint("merge"), ["cx", "cy"])
        df = df.withColumn(own, F.pmod(F.xxhash64("_id"), F.col(n))).withColumn(others, F.explode(F.sequence(F.lit(0).cast("long"), F.col(m) - 1)))
        return spread(df.drop("_id", "_nl", "_nr"), "cx", "cy", "_i", "_j").groupBy("cx", "cy", "_i", "_j")

    fields = [(f, k) for k, df in enumerate((left, right)) for f in df.schema.fields if f.name not in (*carried, "cx", "cy") and (columns is None or f.name in columns)]

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        i, j = (np.concatenate(v) for v in zip((np.empty(0, np.int64),) * 2, *(find(a, b) if len(a) and len(b) else ()), strict=True))
        at = [pa.array(i), pa.array(j)]
        return pa.table([(a, b)[k].column(f.name).take(at[k]) for f, k in fields], names=[f.name for f, _ in fields])

    return dealt(left, "_i", "_j", "_nl", "_nr").cogroup(dealt(right, "_j", "_i", "_nr", "_nl")).applyInArrow(run, StructType([f for f, _ in fields]))


def _near(a: list[np.ndarray], b: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of boxes (xmin, ymin, xmax, ymax) that meet, some at a time."""
    step = max(1, (1 << 20) // max(1, len(b[0])))
    for k in range(0, len(a[0]), step):
        w, s, e, n = (v[k : k + step, None] for v in a)
        i, j = np.nonzero((w <= b[2]) & (b[0] <= e) & (s <= b[3]) & (b[1] <= n))
        yield i + k, j


def _some(i: np.ndarray, j: np.ndarray, work: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs some at a time, by what each costs."""
    part = np.cumsum(work) // TESTED
    for p, q in zip(*(np.searchsorted(part, np.unique(part), side) for side in ("left", "right")), strict=True):
        yield i[p:q], j[p:q]


def _numbers(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [table.column(n).to_numpy() for n in names]


def _shapes(table: pa.Table, name: str) -> pa.Array:
    return table.column(name).combine_chunks()


def points_in(points: DataFrame, shapes: DataFrame, x: str, y: str, rings: str, size: float, how: str = "inner", columns: list[str] | None = None) -> DataFrame:
    """Points joined to the shapes they are strictly inside of, by the even-odd rule over all rings. Cells are of the given size;
    shapes of many cells meet points by a quadtree (operators.covers). columns: the ones wanted, by default all."""
    b = geometry.bounds(F.flatten(rings))
    wide = lambda low, high: _at(b[high], size) - _at(b[low], size) + 1
    is_large = F.coalesce(wide("xmin", "xmax") * wide("ymin", "ymax") > LARGE, F.lit(False))
    wanted = [c for c in (*points.columns, *shapes.columns) if columns is None or c in columns]

    def find(p: pa.Table, s: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        of, at = flat_edges(_shapes(s, "_rings")), np.column_stack(_numbers(p, "_x", "_y"))
        planes = half_planes(of)
        for i, j in _near([at[:, 0], at[:, 1]] * 2, _numbers(s, "_xmin", "_ymin", "_xmax", "_ymax")):
            known = told([at[:, 0], at[:, 1]] * 2, planes, i, j)
            yield i[known > 0], j[known > 0]
            i, j = i[known == 0], j[known == 0]
            for m, n in _some(i, j, of[1][j]):
                hit = pairs_inside(at, of, m, n)
                yield m[hit], n[hit]

    at = spread(covers.known(points, x, y)).withColumn("_x", F.col(x).cast("double")).withColumn("_y", F.col(y).cast("double")).withColumn("cx", _at(F.col(x), size)).withColumn("cy", _at(F.col(y), size))
    small = listed(spread(shapes.filter(~is_large)).withColumn("_b", b), rings, size).drop("lx", "ly").withColumn("_rings", F.col(rings).cast(RINGS))
    small = small.select("*", *(F.col(f"_b.{c}").alias(f"_{c}") for c in _BOX)).drop("_b", *(c for c in shapes.columns if c not in wanted))
    found = _paired(at, small, wanted, find, ["_x", "_y", "_rings", *(f"_{c}" for c in _BOX)])
    large = shapes.filter(is_large)
    if large.limit(1).count():
        found = found.unionByName(covers.pairs(points, large, covers.polygons(rings), x, y).select(*found.columns))
    if how == "inner":
        return found
    return found.unionByName(points.join(found.select(x, y).distinct().hint("merge"), [x, y], "left_anti"), allowMissingColumns=True)


_BOX = ("xmin", "ymin", "xmax", "ymax")


def meeting(left: DataFrame, right: DataFrame, left_rings: str, right_rings: str, size: float, columns: list[str] | None = None) -> DataFrame:
    """Pairs of shapes that intersect, touching included. Column names must differ. columns: the ones wanted, by default all."""
    wanted = [c for c in (*left.columns, *right.columns) if columns is None or c in columns]
    carried = ["lx", "ly", "_rings", *(f"_{c}" for c in _BOX)]

    def side(df: DataFrame, rings: str) -> DataFrame:
        all_ = listed(spread(df.withColumn("_b", geometry.bounds(F.flatten(rings)))), rings, size).withColumn("_rings", F.col(rings).cast(RINGS))
        return all_.select("*", *(F.col(f"_b.{c}").alias(f"_{c}") for c in _BOX)).drop("_b", *(c for c in df.columns if c not in wanted))

    def find(a: pa.Table, b: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        columns_ = [_shapes(t, "_rings") for t in (a, b)]
        p, q = map(flat_edges, columns_)
        (ax, ay), (bx, by) = (_numbers(t, "lx", "ly") for t in (a, b))
        cx, cy = a.column("cx")[0].as_py(), a.column("cy")[0].as_py()
        boxes, planes = [_numbers(t, *(f"_{c}" for c in _BOX)) for t in (a, b)], half_planes(q)
        for i, j in _near(*boxes):
            first = (np.maximum(ax[i], bx[j]) == cx) & (np.maximum(ay[i], by[j]) == cy)
            i, j = i[first], j[first]
            known = told(boxes[0], planes, i, j)
            yield i[known > 0], j[known > 0]
            i, j = i[known == 0], j[known == 0]
            work = p[1][i] * q[1][j]
            for m, n in _some(i[work <= AT_ONCE], j[work <= AT_ONCE], work[work <= AT_ONCE]):
                hit = pairs_meet(p, q, m, n)
                yield m[hit], n[hit]
            for m, n in zip(i[work > AT_ONCE], j[work > AT_ONCE], strict=True):
                if gap_of(*(next(unpacked(c.slice(int(k), 1))) for c, k in zip(columns_, (m, n), strict=True))) == 0:
                    yield np.array([m]), np.array([n])

    return _paired(side(left, left_rings), side(right, right_rings), wanted, find, carried)


def nearest_shape(points: DataFrame, shapes: DataFrame, key: str, shape_key: str, x: str, y: str, rings: str, radius: float, carry: list[str] = (), is_area: bool = True) -> DataFrame:
    """Each point with its nearest shape at most `radius` away (0 inside an area), ties to the lesser key, and its columns. Edges meet
    places by cells as wide as the search, which grows from the usual distance between places."""
    places = covers.known(points, x, y).select(x, y).distinct()
    edges = spread(shapes).select(shape_key, *carry, F.explode(F.flatten(F.transform(rings, geometry.segments))).alias("_s"))
    edges = edges.select(shape_key, *carry, *(F.col(f"_s.{e}.{c}").alias(f"_{e}{c}") for e in "ab" for c in "xy"))
    ax, ay, bx, by = (F.col(c) for c in ("_ax", "_ay", "_bx", "_by"))
    distance = geometry.point_segment_distance(F.col(x), F.col(y), {"a": {"x": ax, "y": ay}, "b": {"x": bx, "y": by}})
    best = F.min(F.struct("distance", shape_key, *carry)).alias("best")

    def match(rest: DataFrame, r: float) -> DataFrame:
        near = edges.withColumn("cx", F.explode(F.sequence(_at(F.least(ax, bx) - r, r), _at(F.greatest(ax, bx) + r, r))))
        # the heights of the edge over the column, widened by r: what is within r of a point in the column lies between
        low, high = ((F.when(ax == bx, by if last else ay).otherwise(ay + (by - ay) * F.least(F.lit(1.0), F.greatest(F.lit(0.0), (F.col("cx") * r + last * r + (r if last else -r) - ax) / (bx - ax))))) for last in (0, 1))
        room = r * (1 + 1e-9) + F.greatest(F.abs(ay), F.abs(by)) * 1e-12
        near = near.withColumn("_low", F.least(low, high) - room).withColumn("_high", F.greatest(low, high) + room)
        near = near.withColumn("cy", F.explode(F.sequence(_at(F.col("_low"), r), _at(F.col("_high"), r)))).drop("_low", "_high")
        at = rest.withColumn("cx", _at(F.col(x), r)).withColumn("cy", _at(F.col(y), r))
        return at.join(near.hint("merge"), ["cx", "cy"]).withColumn("distance", distance).filter(F.col("distance") <= r).groupBy(x, y).agg(best)

    found = spatial.widening(places, x, y, spatial.spacing(places, x, y), radius, match)
    if is_area:
        inside = covers.folded(places, shapes, covers.polygons(rings), x, y, {"best": ("min", F.struct(F.lit(0.0).alias("distance"), shape_key, *carry))})
        found = found.unionByName(inside).groupBy(x, y).agg(F.min("best").alias("best"))
    return spread(points).join(found.hint("merge"), [x, y], "left").select(*points.columns, F.col("best.distance").alias("distance"), *[F.col(f"best.{c}").alias(c) for c in (shape_key, *carry)])


def inside_else_nearest(points: DataFrame, shapes: DataFrame, key: str, shape_key: str, x: str, y: str, rings: str, size: float, radius: float, weight: str) -> DataFrame:
    """The containing shape of greatest weight, at distance 0; for points in none the nearest within the radius."""
    inside = covers.folded(points, shapes, covers.polygons(rings), x, y, {"in": ("min", F.struct((-F.col(weight)).alias("w"), shape_key))})
    both = checkpointed(spread(points).join(inside.hint("merge"), [x, y], "left").select(*points.columns, "in"), "inside")
    found = both.filter(F.col("in").isNotNull()).select(*points.columns, F.lit(True).alias("inside"), F.col(f"in.{shape_key}").alias(shape_key), F.lit(0.0).alias("distance"))
    out = nearest_shape(both.filter(F.col("in").isNull()).select(*points.columns), shapes, key, shape_key, x, y, rings, radius)
    return found.unionByName(out.select(*points.columns, F.lit(False).alias("inside"), shape_key, "distance"))


#: Shapes united by one sweep.
TOGETHER = 64


def dissolved_area(shapes: DataFrame, key: str, rings: str, size: float) -> DataFrame:
    """The area that each key's polygons cover together, and the sum of their areas: polygons are cut into grid cells, united within
    the cell some at a time, and the cells' areas are added, so that no task holds a whole group. Equal shapes of a key are cut once."""
    grid = dissolve.common_grid(size, (shapes, rings))
    once = checkpointed(spread(dissolve.named(shapes, key, rings)).groupBy("key", "rings").agg(F.count(F.lit(1)).alias("n")), "once")

    @F.arrow_udf(RINGS)
    def clean(column: pa.Array) -> pa.Array:
        """Outlines; a convex ring is one as it is."""
        return packed([r if len(r) == 1 and sweep.is_convex(r[0]) else overlay(r, [], "union") for r in unpacked(column)])

    cells = dissolve.cut(spread(once).select("key", clean("rings").alias("rings")), "key", "rings", size)

    def run(table: pa.Table) -> pa.Table:
        parts = sorted(unpacked(table.column("rings").combine_chunks()), key=lambda r: (*r[0].min(0), *r[0].max(0)))
        while len(parts) > TOGETHER:
            edges = [sweep.united(parts[i : i + TOGETHER], grid) for i in range(0, len(parts), TOGETHER)]
            parts = [[r for c in sweep.traced(e) if len(r := sweep.straightened(np.array(c), grid)) > 3] for e in edges]
        x0, y0, x1, y1 = (sweep.united(parts, grid) - np.tile(parts[0][0][0], 2)).T if parts[0] else np.zeros((4, 0))
        return pa.table({"key": table.column("key").slice(0, 1), "united": [float((x0 * y1 - x1 * y0).sum()) / 2]})

    kind = once.schema["key"].dataType.simpleString()
    united = spread(cells, "key", "cx", "cy").groupBy("key", "cx", "cy").applyInArrow(run, f"key {kind}, united double").groupBy("key").agg(F.sum("united").alias("united"))
    sums = once.groupBy("key").agg(F.sum(F.col("n") * total_area(F.col("rings"))).alias("summed"))
    return sums.join(united, "key", "left").select(F.col("key.of").alias(key), "summed", "united")


def subdivide(shapes: DataFrame, key: str, rings: str, size: float, least: float, pixel: float = 900.0) -> DataFrame:
    """Shapes cut along an aligned grid: pieces of `least` area or more with an id, their parent, area and pixels."""
    from ..functions.overlay import combined

    cells = spread(listed(spread(shapes), rings, size).drop("lx", "ly"))
    frame = F.array(geometry.box_ring(F.col("cx") * size, F.col("cy") * size, (F.col("cx") + 1) * size, (F.col("cy") + 1) * size))
    pieces = cells.withColumn("piece", combined(F.col(rings), frame, "intersection")).withColumn("area", total_area(F.col("piece"))).filter(F.col("area") >= least)
    name = F.substring(F.sha2(F.concat_ws("|", F.col(key).cast("string"), F.col("cx"), F.col("cy")), 256), 1, 16)
    return pieces.select(name.alias("piece_id"), F.col(key).alias("parent_id"), "cx", "cy", "piece", "area", F.bround(F.col("area") / pixel, 0).cast("long").alias("pixel_count"))
