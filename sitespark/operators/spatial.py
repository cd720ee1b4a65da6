"""Spatial joins as equi-joins on grid cells, with an exact predicate after them.

Points live in one cell; boxes and search discs are listed for the cells they cover. The cell size is the search radius
(or the usual size of a box), so a row is listed for a few cells. Joins on cells are plain equi-joins that shuffle: Catalyst's
size of a side whose rows were listed for cells is that of its file, so it would send many times that through the driver. AQE
splits cells that are crowded.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import checkpointed, spread


def cell(v: Column, size: float) -> Column:
    return F.floor(v / F.lit(size)).cast("long")


def cells(low: Column, high: Column, size: float) -> Column:
    return F.explode(F.sequence(cell(low, size), cell(high, size)))


def at_point(df: DataFrame, x: str, y: str, size: float) -> DataFrame:
    return df.withColumn("_cx", cell(F.col(x), size)).withColumn("_cy", cell(F.col(y), size))


def over_box(df: DataFrame, xmin: Column, ymin: Column, xmax: Column, ymax: Column, size: float) -> DataFrame:
    return df.withColumn("_cx", cells(xmin, xmax, size)).withColumn("_cy", cells(ymin, ymax, size))


def squared(left_x: str, left_y: str, right_x: str, right_y: str) -> Column:
    dx, dy = F.col(left_x) - F.col(right_x), F.col(left_y) - F.col(right_y)
    return dx * dx + dy * dy


def radius_pairs(left: DataFrame, right: DataFrame, radius: float, lx: str, ly: str, rx: str, ry: str) -> DataFrame:
    """All pairs of points at most `radius` apart, with `d2`, the squared distance. Column names must differ."""
    near = over_box(spread(right), F.col(rx) - radius, F.col(ry) - radius, F.col(rx) + radius, F.col(ry) + radius, radius)
    pairs = at_point(left, lx, ly, radius).join(near.hint("merge"), ["_cx", "_cy"]).withColumn("d2", squared(lx, ly, rx, ry))
    return pairs.filter(F.col("d2") <= radius * radius).drop("_cx", "_cy")


def spacing(points: DataFrame, x: str, y: str) -> float:
    """The usual distance between neighbours, were points spread evenly over their bounds."""
    n, wide, high = points.agg(F.count(F.lit(1)), F.max(x) - F.min(x), F.max(y) - F.min(y)).first()
    return max(float(wide or 0), float(high or 0)) / math.sqrt(n) if n else 0.0


def widening(places: DataFrame, x: str, y: str, first: float, radius: float, match: Callable[[DataFrame, float], DataFrame]) -> DataFrame:
    """What match(places, r) finds within r of each place (one row a place), r growing from first to radius; a place that has found
    something is done, as nothing nearer is beyond. So crowded places never list all that is within the radius."""
    rest, out, r = checkpointed(places, "places"), None, min(first, radius) if first > 0 else radius
    while True:
        found = checkpointed(match(rest, r), "found")
        out = found if out is None else out.unionByName(found)
        if r >= radius:
            return out
        rest = checkpointed(rest.join(found.select(x, y).hint("merge"), [x, y], "left_anti"), "places")
        if rest.isEmpty():
            return out
        r = min(2 * r, radius)


def nearest_within(left: DataFrame, right: DataFrame, key: str, right_key: str, radius: float, lx: str, ly: str, rx: str, ry: str, carry: list[str] = ()) -> DataFrame:
    """Each left row with its nearest right row at most `radius` away (ties to the lesser right key) and its columns, or nulls."""
    targets = right.filter(F.col(rx).isNotNull() & F.col(ry).isNotNull()).groupBy(rx, ry).agg(F.min(F.struct(right_key, *carry)).alias("_of"))
    places = left.filter(F.col(lx).isNotNull() & F.col(ly).isNotNull()).select(lx, ly).distinct()

    def match(rest: DataFrame, r: float) -> DataFrame:
        return radius_pairs(rest, targets, r, lx, ly, rx, ry).groupBy(lx, ly).agg(F.min(F.struct("d2", "_of")).alias("best"))

    best = widening(places, lx, ly, 1.5 * spacing(right, rx, ry), radius, match)
    return spread(left).join(best.hint("merge"), [lx, ly], "left").select(left.columns + [F.col("best.d2").alias("d2"), *[F.col(f"best._of.{c}").alias(c) for c in (right_key, *carry)]])


def quadtree(points: DataFrame, x: str, y: str, most: int, deepest: int) -> tuple[DataFrame, DataFrame, tuple[float, float, float]]:
    """Nodes (level, ix, iy, leaf) and points (level, ix, iy, ...) of a quadtree over distinct places, and its corner and width.

    A cell with more than `most` points is cut in four, down to level `deepest`. Each level is an aggregate of the points
    that are still in crowded cells, written before the next; most points rest after log4(points / most) levels.
    """
    box = points.agg(F.min(x), F.min(y), F.max(x), F.max(y)).first()
    west, south = float(box[0]), float(box[1])
    width = max(float(box[2]) - west, float(box[3]) - south, 1e-9) * (1 + 1e-9)
    rest, nodes, placed = checkpointed(points, "tree-points"), None, None
    for level in range(deepest + 1):
        step = width / (1 << level)
        at = rest.withColumn("ix", F.least(F.floor((F.col(x) - west) / step), F.lit((1 << level) - 1)).cast("long")).withColumn("iy", F.least(F.floor((F.col(y) - south) / step), F.lit((1 << level) - 1)).cast("long"))
        cells_ = checkpointed(at.groupBy("ix", "iy").agg(F.count(F.lit(1)).alias("n")).select(F.lit(level).alias("level"), "ix", "iy", ((F.col("n") <= most) | F.lit(level == deepest)).alias("leaf")), "tree-nodes")
        here = at.join(cells_.filter("leaf").select("level", "ix", "iy"), ["ix", "iy"]).select("level", "ix", "iy", *points.columns)
        nodes, placed = (cells_, here) if nodes is None else (nodes.unionByName(cells_), placed.unionByName(here))
        crowded = cells_.filter(~F.col("leaf"))
        if not crowded.limit(1).count():
            break
        rest = checkpointed(at.join(crowded.select("ix", "iy"), ["ix", "iy"], "left_semi").select(points.columns), "tree-points")
    return checkpointed(nodes, "tree"), checkpointed(placed, "tree-leaves"), (west, south, width)


def descended(rest: DataFrame, key: str, nodes: DataFrame, corner: tuple[float, float, float], lx: str, ly: str) -> DataFrame:
    """(key, lx, ly, level, ix, iy): the leaves that can hold the nearest point of each row, by going down the tree.

    A row keeps the nodes that are no farther than the nearest far corner of any, as a node holds a point at least; a round
    opens one level. Each round is written, so the plan doesn't grow, and rounds are as many as the tree has levels.
    """
    west, south, width = corner

    def bounds(df: DataFrame) -> DataFrame:
        step = F.lit(width) / F.pow(F.lit(2.0), F.col("level"))
        x0, y0 = F.lit(west) + F.col("ix") * step, F.lit(south) + F.col("iy") * step
        near = [F.greatest(F.lit(0.0), a - F.col(c), F.col(c) - a - step) for c, a in ((lx, x0), (ly, y0))]
        far = [F.greatest(F.abs(F.col(c) - a), F.abs(F.col(c) - a - step)) for c, a in ((lx, x0), (ly, y0))]
        # a little room on either side for rounding: what the bounds let through is measured exactly
        return df.withColumn("_low", (near[0] * near[0] + near[1] * near[1]) * (1 - 1e-9)).withColumn("_high", (far[0] * far[0] + far[1] * far[1]) * (1 + 1e-9))

    children = nodes.filter("level > 0").select((F.col("level") - 1).alias("level"), F.shiftright("ix", 1).alias("ix"), F.shiftright("iy", 1).alias("iy"), F.struct("level", "ix", "iy", "leaf").alias("child"))
    single = nodes.filter("level = 0").first()["leaf"]
    root = rest.select(key, lx, ly, F.lit(0).alias("level"), *(F.lit(0).cast("long").alias(c) for c in ("ix", "iy")), F.lit(single).alias("leaf"))
    front = checkpointed(bounds(root), "front")
    while front.filter(~F.col("leaf")).limit(1).count():
        opened = front.filter(~F.col("leaf")).select(key, lx, ly, "level", "ix", "iy").join(children, ["level", "ix", "iy"]).select(key, lx, ly, "child.*")
        both = front.filter("leaf").unionByName(bounds(opened))
        best = F.min("_high").over(Window.partitionBy(key))
        front = checkpointed(both.withColumn("_best", best).filter(F.col("_low") <= F.col("_best")).drop("_best"), "front")
    return front.select(key, lx, ly, "level", "ix", "iy")


def nearest(left: DataFrame, right: DataFrame, key: str, right_key: str, lx: str, ly: str, rx: str, ry: str, first: float, most: int = 64, deepest: int = 24) -> DataFrame:
    """Each left row with its nearest right row (ties to the lesser right key) and d2, the squared distance, however far it is.

    Rows with a neighbour within `first` are matched by an equi-join on cells. The others, often few, go down a quadtree of
    the right rows' places, whose leaves hold at most `most` of them (places that many rows share are one). Keys of left are unique.
    Rows without a place, and all rows where right has none, get nulls.
    """
    got = checkpointed(nearest_within(left, right, key, right_key, first, lx, ly, rx, ry), "near")
    rest = got.filter(F.col(right_key).isNull() & F.col(lx).isNotNull() & F.col(ly).isNotNull()).select(left.columns)
    places = right.filter(F.col(rx).isNotNull() & F.col(ry).isNotNull()).groupBy(F.col(rx).alias("_rx"), F.col(ry).alias("_ry")).agg(F.min(right_key).alias("_rk"))
    if not rest.limit(1).count() or not places.limit(1).count():
        return got
    nodes, leaves, corner = quadtree(places, "_rx", "_ry", most, deepest)
    pairs = descended(rest, key, nodes, corner, lx, ly).join(leaves, ["level", "ix", "iy"]).withColumn("d2", squared(lx, ly, "_rx", "_ry"))
    best = pairs.groupBy(key).agg(F.min(F.struct("d2", "_rk")).alias("_best"))
    out = got.join(best, key, "left")
    return out.select(*left.columns, F.coalesce("d2", F.col("_best.d2")).alias("d2"), F.coalesce(right_key, F.col("_best._rk")).alias(right_key))


def within_boxes(points: DataFrame, boxes: DataFrame, size: float, x: str, y: str, how: str = "inner", closed: bool = False) -> DataFrame:
    """Points with the boxes (columns xmin, ymin, xmax, ymax) that hold them; a left join keeps points without one.
    Points on a box's edge count only if closed."""
    inside = (F.col(x) >= F.col("xmin")) & (F.col(x) <= F.col("xmax")) & (F.col(y) >= F.col("ymin")) & (F.col(y) <= F.col("ymax"))
    if not closed:
        inside = (F.col(x) > F.col("xmin")) & (F.col(x) < F.col("xmax")) & (F.col(y) > F.col("ymin")) & (F.col(y) < F.col("ymax"))
    over = over_box(boxes, F.col("xmin"), F.col("ymin"), F.col("xmax"), F.col("ymax"), size).withColumnsRenamed({"_cx": "_bx", "_cy": "_by"})
    at = at_point(points, x, y, size)
    return at.join(over, (F.col("_cx") == F.col("_bx")) & (F.col("_cy") == F.col("_by")) & inside, how).drop("_cx", "_cy", "_bx", "_by")


def intersecting_boxes(left: DataFrame, right: DataFrame, size: float, prefix: str = "r_") -> DataFrame:
    """Pairs of boxes that meet, touching included; the right box's columns are prefixed. A pair is reported by the cell
    that holds the corner where its intersection begins, so no distinct is needed."""
    right = right.select([F.col(c).alias(prefix + c) for c in right.columns])
    a = over_box(spread(left), F.col("xmin"), F.col("ymin"), F.col("xmax"), F.col("ymax"), size)
    b = over_box(spread(right), F.col(f"{prefix}xmin"), F.col(f"{prefix}ymin"), F.col(f"{prefix}xmax"), F.col(f"{prefix}ymax"), size)
    pairs = a.join(b.hint("merge"), ["_cx", "_cy"])
    x, y = F.greatest("xmin", f"{prefix}xmin"), F.greatest("ymin", f"{prefix}ymin")
    meet = (x <= F.least("xmax", f"{prefix}xmax")) & (y <= F.least("ymax", f"{prefix}ymax"))
    return pairs.filter(meet & (F.col("_cx") == cell(x, size)) & (F.col("_cy") == cell(y, size))).drop("_cx", "_cy")


def self_pairs(points: DataFrame, key: str, radius: float, x: str, y: str) -> DataFrame:
    """Unordered pairs (a, b), a < b, at most `radius` apart."""
    a = points.select(F.col(key).alias("a"), F.col(x).alias("ax"), F.col(y).alias("ay"))
    b = points.select(F.col(key).alias("b"), F.col(x).alias("bx"), F.col(y).alias("by"))
    return radius_pairs(a, b, radius, "ax", "ay", "bx", "by").filter("a < b")


def without_neighbours(low: DataFrame, high: DataFrame, key: str, radius: float, lx: str, ly: str, rx: str, ry: str) -> DataFrame:
    """Rows of low with no row of high within the radius: low-priority points that high-priority ones make redundant go."""
    near = radius_pairs(low.select(key, lx, ly), high.select(rx, ry), radius, lx, ly, rx, ry).select(key)
    return low.join(near, key, "left_anti")


def fishnet(boxes: DataFrame, size: float, least_area: float = 0.0) -> DataFrame:
    """Boxes cut along a grid aligned to multiples of `size`: pieces with their cell (cx, cy) and area, small ones dropped."""
    over = over_box(boxes, F.col("xmin"), F.col("ymin"), F.col("xmax"), F.col("ymax"), size).withColumnsRenamed({"_cx": "cx", "_cy": "cy"})
    width = F.least(F.col("xmax"), (F.col("cx") + 1) * size) - F.greatest(F.col("xmin"), F.col("cx") * size)
    height = F.least(F.col("ymax"), (F.col("cy") + 1) * size) - F.greatest(F.col("ymin"), F.col("cy") * size)
    return over.withColumn("piece_area", width * height).filter((F.col("piece_area") > 0) & (F.col("piece_area") >= least_area))


def lattice(boxes: DataFrame, step: float, xmin: str, ymin: str, xmax: str, ymax: str) -> DataFrame:
    """Boxes beside the points (lon, lat) of a lattice aligned to multiples of step, one row a point, that cover each box."""
    over = lambda low, high: F.explode(F.sequence(F.floor(F.col(low) / F.lit(step)).cast("long"), F.ceil(F.col(high) / F.lit(step)).cast("long")))
    out = boxes.withColumn("_i", over(xmin, xmax)).withColumn("_j", over(ymin, ymax))
    return out.withColumn("lon", F.col("_i") * F.lit(step)).withColumn("lat", F.col("_j") * F.lit(step)).drop("_i", "_j")
