"""Outlines: regions of pixels as rings of vertices, and rings from chains of edges that lie in many cells.

A cell of the raster traces the edges of its own pixels; where an outline leaves the cell its chain ends and names the edge with
which the neighbouring cell's chain starts. Chains are joined to rings by pointer jumping, whose rounds grow with the logarithm of the
number of cells that an outline crosses, not with its length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.overlay import RINGS, packed
from .shared import checkpointed
from .shared import spread as dealt

#: Columns that an edge number has room for; rows get the rest of 61 bits.
WIDE = 1 << 28
#: The sides of a pixel in the order of a walk around it with the pixel on the left (y upwards): what lies across, where the side
#: starts, and where it ends, as (row, col) from the pixel's upper left corner.
SIDES = (((1, 0), (1, 0), (1, 1)), ((0, 1), (1, 1), (0, 1)), ((-1, 0), (0, 1), (0, 0)), ((0, -1), (0, 0), (1, 0)))
POINTS = "array<struct<x:double,y:double>>"


def next_edges(labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of a grid of labels (0: none) with a rim of one pixel: which sides of the inner pixels are edges, and each one's next.

    Both are [row, col, side]. From the end of a side the walk turns left around the same pixel if that side is an edge, else goes on
    along the pixel there, else turns right to the pixel across; so pixels that only touch at a corner are kept apart. next is
    ((row * columns) + col) * 4 + side in the grid with its rim.
    """
    high, wide = labels.shape
    inner = labels[1:-1, 1:-1]
    across = [labels[1 + dr : high - 1 + dr, 1 + dc : wide - 1 + dc] for (dr, dc), _, _ in SIDES]
    edge = np.stack([(inner > 0) & (inner != a) for a in across], -1)
    rows, cols = np.meshgrid(np.arange(1, high - 1), np.arange(1, wide - 1), indexing="ij")
    number = lambda r, c, side: (r * wide + c) * 4 + side
    follow = np.empty(edge.shape, np.int64)
    for k in range(4):
        after, before = (k + 1) % 4, (k - 1) % 4
        (dr, dc), (er, ec) = SIDES[after][0], SIDES[k][0]
        ahead = labels[1 + dr : high - 1 + dr, 1 + dc : wide - 1 + dc]
        beyond = labels[1 + dr + er : high - 1 + dr + er, 1 + dc + ec : wide - 1 + dc + ec]
        straight, right = number(rows + dr, cols + dc, k), number(rows + dr + er, cols + dc + ec, before)
        follow[..., k] = np.where(edge[..., after], number(rows, cols, after), np.where((ahead == inner) & (beyond == inner), right, straight))
    return edge, follow


def chains_of(labels: np.ndarray, row: int, col: int) -> Iterator[tuple[int, int, int | None, list[tuple[float, float]]]]:
    """(label, first edge, edge that follows in another cell or None for a ring, corners as (col, row)) of a cell at (row, col)."""
    high, wide = labels.shape
    edge, follow = next_edges(labels)
    places = np.argwhere(edge)
    if not len(places):
        return
    own = ((places[:, 0] + 1) * wide + places[:, 1] + 1) * 4 + places[:, 2]
    after = follow[tuple(places.T)]
    where = np.full(high * wide * 4, -1, np.int64)
    where[own] = np.arange(len(own))
    to = where[after]  # -1: the next edge is a pixel's of the rim
    start = np.ones(len(own), bool)
    start[to[to >= 0]] = False
    side, label = places[:, 2].tolist(), labels[places[:, 0] + 1, places[:, 1] + 1].tolist()
    at = np.array([s[1] for s in SIDES])[places[:, 2]] + places[:, :2]
    xs, ys = (at[:, 1] + col).tolist(), (at[:, 0] + row).tolist()
    abroad = lambda e: ((e // 4 // wide - 1 + row) * WIDE + e // 4 % wide - 1 + col) * 4 + e % 4
    to_list, seen = to.tolist(), np.zeros(len(own), bool)
    for head in [*np.flatnonzero(start).tolist(), *range(len(own))]:
        if seen[head]:
            continue
        corners, k, turn = [], head, -1
        while k >= 0 and not seen[k]:
            seen[k] = True
            if side[k] != turn:
                corners.append((float(xs[k]), float(ys[k])))
                turn = side[k]
            last, k = k, to_list[k]
        closed = to_list[last] >= 0
        if closed and len(corners) > 1 and side[last] == side[head]:
            corners = corners[1:]  # the walk began in the middle of a straight stretch
        yield label[head], int(abroad(own[head])), None if closed else int(abroad(after[last])), corners


def stitched(chains: DataFrame, keys: list[str]) -> DataFrame:
    """Rings from chains: (keys, id, next, points), next the id of the chain that goes on, null for a ring by itself. Chains' ids
    are unique within keys. Returns (keys, ring, points) with points in order, not closed.

    Each round doubles how far a chain sees: first for the least id of its ring, then for its distance from there. Every
    round is written to the shared folder; only ids travel, points are gathered once, at the end.
    """
    whole = chains.filter("next is null").select(*keys, F.col("id").alias("ring"), "points")
    open_ = chains.filter("next is not null")
    links = checkpointed(open_.select(*keys, "id", F.col("next").alias("to"), F.col("id").alias("least")), "links")
    while True:
        there = links.select(*keys, F.col("id").alias("to"), F.col("to").alias("to2"), F.col("least").alias("least2"))
        new = checkpointed(links.join(there, [*keys, "to"]).select(*keys, "id", F.col("to2").alias("to"), F.least("least", "least2").alias("least"), (F.col("least2") < F.col("least")).alias("moved")), "links")
        moved = new.filter("moved").limit(1).count()
        links = new.drop("moved")
        if not moved:
            break
    ring = links.select(*keys, "id", F.col("least").alias("ring"))
    steps = checkpointed(open_.select(*keys, "id", "next").join(ring, [*keys, "id"]).select(*keys, "ring", "id", F.when(F.col("next") != F.col("ring"), F.col("next")).alias("to"), F.lit(0).cast("long").alias("left")), "steps")
    steps = steps.withColumn("left", F.when(F.col("to").isNull(), 0).otherwise(1).cast("long"))
    while steps.filter("to is not null").limit(1).count():
        there = steps.select(*keys, F.col("id").alias("to"), F.col("to").alias("to2"), F.col("left").alias("left2"))
        steps = checkpointed(steps.join(there, [*keys, "to"], "left").select(*keys, "ring", "id", F.col("to2").alias("to"), (F.col("left") + F.coalesce("left2", F.lit(0))).alias("left")), "steps")
    placed = open_.select(*keys, "id", "points").join(steps.select(*keys, "id", "ring", "left"), [*keys, "id"])
    rings = placed.groupBy(*keys, "ring").agg(F.array_sort(F.collect_list(F.struct((-F.col("left")).alias("at"), "points"))).alias("all"))
    return whole.unionByName(rings.select(*keys, "ring", F.flatten(F.col("all.points")).alias("points")))


def without_straights(points: Column, tolerance: float = 0.0) -> Column:
    """An open ring without the vertices that lie on the line through their neighbours."""
    n = F.size(points)
    at = lambda i: F.get(points, i.cast("int"))

    def bends(p: Column, i: Column) -> Column:
        a, b = at((i + n - 1) % n), at((i + 1) % n)
        ux, uy, vx, vy = p["x"] - a["x"], p["y"] - a["y"], b["x"] - p["x"], b["y"] - p["y"]
        return F.abs(ux * vy - uy * vx) > tolerance * (F.hypot(ux, uy) * F.hypot(vx, vy))

    return F.filter(points, bends)


def closed(points: Column) -> Column:
    return F.concat(points, F.slice(points, 1, 1))


def region_outlines(labelled: DataFrame, label: str = "region", cell: int = 256, west: float = 0.0, north: float = 0.0, dx: float = 1.0, dy: float = 1.0) -> DataFrame:
    """(tile, label, rings) for labelled pixels (tile, row, col, label): the outlines of all pixels with the label.

    Rings have their pixels on the left: outer ones run counter-clockwise, holes clockwise, and all are closed; the largest comes first.
    Pixels that touch at a corner only don't join. A four-connected region has one outer ring. Labels are positive numbers
    (null and others are no region). Cells of `cell` x `cell` pixels are traced by themselves, with a rim of the pixels around.
    """
    from .raster import EIGHT

    pixels = labelled.filter(F.col(label) > 0).select("tile", F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), F.col(label).cast("long").alias("label"))
    of = lambda v: F.floor(v / cell).cast("long")
    cells = F.array_distinct(F.array(*[F.struct(of(F.col("row") + r).alias("cy"), of(F.col("col") + c).alias("cx")) for r, c in EIGHT]))
    spread = pixels.withColumn("_c", F.explode(cells)).select("tile", "_c.cy", "_c.cx", "row", "col", "label")

    def trace(key: tuple, table: pa.Table) -> pa.Table:
        tile, cy, cx = (k.as_py() for k in key)
        r, c, v = (table.column(n).to_numpy() for n in ("row", "col", "label"))
        names, codes = np.unique(v, return_inverse=True)
        grid = np.zeros((cell + 2, cell + 2), np.int64)
        grid[r - cy * cell + 1, c - cx * cell + 1] = codes + 1
        found = list(chains_of(grid, cy * cell, cx * cell))
        points = [[{"x": west + x * dx, "y": north - y * dy} for x, y in f[3]] for f in found]
        return pa.table([pa.array([tile] * len(found), table.schema.field("tile").type), pa.array([int(names[f[0] - 1]) for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.int64()), pa.array(points, pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))], names=["tile", "label", "id", "next", "points"])

    kind = labelled.schema["tile"].dataType.simpleString()
    chains = checkpointed(dealt(spread, "tile", "cy", "cx").groupBy("tile", "cy", "cx").applyInArrow(trace, f"tile {kind}, label long, id long, next long, points {POINTS}"), "chains")
    from ..functions.geometry import signed_area

    rings = stitched(chains, ["tile", "label"]).select("tile", "label", closed(without_straights(F.col("points"))).alias("r"))
    ordered = rings.groupBy("tile", "label").agg(F.array_sort(F.collect_list(F.struct((-signed_area(F.col("r"))).alias("a"), "r"))).alias("all"))
    return ordered.select("tile", F.col("label").alias(label), F.col("all.r").alias("rings"))


def region_pieces(labelled: DataFrame, label: str = "region", cell: int = 256, west: float = 0.0, north: float = 0.0, dx: float = 1.0, dy: float = 1.0) -> DataFrame:
    """(tile, label, rings): as region_outlines, but of a region's pixels in each cell by themselves, closed along the cell's border.
    A region that spans the raster is many rows of one cell's size, and is never gathered."""
    pixels = labelled.filter(F.col(label) > 0).select("tile", F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), F.col(label).cast("long").alias("label"))
    of = lambda v: F.floor(v / cell).cast("long")
    placed = pixels.withColumn("cy", of(F.col("row"))).withColumn("cx", of(F.col("col")))

    def trace(key: tuple, table: pa.Table) -> pa.Table:
        tile, cy, cx = (k.as_py() for k in key)
        r, c, v = (table.column(n).to_numpy() for n in ("row", "col", "label"))
        names, codes = np.unique(v, return_inverse=True)
        grid = np.zeros((cell + 2, cell + 2), np.int64)
        grid[r - cy * cell + 1, c - cx * cell + 1] = codes + 1
        rings: dict[int, list[np.ndarray]] = {}
        for name, _, _, corners in chains_of(grid, cy * cell, cx * cell):
            ring = np.array([*corners, corners[0]]) * [dx, -dy] + [west, north]
            rings.setdefault(int(names[name - 1]), []).append(ring)
        return pa.table([pa.array([tile] * len(rings), table.schema.field("tile").type), pa.array(list(rings), pa.int64()), packed(list(rings.values()))], names=["tile", "label", "rings"])

    kind = labelled.schema["tile"].dataType.simpleString()
    found = dealt(placed, "tile", "cy", "cx").groupBy("tile", "cy", "cx").applyInArrow(trace, f"tile {kind}, label long, rings {RINGS}")
    return found.withColumnRenamed("label", label)


def polygons(labelled: DataFrame, group: str = "cls", **grid) -> DataFrame:
    """(tile, group, region, rings): each four-connected region of the pixels of one group (labelled: tile, row, col, group)."""
    from .raster import FOUR, components

    parts = components(labelled.select("tile", "row", "col", group), FOUR, group).withColumnRenamed("component", "region")
    named = checkpointed(parts.withColumn("_label", F.col("region") + 1), "regions")  # numbers from 1, each a region's first pixel
    of = named.groupBy("tile", "_label").agg(F.first(group).alias(group), F.count(F.lit(1)).alias("pixel_count"))
    found = region_outlines(named, "_label", **grid)
    return found.join(of, ["tile", "_label"]).select("tile", group, (F.col("_label") - 1).alias("region"), "pixel_count", "rings")


def candidates(codes: DataFrame, groups: dict[str, list[int]], least_pixels: int, least_acres: float, pixel: float = 30.0, cell: int = 256, west: float = 0.0, north: float = 0.0) -> DataFrame:
    """Polygons of land cover: cover, tile, region, rings, area_m2, pixel_count, area_acres, centre, for pixels (tile, row, col, value).

    For each group of codes: opening and closing, eight-connected components of least_pixels and more, their four-connected
    outlines, and of these the ones of least_acres and more. What is dropped by size is decided by counts before anything is drawn.
    All groups go through each round together, a group's pixels being tiles of their own.
    """
    from ..functions.geometry import ACRES_PER_M2_ROUNDED, shape_centroid, signed_area
    from .raster import clean, components

    wanted = F.array(*[F.struct(F.lit(str(k)).alias("cover"), F.coalesce(F.col("value").isin(*codes_), F.lit(False)).alias("on")) for k, codes_ in enumerate(groups.values())])
    listed = codes.withColumn("_of", F.explode(wanted)).select(F.concat_ws(":", "_of.cover", F.col("tile").cast("string")).alias("tile"), "row", "col", F.col("_of.on").alias("_on"))
    on = clean(listed.filter("_on"), listed).withColumn("cls", F.lit(0))
    parts = checkpointed(components(on), "parts")
    sizes = parts.groupBy("tile", "component").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_pixels)
    kept = parts.join(sizes.select("tile", "component"), ["tile", "component"], "left_semi")
    found = polygons(kept, "cls", cell=cell, west=west, north=north, dx=pixel, dy=pixel)
    area = F.aggregate(F.transform("rings", signed_area), F.lit(0.0), lambda a, v: a + v)
    found = found.withColumn("area_m2", area).withColumn("area_acres", F.col("area_m2") * ACRES_PER_M2_ROUNDED).filter(F.col("area_acres") >= least_acres)
    of = F.split("tile", ":", 2)
    return found.select(F.get(F.array(*map(F.lit, groups)), F.get(of, 0).cast("int")).alias("cover"), F.get(of, 1).cast(codes.schema["tile"].dataType).alias("tile"), "region", "rings", "area_m2", F.bround(F.col("area_m2") / (pixel * pixel), 0).cast("long").alias("pixel_count"), "area_acres", shape_centroid(F.col("rings")).alias("centre"))
