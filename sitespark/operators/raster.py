"""Rasters as tall tables (tile, row, col, value): joins with neighbours instead of arrays, so a raster of any size is a scan
and a shuffle by tile. Pixels beyond a tile's edge count as background, which also cuts components at tile borders."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import checkpointed, spread

EIGHT = [(dr, dc) for dr in (-1, 0, 1) for dc in (-1, 0, 1)]
FOUR = [(0, 0), (-1, 0), (1, 0), (0, -1), (0, 1)]
KEYS = ["tile", "row", "col"]


def in_cells(pixels: DataFrame, cell: int, rim: int) -> DataFrame:
    """Pixels with the cells (_cy, _cx) that they lie in or within `rim` pixels of: rows near a border are listed again."""
    at = lambda c: F.explode(F.sequence(*(F.floor((F.col(c) + by) / cell).cast("long") for by in (-rim, rim))))
    return pixels.withColumn("_cy", at("row")).withColumn("_cx", at("col"))


def _morphed(pixels: DataFrame, image: DataFrame, steps: str, keys: list[str], cell: int) -> DataFrame:
    """Set pixels after steps of erosion (e) and dilation (d) by 3 x 3: one shuffle to cells with a rim as wide as there are steps,
    then bits of whole cells at a time."""
    rim = len(steps)
    tile, row, col = keys
    both = pixels.select(*keys, F.lit(True).alias("_set")).unionByName(image.select(*keys, F.lit(False).alias("_set")))
    both = both.withColumnsRenamed({tile: "tile", row: "row", col: "col"})

    def run(key: tuple, table: pa.Table) -> pa.Table:
        cy, cx = key[1].as_py() * cell - rim, key[2].as_py() * cell - rim
        size = cell + 2 * rim
        seen, on = np.zeros((size + 2, size + 2), bool), np.zeros((size + 2, size + 2), bool)
        r, c, s = (table.column(n).to_numpy() for n in ("row", "col", "_set"))
        seen[r - cy + 1, c - cx + 1] = True
        on[r[s] - cy + 1, c[s] - cx + 1] = True
        for step in steps:
            around = [on[1 + i : size + 1 + i, 1 + j : size + 1 + j] for i, j in EIGHT]
            inner = np.logical_and.reduce(around) if step == "e" else np.logical_or.reduce(around) & seen[1:-1, 1:-1]
            on = np.pad(inner, 1)
        r, c = np.nonzero(on[rim + 1 : rim + 1 + cell, rim + 1 : rim + 1 + cell])
        return pa.table([pa.array([key[0].as_py()] * len(r), table.schema.field("tile").type), pa.array(r + cy + rim, pa.int64()), pa.array(c + cx + rim, pa.int64())], names=["tile", "row", "col"])

    kind = both.schema["tile"].dataType.simpleString()
    placed = in_cells(both.withColumn("row", F.col("row").cast("long")).withColumn("col", F.col("col").cast("long")), cell, rim)
    out = spread(placed, "tile", "_cy", "_cx").groupBy("tile", "_cy", "_cx").applyInArrow(run, f"tile {kind}, row long, col long")
    return out.withColumnsRenamed({"tile": tile, "row": row, "col": col})


def dilate(pixels: DataFrame, image: DataFrame, keys: list[str] = KEYS, cell: int = 256) -> DataFrame:
    """Set pixels and their eight neighbours, as far as the image (all its pixels, set or not) reaches."""
    return _morphed(pixels, image, "d", keys, cell)


def erode(pixels: DataFrame, keys: list[str] = KEYS, cell: int = 256) -> DataFrame:
    """Pixels whose eight neighbours are all set; what is outside the image isn't."""
    return _morphed(pixels, pixels, "e", keys, cell)


def clean(pixels: DataFrame, image: DataFrame, keys: list[str] = KEYS, cell: int = 256) -> DataFrame:
    """Opening, then closing, both 3 x 3: specks go, pinholes fill. Outside the image is 0, so pixels at its border go."""
    return _morphed(pixels, image, "edde", keys, cell)


def rasterize(image: DataFrame, boxes: DataFrame, size: int = 64) -> DataFrame:
    """The image's pixels with `mask`, 1 where the pixel's centre is inside any box (xmin, ymin, xmax, ymax in pixels)."""
    from .spatial import within_boxes

    centred = image.select(*KEYS, (F.col("col") + 0.5).alias("px"), (F.col("row") + 0.5).alias("py"))
    hit = within_boxes(centred, boxes, size, "px", "py").select(KEYS).distinct().withColumn("mask", F.lit(1))
    return image.join(hit, KEYS, "left").withColumn("mask", F.coalesce("mask", F.lit(0)))


def reclass(code: Column, groups: list[tuple[str, Column]]) -> Column:
    """The first group that a class code belongs to, or null."""
    out = F.lit(None).cast("string")
    for name, cond in reversed(groups):
        out = F.when(cond, name).otherwise(out)
    return out


def polygonize(labelled: DataFrame, group: str = "cls") -> DataFrame:
    """One row for each 4-connected region of each component: tile, group, component, region, pixel_count. An 8-connected
    component can give several."""
    parts = components(labelled.withColumn("whole", F.concat_ws(":", F.col(group), F.col("component"))), FOUR, "whole").withColumnRenamed("component", "region")
    found = parts.groupBy("tile", "whole", "region").agg(F.count(F.lit(1)).alias("pixel_count"))
    whole = F.split("whole", ":")
    return found.select("tile", whole[0].alias(group), whole[1].cast("long").alias("component"), "region", "pixel_count")


def cell_labels(codes: np.ndarray, diagonal: bool) -> np.ndarray:
    """Connected pixels of equal code (0: none) in an array: each one's label is the least index of its component, -1 for none."""
    high, wide = codes.shape
    labels = np.where(codes > 0, np.arange(high * wide).reshape(high, wide), -1)
    pairs = []
    for dr, dc in ((0, 1), (1, 0), (1, 1), (1, -1))[: 4 if diagonal else 2]:
        a = (slice(0, high - dr), slice(max(0, -dc), wide - max(0, dc)))
        b = (slice(dr, high), slice(max(0, dc), wide - max(0, -dc)))
        same = (codes[a] > 0) & (codes[a] == codes[b])
        pairs.append(np.stack([labels[a][same], labels[b][same]]))
    x, y = np.concatenate(pairs, 1)
    of = np.arange(high * wide)
    while len(x):
        p, q = of[x], of[y]
        np.minimum.at(of, np.maximum(p, q), np.minimum(p, q))
        while (of[of] != of).any():
            of = of[of]
        apart = of[x] != of[y]
        x, y = x[apart], y[apart]
    return np.where(labels >= 0, of[labels], -1)


def components(pixels: DataFrame, steps: list[tuple[int, int]] = EIGHT, group: str = "cls", width: int = 1 << 20, cell: int = 256) -> DataFrame:
    """pixels with `component`, the least (row * width + col) that a pixel reaches within its tile and group.

    A cell labels its own pixels at once; then only labels that meet across a border between cells take part in rounds of
    least labels and pointer jumping, each written, whose number grows with the logarithm of the cells that a component spans.
    """
    diagonal = len(steps) > 5
    reach = EIGHT if diagonal else FOUR
    placed = in_cells(pixels.select("tile", F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), group), cell, 1)
    kinds = {c: pixels.schema[c].dataType.simpleString() for c in ("tile", group)}

    def label(key: tuple, table: pa.Table) -> pa.Table:
        """Rows of the cell's pixels with their labels, and rows (label, number of a pixel across the border) of links."""
        top, left = key[1].as_py() * cell - 1, key[2].as_py() * cell - 1
        r, c = table.column("row").to_numpy(), table.column("col").to_numpy()
        names = table.column(group).combine_chunks().dictionary_encode()
        grid = np.zeros((cell + 2, cell + 2), np.int64)
        kind = np.asarray(names.indices.fill_null(len(names.dictionary))) + 1
        grid[r - top, c - left] = kind
        inner = np.zeros_like(grid)
        inner[1:-1, 1:-1] = grid[1:-1, 1:-1]
        found = cell_labels(inner, diagonal)
        number = lambda index: (index // (cell + 2) + top) * width + index % (cell + 2) + left
        y, x = np.nonzero(found >= 0)
        low, across = [], []
        for dr, dc in reach:  # pixels of the rim beside the cell's own
            ny, nx = y + dr, x + dc
            out = ((ny == 0) | (ny == cell + 1) | (nx == 0) | (nx == cell + 1)) & (grid[ny, nx] == grid[y, x])
            low.append(found[y[out], x[out]])
            across.append((ny[out] + top) * width + nx[out] + left)
        link = np.unique(np.stack([np.concatenate(low), np.concatenate(across)]), axis=1) if low else np.empty((2, 0), np.int64)
        rim = (y == 1) | (y == cell) | (x == 1) | (x == cell)
        n, m = len(y), link.shape[1]
        values = pa.concat_arrays([names.dictionary, pa.nulls(1, names.dictionary.type)])
        code = np.concatenate([grid[y, x], inner.ravel()[link[0]]]) - 1
        return pa.table([pa.array([key[0].as_py()] * (n + m), table.schema.field("tile").type), values.take(pa.array(code)), pa.array(np.concatenate([y + top, np.zeros(m, np.int64)])), pa.array(np.concatenate([x + left, np.zeros(m, np.int64)])), pa.array(number(np.concatenate([found[y, x], link[0]]))), pa.array(np.concatenate([np.zeros(n, np.int64), link[1]]), mask=np.arange(n + m) < n), pa.array(np.concatenate([rim, np.zeros(m, bool)]))], names=["tile", group, "row", "col", "label", "beside", "rim"])

    out = checkpointed(spread(placed, "tile", "_cy", "_cx").groupBy("tile", "_cy", "_cx").applyInArrow(label, f"tile {kinds['tile']}, {group} {kinds[group]}, row long, col long, label long, beside long, rim boolean"), "cells")
    own = out.filter("beside is null")
    rims = own.filter("rim").select("tile", (F.col("row") * width + F.col("col")).alias("beside"), F.col("label").alias("other"))
    links = out.filter("beside is not null").select("tile", "label", "beside").join(rims, ["tile", "beside"]).select("tile", F.col("label").alias("x"), F.col("other").alias("y")).distinct()  # both sides tell of each
    links = checkpointed(links, "links")
    labels = links.select("tile", "x", F.col("x").alias("component")).distinct()
    while True:
        of = labels.select("tile", F.col("x").alias("y"), F.col("component").alias("c"))
        near = links.join(of, ["tile", "y"]).groupBy("tile", "x").agg(F.min("c").alias("near"))
        new = labels.join(near, ["tile", "x"]).withColumn("to", F.least("component", "near"))
        jump = labels.select("tile", F.col("x").alias("to"), F.col("component").alias("next"))
        new = checkpointed(new.join(jump, ["tile", "to"]).select("tile", "x", F.least("to", "next").alias("new"), "component"), "labels")
        labels = new.select("tile", "x", F.col("new").alias("component"))
        if not new.filter("new != component").limit(1).count():
            break
    final = labels.withColumnRenamed("x", "label")
    return own.join(final, ["tile", "label"], "left").select("tile", group, "row", "col", F.coalesce("component", "label").alias("component"))


def component_stats(labelled: DataFrame, group: str = "cls", pixel_area: float = 900.0, least: int = 1) -> DataFrame:
    """Size, area and centre of each component of `least` pixels or more."""
    out = labelled.groupBy("tile", group, "component").agg(F.count(F.lit(1)).alias("pixel_count"), F.sum("row").alias("_r"), F.sum("col").alias("_c"))
    out = out.filter(F.col("pixel_count") >= least)
    return out.select("tile", group, "component", "pixel_count", (F.col("pixel_count") * F.lit(pixel_area)).alias("area_m2"), F.round(F.col("_r") / F.col("pixel_count"), 6).alias("mid_row"), F.round(F.col("_c") / F.col("pixel_count"), 6).alias("mid_col"))


def degree_steps(dx: float, dy: float, centre_lat: float) -> tuple[float, float]:
    """Pixel sizes in metres of a raster in degrees, at the latitude of its centre, by 111 km a degree."""
    return dx * 111_000.0 * math.cos(math.radians(centre_lat)), dy * 111_000.0


def slope_percent(dem: DataFrame, dx: float, dy: float) -> DataFrame:
    """Gradient of `value` in percent: central differences, one-sided at edges; a null neighbour gives null."""
    from pyspark.sql import Window

    def gradient(across: str, along: str, step: float):
        w = Window.partitionBy("tile", across).orderBy(along)
        before, after = F.lag("value").over(w), F.lead("value").over(w)
        first, last = F.lag(F.lit(1)).over(w).isNull(), F.lead(F.lit(1)).over(w).isNull()
        return F.when(first, (after - F.col("value")) / step).when(last, (F.col("value") - before) / step).otherwise((after - before) / (2 * step))

    return dem.withColumn("_gx", gradient("row", "col", dx)).withColumn("_gy", gradient("col", "row", dy)).withColumn("slope", F.sqrt(F.col("_gx") * F.col("_gx") + F.col("_gy") * F.col("_gy")) * 100).drop("_gx", "_gy")


def zonal(pixels: DataFrame, boxes: DataFrame, zone: str, size: int = 64, value: str = "value") -> DataFrame:
    """Count, mean and greatest value of the pixels whose centre is in each box (columns xmin, ymin, xmax, ymax in pixel units,
    of the box's `tile` if it has one, else of any); boxes without a pixel keep a row with n 0."""
    from .spatial import within_boxes

    by_tile = "tile" in boxes.columns
    boxes = boxes.withColumnRenamed("tile", "box_tile") if by_tile else boxes
    centred = pixels.filter(F.col(value).isNotNull()).select("tile", (F.col("col") + 0.5).alias("px"), (F.col("row") + 0.5).alias("py"), F.col(value).alias("v"))
    inside = within_boxes(centred, boxes, size, "px", "py")
    found = (inside.filter("tile = box_tile") if by_tile else inside).groupBy(zone).agg(F.count(F.lit(1)).alias("n"), F.avg("v").alias("mean"), F.max("v").alias("most"))
    out = boxes.join(found, zone, "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return out.withColumnRenamed("box_tile", "tile") if by_tile else out


def sampled_slope(samples: DataFrame, dx: float, dy: float, limit: float = 8.0) -> DataFrame:
    """Slope of each parcel from a lattice of heights: tile (the parcel), row, col, value and `inside`, whether the sample is
    in the parcel's polygon; average, 70th percentile and steepest of those inside, or of all where none is. Parcels whose
    70th percentile is over the limit are disqualified; no sample with a slope gives nulls."""
    s = slope_percent(samples, dx, dy).filter(F.col("slope").isNotNull())
    own = F.when(F.col("inside"), F.col("slope"))
    out = s.groupBy("tile").agg(F.count(own).alias("n_inside"), *[f(c).alias(f"{n}{k}") for k, c in (("", own), ("_all", F.col("slope"))) for n, f in (("avg", F.avg), ("p70", lambda v: F.percentile(v, 0.7)), ("most", F.max))])
    pick = lambda n: F.when(F.col("n_inside") > 0, F.col(n)).otherwise(F.col(f"{n}_all"))
    return out.select("tile", "n_inside", *[pick(n).alias(n) for n in ("avg", "p70", "most")], (pick("p70") > limit).alias("disqualified"))
