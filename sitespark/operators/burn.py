"""Polygons on rasters by scan lines: a polygon becomes runs (row, first, last) of pixels, which meet the pixels by row and block
of columns, so that a polygon costs its rows, and a pixel one row of a join for each polygon over it."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.overlay import RINGS, unpacked
from .shared import spread

RUNS = "array<struct<row:bigint,first:bigint,last:bigint>>"


def level_crossings(rings: list[np.ndarray], low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Where edges cross the middle of rows low .. high - 1: (row, x), ordered by both."""
    rows, xs = [], []
    for r in rings:
        (x0, y0), (x1, y1) = r[:-1].T, r[1:].T
        a, b = np.minimum(y0, y1), np.maximum(y0, y1)
        first = np.maximum(np.ceil(a - 0.5), low).astype(np.int64)  # a <= row + 0.5 < b
        n = np.maximum(np.minimum(np.ceil(b - 0.5), high).astype(np.int64) - first, 0)
        e = np.repeat(np.arange(len(n)), n)
        row = np.arange(len(e)) - np.repeat(np.cumsum(n) - n, n) + first[e]
        rows.append(row)
        xs.append(x0[e] + (row + 0.5 - y0[e]) * (x1[e] - x0[e]) / (y1[e] - y0[e]))
    if not rows:
        return np.empty(0, np.int64), np.empty(0)
    row, x = np.concatenate(rows), np.concatenate(xs)
    order = np.lexsort((x, row))
    return row[order], x[order]


def edge_spans(rings: list[np.ndarray], low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each edge and open row band that it passes through, the columns of open pixels it meets: (row, first, last)."""
    out = [[], [], []]
    for r in rings:
        (x0, y0), (x1, y1) = r[:-1].T, r[1:].T
        up = y0 > y1
        x0, y0, x1, y1 = np.where(up, x1, x0), np.where(up, y1, y0), np.where(up, x0, x1), np.where(up, y0, y1)
        level = y0 == y1
        first = np.floor(y0).astype(np.int64)
        last = np.where(level, np.where(y0 == np.floor(y0), first - 1, first), np.ceil(y1).astype(np.int64) - 1)
        first, last = np.maximum(first, low), np.minimum(last, high - 1)
        n = np.maximum(last - first + 1, 0)
        e = np.repeat(np.arange(len(n)), n)
        row = np.arange(len(e)) - np.repeat(np.cumsum(n) - n, n) + first[e]
        with np.errstate(divide="ignore", invalid="ignore"):  # the division comes last, so that whole results are exact
            a, b = (x0[e] + (y - y0[e]) * (x1[e] - x0[e]) / (y1[e] - y0[e]) for y in (np.maximum(y0[e], row), np.minimum(y1[e], row + 1)))
        a, b = np.where(level[e], x0[e], a), np.where(level[e], x1[e], b)
        a, b = np.minimum(a, b), np.maximum(a, b)
        out[0].append(row)
        out[1].append(np.floor(a).astype(np.int64))
        out[2].append(np.ceil(b).astype(np.int64) - 1)
    if not out[0]:
        return (np.empty(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in out)


def runs_of(rings: list[np.ndarray], rows: tuple[int, int], cols: tuple[int, int], touched: bool) -> np.ndarray:
    """(row, first, last) of the pixels that a polygon covers, disjoint and ordered, within the raster."""
    rings = [r for r in rings if len(r) > 3]
    if not rings:
        return np.empty((0, 3), np.int64)
    row, x = level_crossings(rings, *rows)
    row, x0, x1 = row[::2], x[::2], x[1::2]
    if touched:
        first, last = np.floor(x0).astype(np.int64), np.ceil(x1).astype(np.int64) - 1
        more = edge_spans(rings, *rows)
        row, first, last = np.concatenate([row, more[0]]), np.concatenate([first, more[1]]), np.concatenate([last, more[2]])
    else:  # the centre strictly inside
        first, last = np.floor(x0 - 0.5).astype(np.int64) + 1, np.ceil(x1 - 0.5).astype(np.int64) - 1
    first, last = np.maximum(first, cols[0]), np.minimum(last, cols[1] - 1)
    keep = first <= last
    row, first, last = row[keep], first[keep], last[keep]
    if not len(row):
        return np.empty((0, 3), np.int64)
    order = np.lexsort((first, row))
    row, first, last = row[order], first[order], last[order]
    wide = cols[1] - cols[0] + 2  # rows made far apart, so that one running maximum serves all
    reach = np.maximum.accumulate(row * wide + last - cols[0])
    new = np.concatenate([[True], (row * wide + first - cols[0])[1:] > reach[:-1] + 1])
    at = np.flatnonzero(new)
    return np.stack([row[at], first[at], np.maximum.reduceat(last, at)], 1)


def pixel_runs(rings: Column, rows: tuple[int, int], cols: tuple[int, int], touched: bool = False) -> Column:
    """Runs of a polygon in pixel units (x to the right, y downwards, pixel (r, c) being the square from (c, r) to (c + 1, r + 1)),
    filled by the even-odd rule. Pixels whose centre is strictly inside; with `touched` all whose open square the polygon meets."""

    @F.arrow_udf(RUNS)
    def run(column: pa.Array) -> pa.Array:
        found = [runs_of(r, rows, cols, touched) for r in unpacked(column)]
        flat = np.concatenate(found) if found else np.empty((0, 3), np.int64)
        values = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], names=["row", "first", "last"])
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(f) for f in found])]), pa.int32()), values)

    return run(rings.cast(RINGS))


def covered(pixels: DataFrame, shapes: DataFrame, rings: str, rows: tuple[int, int], cols: tuple[int, int], touched: bool = False, block: int = 64) -> DataFrame:
    """pixels (tile, row, col, ...) beside each shape over them; shapes with a `tile` column stay on their tile."""
    by = ["tile"] if "tile" in shapes.columns else []
    keep = [c for c in shapes.columns if c != rings]
    runs = spread(shapes).select(*keep, F.explode(pixel_runs(F.col(rings), rows, cols, touched)).alias("_r"))
    at = lambda c: F.floor(c / block).cast("long")
    runs = runs.withColumn("_b", F.explode(F.sequence(at(F.col("_r.first")), at(F.col("_r.last"))))).select(*keep, F.col("_r.row").alias("row"), "_b", F.col("_r.first").alias("_first"), F.col("_r.last").alias("_last"))
    placed = pixels.withColumn("row", F.col("row").cast("long")).withColumn("_b", at(F.col("col")))
    return placed.join(runs.hint("merge"), [*by, "row", "_b"]).filter(F.col("col").between(F.col("_first"), F.col("_last"))).drop("_b", "_first", "_last")


def zonal(pixels: DataFrame, shapes: DataFrame, zone: str, rings: str, rows: tuple[int, int], cols: tuple[int, int], value: str = "value", touched: bool = False) -> DataFrame:
    """Each zone with the count, mean, least and greatest of the values under it; null values don't count, and a zone without a
    value keeps a row with n 0."""
    under = covered(pixels.filter(F.col(value).isNotNull()).select("tile", "row", "col", F.col(value).alias("_v")), shapes, rings, rows, cols, touched)
    found = under.groupBy(zone).agg(F.count(F.lit(1)).alias("n"), F.avg("_v").alias("mean"), F.min("_v").alias("least"), F.max("_v").alias("most"))
    return shapes.drop(rings).join(found, zone, "left").withColumn("n", F.coalesce("n", F.lit(0)))


def burned(image: DataFrame, shapes: DataFrame, rings: str, rows: tuple[int, int], cols: tuple[int, int], touched: bool = False) -> DataFrame:
    """The image's pixels with `mask`, 1 where any shape covers the pixel."""
    keys = ["tile", "row", "col"]
    hit = covered(image.select(keys), shapes.select(*(["tile"] if "tile" in shapes.columns else []), rings), rings, rows, cols, touched).select(keys).distinct().withColumn("mask", F.lit(1))
    return image.join(hit, keys, "left").withColumn("mask", F.coalesce("mask", F.lit(0)))


__all__ = ["burned", "covered", "pixel_runs", "runs_of", "zonal"]
