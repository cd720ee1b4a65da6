"""Shapes with several parts: which ring is whose hole, explosion into parts, polygons of collections, a point inside.

Rings are filled by the even-odd rule, so a ring inside an odd number of others is a hole, of the smallest that holds it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .overlay import ARROW_RINGS, RINGS, packed, unpacked

PARTS = f"array<{RINGS}>"


def twice_area(ring: np.ndarray) -> float:
    """Positive where the ring runs counter-clockwise."""
    x, y = (ring - ring[0]).T
    return float((x[:-1] * y[1:] - x[1:] * y[:-1]).sum())


def holds(ring: np.ndarray, point: np.ndarray) -> bool:
    """Even-odd, for a point that is not on the ring."""
    (x0, y0), (x1, y1) = ring[:-1].T, ring[1:].T
    up = (y0 > point[1]) != (y1 > point[1])
    x = x0[up] + (point[1] - y0[up]) * (x1[up] - x0[up]) / (y1[up] - y0[up])
    return bool((x > point[0]).sum() % 2)


def scan_point(rings: list[np.ndarray]) -> tuple[float, float] | None:
    """A point inside: the middle of the longest stretch inside, on a level half-way between the two vertex levels around the
    middle of the bounds. null without area."""
    rings = [r for r in rings if len(r) > 3]
    if not rings:
        return None
    ys = np.unique(np.concatenate([r[:, 1] for r in rings]))
    if len(ys) < 2:
        return None
    middle = (ys[0] + ys[-1]) / 2
    k = int(np.clip(np.searchsorted(ys, middle), 1, len(ys) - 1))
    y = (ys[k - 1] + ys[k]) / 2
    xs = []
    for r in rings:
        (x0, y0), (x1, y1) = r[:-1].T, r[1:].T
        up = (y0 > y) != (y1 > y)
        xs.append(x0[up] + (y - y0[up]) * (x1[up] - x0[up]) / (y1[up] - y0[up]))
    xs = np.sort(np.concatenate(xs))
    wide = xs[1::2] - xs[::2]
    i = int(np.argmax(wide)) if len(wide) else 0
    return (float((xs[2 * i] + xs[2 * i + 1]) / 2), float(y)) if len(wide) and wide[i] > 0 else None


def split(rings: list[np.ndarray]) -> list[list[np.ndarray]]:
    """Parts of an outer ring, counter-clockwise, and its holes, clockwise; rings without area are left out."""
    rings = [r for r in rings if len(r) > 3 and twice_area(r) != 0]
    if len(rings) == 1:
        return [[rings[0] if twice_area(rings[0]) > 0 else rings[0][::-1]]]
    sizes = [abs(twice_area(r)) for r in rings]
    boxes = [(*r.min(0), *r.max(0)) for r in rings]
    at = [scan_point([r]) for r in rings]
    around = []
    for i, p in enumerate(at):
        b = boxes[i]
        around.append([j for j, c in enumerate(boxes) if sizes[j] > sizes[i] and p is not None and c[0] <= b[0] and c[1] <= b[1] and c[2] >= b[2] and c[3] >= b[3] and holds(rings[j], np.array(p))])
    turned = lambda r, left: r if (twice_area(r) > 0) == left else r[::-1]
    found = {i: [turned(r, True)] for i, r in enumerate(rings) if len(around[i]) % 2 == 0}
    for i, r in enumerate(rings):
        if len(around[i]) % 2:
            found[min((j for j in around[i] if j in found), key=sizes.__getitem__)].append(turned(r, False))
    return list(found.values())


def parts_of(rings: Column) -> Column:
    """The parts of a shape, each an array of rings, the outer one first; null has none."""

    @F.arrow_udf(PARTS)
    def run(column: pa.Array) -> pa.Array:
        split_ = [split(r) for r in unpacked(column)]
        flat = packed([p for parts in split_ for p in parts])
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(p) for p in split_])]), pa.int32()), flat)

    return run(rings.cast(RINGS))


def exploded(df: DataFrame, rings: str) -> DataFrame:
    """One row for each part, with its number from 0 in `part`; shapes without a part are left out."""
    return df.select("*", F.posexplode(parts_of(F.col(rings))).alias("part", "_rings")).drop(rings).withColumnRenamed("_rings", rings)


def interior_point(rings: Column) -> Column:
    """struct<x, y> strictly inside the shape; null where it has no area."""

    @F.arrow_udf("struct<x:double,y:double>")
    def run(column: pa.Array) -> pa.Array:
        return pa.array([None if (p := scan_point(r)) is None else {"x": p[0], "y": p[1]} for r in unpacked(column)], pa.struct([("x", pa.float64()), ("y", pa.float64())]))

    return run(rings.cast(RINGS))


def polygons_of(lines: Column) -> Column:
    """The polygons of a collection: of an array of coordinate sequences the closed ones with area; the rest are points and lines."""
    from .geometry import area

    return F.filter(lines.cast(RINGS), lambda r: (F.size(r) > 3) & (F.get(r, 0) == F.element_at(r, -1)) & (area(r) > 0))


__all__ = ["ARROW_RINGS", "PARTS", "exploded", "interior_point", "parts_of", "polygons_of", "scan_point", "split"]
