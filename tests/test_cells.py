"""Joins of shapes within cells: crowded cells over blocks, in flat arrays, without rings in the output."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitespark.functions import overlay
from sitespark.operators import polygons

RING = lambda points: [{"x": float(a), "y": float(b)} for a, b in points]


def made(r, n, reach):
    """Boxes, diamonds, either way around, boxes with a hole, bent shapes."""
    out = []
    for k in range(n):
        x, y, h = r.randrange(-40, 40), r.randrange(-40, 40), r.randrange(1, reach)
        box, diamond = ([(x + i * m, y + j * m) for i, j in c] for m, c in ((h, ((-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1))), (h, ((1, 0), (0, 1), (-1, 0), (0, -1), (1, 0)))))
        bent = [(x, y), (x + 2 * h, y), (x + 2 * h, y + h), (x + h, y + h), (x + h, y + 2 * h), (x, y + 2 * h), (x, y)]
        hole = [(x + i * h / 2, y + j * h / 2) for i, j in ((-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1))]
        out.append((k, [RING(c) for c in ([box], [diamond], [diamond[::-1]], [box, hole], [bent])[k % 5]]))
    return out + [(900, None), (901, []), *((k + 1000, out[0][1]) for k in range(3))]


def arrays(rings):
    return [np.array([(p["x"], p["y"]) for p in ring]) for ring in rings or []]


@pytest.mark.parametrize("rows", [(2048, 512), (5, 3)])
def test_shapes_that_meet_shapes(spark, monkeypatch, rows):
    monkeypatch.setattr(polygons, "ROWS", rows)
    r = random.Random(5)
    a, b = made(r, 45, 6), made(r, 30, 30)
    df = spark.createDataFrame(a, f"l long, a {overlay.RINGS}"), spark.createDataFrame(b, f"k long, b {overlay.RINGS}")
    found = polygons.meeting(*df, "a", "b", 8.0, columns=["l", "k"])
    assert found.columns == ["l", "k"] and sorted(polygons.meeting(*df, "a", "b", 8.0).columns) == ["a", "b", "k", "l"]
    want = [(m, n) for m, p in a for n, q in b if overlay.gap_of(arrays(p), arrays(q)) == 0]
    assert sorted(map(tuple, found.collect())) == sorted(want) and len(want) > 250


@pytest.mark.parametrize("rows", [(2048, 512), (5, 3)])
def test_points_in_shapes_of_all_sizes(spark, monkeypatch, rows):
    """Some shapes span many cells and meet points by the quadtree; points on edges are in no shape."""
    monkeypatch.setattr(polygons, "ROWS", rows)
    r = random.Random(6)
    shapes = [*made(r, 40, 12), (800, [RING([(-60, -60), (60, -60), (60, 60), (-60, 60), (-60, -60)])])]
    points = [(k, float(r.randrange(-45, 45)), float(r.randrange(-45, 45))) for k in range(200)] + [(900, None, 1.0), (901, 3.0, 3.0), (902, 3.0, 3.0)]
    got = polygons.points_in(spark.createDataFrame(points, "p long, x double, y double"), spark.createDataFrame(shapes, f"k long, rings {overlay.RINGS}"), "x", "y", "rings", 8.0, columns=["p", "k"])

    def inside(x, y, rings):
        hit = False
        for ring in arrays(rings):
            for (ax, ay), (bx, by) in zip(ring[:-1], ring[1:]):
                if (bx - ax) * (y - ay) == (by - ay) * (x - ax) and min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by):
                    return False
                hit ^= (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax
        return bool(hit)

    want = [(p, k) for p, x, y in points if x is not None for k, rings in shapes if inside(x, y, rings)]
    assert got.columns == ["p", "k"] and sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 300


def test_most_pairs_are_told_by_half_planes():
    """Rings either way around; bent shapes, shapes with holes, stars that wind twice and nulls are not taken for convex."""
    r = random.Random(7)
    shapes = made(r, 60, 20)
    t = np.arange(6) * 4 * np.pi / 5
    star = RING(np.column_stack([np.cos(t), np.sin(t)]).round(6) * 30)
    star[-1] = star[0]
    rings = [arrays(s) for _, s in shapes] + [arrays([star])]
    of = overlay.flat_edges(overlay.packed(rings))
    ok, sides = planes = overlay.half_planes(of)
    assert ok[:60].tolist() == [k % 5 in (0, 1, 2) for k in range(60)] and not ok[60:62].any() and not ok[-1] and len(sides) >= 4
    low = np.array([[r.uniform(-50, 50), r.uniform(-50, 50)] for _ in range(300)])
    boxes = [*low.T, *(low + 2).T]
    i, j = (v.ravel() for v in np.meshgrid(np.arange(300), np.arange(len(rings)), indexing="ij"))
    known = overlay.told(boxes, planes, i, j)
    corners = [[np.array([(x, y), (x + 2, y), (x + 2, y + 2), (x, y + 2), (x, y)])] for x, y in low]
    touch = overlay.pairs_meet(overlay.flat_edges(overlay.packed(corners)), of, i, j)
    assert touch[known > 0].all() and not touch[known < 0].any() and (known[np.isin(j, np.flatnonzero(ok))] != 0).mean() > 0.8
    whole = np.logical_and.reduce([overlay.pairs_inside(low + [a, b], of, i, j) for a in (0, 2) for b in (0, 2)])
    assert whole[known > 0].all() and (known > 0).any() and (known < 0).any()
