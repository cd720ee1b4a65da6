import random

import numpy as np
from pyspark.sql import functions as F

from sitespark.functions import geometry, overlay
from sitespark.operators import polygons


def star(r, n=9):
    angles = np.sort(r.uniform(0, 2 * np.pi, n))
    radii = r.uniform(2, 10, n)
    ring = np.column_stack([20 + radii * np.cos(angles), 20 + radii * np.sin(angles)]) + r.uniform(-4, 4, 2)
    return np.vstack([ring, ring[:1]])


def inside(rings, x, y):
    hit = np.zeros(x.shape, bool)
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring[:-1], ring[1:]):
            if ay != by:
                up = (ay <= y) != (by <= y)
                hit ^= up & (x < (bx - ax) * (y - ay) / (by - ay) + ax)
    return hit


def test_overlays_cover_the_same_points_as_their_definition():
    r = np.random.default_rng(4)
    x, y = r.uniform(0, 40, 4000), r.uniform(0, 40, 4000)
    for _ in range(25):
        a, b = [star(r), star(r, 5)], [star(r)]
        for name, f in overlay.OPERATIONS.items():
            got = overlay.overlay(a, b, name)
            want = f(inside(a, x, y), inside(b, x, y))
            assert (inside(got, x, y) == want).mean() > 0.9995
            assert abs(overlay.rings_area(got) - want.mean() * 1600) < 45
    assert overlay.overlay([], [], "union") == []


def test_overlay_areas_add_up():
    r = np.random.default_rng(5)
    for _ in range(50):
        a, b = [star(r)], [star(r)]
        area = {k: overlay.rings_area(overlay.overlay(a, b, k)) for k in overlay.OPERATIONS}
        whole = [overlay.rings_area(overlay.overlay(p, [], "union")) for p in (a, b)]
        assert abs(area["intersection"] + area["difference"] - whole[0]) < 1e-6 and abs(area["union"] - sum(whole) + area["intersection"]) < 1e-6


def box(x0, y0, x1, y1):
    return np.array([(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)], float)


def test_distances():
    assert overlay.gap_of([box(0, 0, 1, 1)], [box(3, 0, 4, 1)]) == 2
    assert overlay.gap_of([box(0, 0, 9, 9)], [box(3, 3, 4, 4)]) == 0
    assert overlay.gap_of([box(0, 0, 9, 9), box(2, 2, 7, 7)], [box(3, 3, 4, 4)]) == 1  # in the hole
    assert overlay.gap_of([box(0, 0, 1, 1)], [box(1, 0, 2, 1)]) == 0
    assert overlay.gap_of([np.array([(0.0, 0.0), (5.0, 0.0)])], [np.array([(2.0, 3.0), (2.0, 1.0)])]) == 1
    assert overlay.gap_of([], [box(0, 0, 1, 1)]) is None


def test_simplified_keeps_within_the_tolerance():
    r = random.Random(2)
    ring = [(k, r.random() * 0.1) for k in range(50)] + [(50, 40), (0, 40), (0, 0)]
    ring = np.array([*ring[:-1], ring[0]], float)
    got = overlay.simplified_ring(ring, 0.2)
    assert len(got) < 10 and (got[0] == got[-1]).all() and abs(overlay.ring_area(got) - overlay.ring_area(ring)) < 20


def test_columns_of_polygons(spark):
    a = F.array(geometry.box_ring(F.lit(0), F.lit(0), F.lit(4), F.lit(4)))
    b = F.array(geometry.box_ring(F.lit(3), F.lit(3), F.lit(6), F.lit(6)))
    bow = F.array(F.array(*[geometry.point(F.lit(x), F.lit(y)) for x, y in ((0, 0), (4, 4), (4, 0), (0, 4), (0, 0))]))
    df = spark.range(2).select("id", a.alias("a"), F.when(F.col("id") == 0, b).alias("b"), bow.alias("bow"))
    got = df.select("id", *[overlay.total_area(overlay.combined(F.col("a"), F.col("b"), k)).alias(k) for k in overlay.OPERATIONS], overlay.total_area(overlay.repaired(F.col("bow"))).alias("bow"), overlay.total_area(overlay.difference_ladder(F.col("a"), F.col("b"))).alias("ladder")).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(0, 1.0, 24.0, 15.0, 8.0, 15.0), (1, 0.0, 16.0, 16.0, 8.0, 16.0)]
    parts = df.limit(1).select(F.concat("a", F.array(geometry.box_ring(F.lit(10), F.lit(0), F.lit(20), F.lit(9)))).alias("parts"))
    assert parts.select(geometry.area(overlay.largest_part(F.col("parts")))).first()[0] == 90
    assert parts.select(F.explode("parts")).count() == 2


def test_dissolved_and_empty_tables(spark):
    df = spark.createDataFrame([(1, 0, 0, 10, 10), (1, 5, 5, 15, 15), (2, 0, 0, 1, 1)], "k long, a int, b int, c int, d int")
    df = df.select("k", F.array(geometry.box_ring(F.col("a"), F.col("b"), F.col("c"), F.col("d"))).alias("rings"))
    assert sorted(map(tuple, polygons.dissolved_area(df, "k", "rings", 8).select("k", "summed", "united").collect())) == [(1, 200.0, 175.0), (2, 1.0, 1.0)]
    assert polygons.dissolved_area(df.limit(0), "k", "rings", 8).collect() == []


def test_a_crowded_cell_is_united_some_at_a_time(spark, monkeypatch):
    """Copies are cut once; 200 boxes of a cell take a sweep for each 64, a bow tie and a star that winds twice count by the even-odd
    rule; a null key is a key."""
    from sitespark.functions import sweep
    from sitespark.operators import dissolve

    box_ = lambda x, y, n: [[{"x": float(a), "y": float(b)} for a, b in ((x, y), (x + n, y), (x + n, y + n), (x, y + n), (x, y))]]
    ring = lambda points: [[{"x": float(a), "y": float(b)} for a, b in points]]
    tie = ring([(0, 0), (4, 4), (4, 0), (0, 4), (0, 0)])
    rows = [(1, box_(k % 20, k // 20, 2)) for k in range(200)] * 3 + [(2, tie), (None, box_(60, 0, 8)), (None, box_(60, 4, 8)), (3, None)]
    asked, real = [], dissolve.cut
    monkeypatch.setattr(dissolve, "cut", lambda shapes, *a: asked.append(shapes.count()) or real(shapes, *a))
    out = polygons.dissolved_area(spark.createDataFrame(rows, f"k int, rings {overlay.RINGS}"), "k", "rings", 64)
    got = {r["k"]: (r["summed"], r["united"]) for r in out.collect()}
    assert asked == [204] and got[1] == (2400.0, 21 * 11) and got[2][1] == 8.0 and got[None] == (128.0, 96.0) and got[3] == (None, None)
    t = np.arange(6) * 4 * np.pi / 5
    assert sweep.is_convex(np.array([(0, 0), (2, 0), (2, 2), (1, 2), (0, 2), (0, 0)], float)) and not sweep.is_convex(np.column_stack([np.cos(t), np.sin(t)]).round(6))
    assert not sweep.is_convex(np.array([(0, 0), (4, 4), (4, 0), (0, 4), (0, 0)], float)) and not sweep.is_convex(np.array([(0, 0), (4, 0), (0, 0), (0, 0)], float))


def boxes(r, n=2):
    corners = [np.sort(r.integers(0, 6, (2, 2)), 0).astype(float) for _ in range(n)]
    return [box(*c[0], *c[1]) for c in corners if (c[0] < c[1]).all()]


def test_outlines_of_shapes_that_share_edges():
    """Boxes on whole numbers: edges coincide and end on one another. Areas by counting cells; rings turn at every vertex,
    and outer ones run the other way than holes."""
    r = np.random.default_rng(6)
    x, y = (v.ravel() + 0.5 for v in np.meshgrid(np.arange(6), np.arange(6)))
    for _ in range(150):
        a, b = boxes(r), boxes(r)
        for name, f in overlay.OPERATIONS.items():
            got = overlay.overlay(a, b, name)
            want = f(inside(a, x, y), inside(b, x, y))
            assert (inside(got, x, y) == want).all() and overlay.rings_area(got) == want.sum()
            for ring in got:
                d = np.diff(ring, axis=0)
                turns = d[:, 0] * np.roll(d, -1, 0)[:, 1] - d[:, 1] * np.roll(d, -1, 0)[:, 0]
                assert (ring[0] == ring[-1]).all() and (turns != 0).all()


def test_a_hole_in_an_outline():
    (outer, hole) = sorted(overlay.overlay([box(0, 0, 9, 9)], [box(3, 3, 5, 6)], "difference"), key=overlay.ring_area, reverse=True)
    signed = lambda p: float((p[:-1, 0] * p[1:, 1] - p[1:, 0] * p[:-1, 1]).sum()) / 2
    assert signed(outer) == 81 and signed(hole) == -6
    assert len(overlay.overlay([box(0, 0, 1, 1)], [box(1, 1, 2, 2)], "union")) == 2  # touching in a point
    assert len(overlay.overlay([box(0, 0, 1, 1)], [box(1, 0, 2, 1)], "union")[0]) == 5  # the shared edge is gone


def test_a_hundred_thousand_vertices_in_seconds():
    import time

    t = np.linspace(0, 2 * np.pi, 100_000, endpoint=False)
    q = 1000 * (1 + 0.1 * np.sin(40 * t) + np.random.default_rng(1).uniform(-1e-5, 1e-5, len(t)))
    a = np.column_stack([q * np.cos(t), q * np.sin(t)])
    a = np.vstack([a, a[:1]])
    b, start = a + [37.3, 11.7], time.process_time()
    union, shared = overlay.overlay([a], [b], "union"), overlay.overlay([a], [b], "intersection")
    assert abs(overlay.rings_area(union) + overlay.rings_area(shared) - 2 * overlay.ring_area(a)) < 1e-3
    gap = overlay.gap_of([a], [a + [2500, 0]])
    near = a[np.abs(a[:, 1]) < 300]
    east, west = near[near[:, 0] > 0], near[near[:, 0] < 0] + [2500, 0]
    nearest = min(np.sqrt(((west - p) ** 2).sum(1)).min() for p in east[::25])
    assert 0 <= nearest - gap < 1
    assert time.process_time() - start < 30


def test_points_keep_their_shape_whatever_is_null(spark):
    points = spark.createDataFrame([(1.0, 1.0, "a", None), (1.0, 1.0, None, None), (1.0, 1.0, None, None), (50.0, 50.0, None, "x")], "px double, py double, name string, other string")
    shapes = spark.range(1).select(F.lit("s").alias("shape"), F.array(geometry.box_ring(F.lit(0), F.lit(0), F.lit(4), F.lit(4))).alias("rings"))
    got = polygons.points_in(points, shapes, "px", "py", "rings", 3.0, how="left")
    assert sorted((r["px"], r["shape"] or "") for r in got.collect()) == [(1.0, "s")] * 3 + [(50.0, "")]
