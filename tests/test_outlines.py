import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitespark.functions import geometry
from sitespark.functions.overlay import overlay, ring_area, rings_area
from sitespark.operators import burn, outlines, raster
from sitespark.sources import clustered

PIXELS = "tile int, row long, col long, region long"


def grid_of(rings, high, wide):
    """Pixels whose centre is inside by the even-odd rule."""
    y, x = np.mgrid[:high, :wide] + 0.5
    inside = np.zeros((high, wide), bool)
    for r in rings:
        for (x0, y0), (x1, y1) in zip(r[:-1], r[1:]):
            if y0 != y1:
                up = (y0 > y) != (y1 > y)
                inside ^= up & (x < x0 + (y - y0) * (x1 - x0) / (y1 - y0))
    return inside


def labelled(spark, grid, tile=0):
    return spark.createDataFrame([(tile, int(r), int(c), int(grid[r, c])) for r, c in np.argwhere(grid >= 0)], PIXELS)


@pytest.mark.parametrize("seed,cell", [(1, 4), (2, 7), (3, 64)])
def test_outlines_enclose_their_pixels(spark, seed, cell):
    grid = np.random.default_rng(seed).integers(0, 4, (19, 23))
    got = {r["region"]: [[(p["x"], -p["y"]) for p in ring] for ring in r["rings"]] for r in outlines.region_outlines(labelled(spark, grid), cell=cell).collect()}
    assert set(got) == set(np.unique(grid)) - {0}
    for label, rings in got.items():
        assert (grid_of(rings, *grid.shape) == (grid == label)).all()
        for r in rings:
            assert r[0] == r[-1] and len(r) >= 5 and all((a[0] == b[0]) != (a[1] == b[1]) for a, b in zip(r, r[1:]))
            assert all((a[0] == b[0]) != (b[0] == c[0]) for a, b, c in zip(r, r[1:], r[2:]))  # each vertex turns
        edges = [(a, b) for r in rings for a, b in zip(r, r[1:])]
        assert len(edges) == len(set(edges))


def test_a_spiral_over_many_cells(spark):
    """One region whose outline enters and leaves cells all the way: one ring, from chains of 40 cells and more."""
    n, grid = 41, np.zeros((41, 41), np.int64)
    r = c = 0
    turn = ((0, 1), (1, 0), (0, -1), (-1, 0))
    grid[0, 0], k, length = 1, 0, n - 1
    while length > 0:
        for _ in range(2 if k else 3):
            for _ in range(length):
                r, c = r + turn[k % 4][0], c + turn[k % 4][1]
                grid[r, c] = 1
            k += 1
        length -= 2
    (row,) = outlines.region_outlines(labelled(spark, grid), cell=5).collect()
    assert len(row["rings"]) == 1
    ring = np.array([(p["x"], p["y"]) for p in row["rings"][0]])
    assert ring_area(ring) == grid.sum() and np.abs(np.diff(ring, axis=0)).sum() == (2 * grid.sum() + 2)


def test_holes_tiles_and_corner_touches(spark):
    ring = np.zeros((9, 9), int)
    ring[1:8, 1:8] = 1
    ring[3:6, 3:6] = 0
    ring[4, 4] = 1
    touch = np.array([[2, 0], [0, 2]])
    df = labelled(spark, ring, 3).union(labelled(spark, touch, 5)).union(spark.createDataFrame([(6, 0, 0, None), (6, 0, 1, -2)], PIXELS))
    got = {(r["tile"], r["region"]): r["rings"] for r in outlines.region_outlines(df, cell=4, west=100.0, north=50.0, dx=2.0, dy=3.0).collect()}
    areas = {k: [float(spark.range(1).select(geometry.signed_area(F.array(*[geometry.point(F.lit(p["x"]), F.lit(p["y"])) for p in r]))).first()[0]) for r in v] for k, v in got.items()}
    assert areas == {(3, 1): [49 * 6.0, 6.0, -9 * 6.0], (5, 2): [6.0, 6.0]}
    assert outlines.region_outlines(df.filter("tile > 9")).count() == 0


def test_polygons_are_four_connected(spark):
    grid = np.random.default_rng(7).integers(0, 2, (16, 16)) + 1
    df = labelled(spark, grid).withColumnRenamed("region", "cls")
    got = outlines.polygons(df, cell=5).collect()
    assert sum(r["pixel_count"] for r in got) == 256 and {r["cls"] for r in got} == {1, 2}
    for r in got:
        rings = [np.array([(p["x"], p["y"]) for p in ring]) for ring in r["rings"]]
        signs = [float((x[:-1, 0] * x[1:, 1] - x[1:, 0] * x[:-1, 1]).sum()) / 2 for x in rings]
        assert signs[0] > 0 and all(s < 0 for s in signs[1:]) and sum(signs) == r["pixel_count"]


def star(r, n, reach=12):
    c = r.uniform(2, 18), r.uniform(2, 18)
    ring = [(c[0] + d * np.cos(a), c[1] + d * np.sin(a)) for a, d in zip(sorted(r.uniform(0, 6.283) for _ in range(n)), (r.uniform(0.2, reach) for _ in range(n)))]
    return np.array([*ring, ring[0]])


@pytest.mark.parametrize("seed", range(8))
def test_runs_of_random_polygons(seed):
    r = random.Random(seed)
    rings = [star(r, r.randrange(3, 9)) for _ in range(r.randrange(1, 3))]
    got = np.zeros((20, 20), bool)
    for row, a, b in burn.runs_of(rings, (0, 20), (0, 20), False):
        assert not got[row, a : b + 1].any()
        got[row, a : b + 1] = True
    assert (got == grid_of(rings, 20, 20)).all()
    touched = np.zeros((20, 20), bool)
    for row, a, b in burn.runs_of(rings, (0, 20), (0, 20), True):
        touched[row, a : b + 1] = True
    want = np.zeros((20, 20), bool)
    for i in range(20):
        for j in range(20):
            square = [np.array([(j, i), (j + 1, i), (j + 1, i + 1), (j, i + 1), (j, i)], float)]
            want[i, j] = rings_area(overlay(rings, square, "intersection")) > 1e-9
    assert (touched == want).all()


def test_zones_with_nothing_under_them(spark):
    pixels = spark.createDataFrame([(0, 0, 0, 5.0), (0, 0, 1, None), (1, 0, 0, 9.0)], "tile int, row int, col int, value double")
    box = lambda x, n: F.array(geometry.box_ring(F.lit(x), F.lit(0), F.lit(x + n), F.lit(1)))
    zones = spark.range(1).select(F.lit("a").alias("zone"), box(0, 2).alias("rings")).union(spark.range(1).select(F.lit("far"), box(50, 2))).union(spark.range(1).select(F.lit("none"), F.lit(None).cast("array<array<struct<x:double,y:double>>>")))
    got = {r["zone"]: (r["n"], r["mean"], r["least"], r["most"]) for r in burn.zonal(pixels, zones, "zone", "rings", (0, 4), (0, 4)).collect()}
    assert got == {"a": (2, 7.0, 5.0, 9.0), "far": (0, None, None, None), "none": (0, None, None, None)}


def test_a_box_reaches_the_scan(spark, tmp_path):
    """The comparisons are pushed, and most row groups are not read."""
    path = str(tmp_path / "c")
    k = F.col("id")
    df = spark.range(60_000).select("id", F.array(geometry.box_ring(k * 7919 % 100_003, k * 104_729 % 99_991, k * 7919 % 100_003 + 1, k * 104_729 % 99_991 + 1)).alias("rings"))
    clustered.write_clustered(df, path, "rings", files=4, group_bytes=64 << 10)
    box = (10_000.5, 10_000.5, 15_000.5, 15_000.5)
    found = clustered.in_box(spark.read.parquet(path), box)
    plan = found._jdf.queryExecution().toString()
    assert all(f"{c}" in plan.split("PushedFilters")[1].split("]")[0] for c in ("xmin", "ymin", "xmax", "ymax"))
    want = df.withColumn("b", geometry.bounds(F.flatten("rings"))).filter(f"b.xmin <= {box[2]} and b.ymin <= {box[3]} and b.xmax >= {box[0]} and b.ymax >= {box[1]}").count()
    assert found.count() == want > 50
    executed = found.select("id")._jdf.queryExecution().executedPlan()
    executed.executeCollect()
    scan = executed.collectLeaves().head()
    assert 0 < scan.metrics().get("numOutputRows").get().value() < 60_000 / 4


def test_groups_of_codes_go_through_the_rounds_together(spark, monkeypatch):
    """Two groups that share a code, on two tiles: one labelling of components for both, and the same rows as each group by itself."""
    from sitespark.operators import raster

    code = F.when((F.col("row") > 2) & (F.col("row") < 12), 1).when(F.col("row") < 30, 2).otherwise(3)
    codes = spark.range(2 * 40 * 20).selectExpr("cast(id div 800 + 7 as int) AS tile", "id % 800 div 20 AS row", "id % 20 AS col").withColumn("value", code)
    row = lambda r: (r["cover"], r["tile"], r["region"], r["pixel_count"], r["area_m2"], r["centre"]["x"], r["centre"]["y"])
    groups = {"a:b": [1, 2], "c": [2, 3]}
    apart = sorted(row(r) for name, of in groups.items() for r in outlines.candidates(codes, {name: of}, 12, 0.5, cell=16).collect())
    asked, real = [], raster.components
    monkeypatch.setattr(raster, "components", lambda *a, **k: asked.append(1) or real(*a, **k))
    out = outlines.candidates(codes, groups, 12, 0.5, cell=16)
    assert sorted(map(row, out.collect())) == apart and len(apart) >= 4 and {r[:2] for r in apart} == {("a:b", 7), ("a:b", 8), ("c", 7), ("c", 8)}
    assert len(asked) == 2 and out.schema["tile"].dataType.simpleString() == "int"


def test_pieces_of_a_region_that_spans_the_raster(spark):
    """A region with holes over many cells: each piece stays in its cell, areas add up, no row holds the whole."""
    r = np.random.default_rng(3)
    on = r.random((40, 24)) < 0.7
    on[::8] = True
    pixels = spark.createDataFrame([(0, int(y), int(x), 0) for y, x in np.argwhere(on)], "tile int, row long, col long, cls int")
    labelled = raster.components(pixels, raster.FOUR).withColumn("label", F.col("component") + 1)
    got = outlines.region_pieces(labelled, "label", cell=8, west=100.0, north=50.0, dx=2.0, dy=3.0).collect()
    want = {t["label"]: t["n"] * 6.0 for t in labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    found = {}
    for t in got:
        rings = [np.array([(p["x"], p["y"]) for p in ring]) for ring in t["rings"]]
        at = np.concatenate(rings)
        assert np.ptp(at[:, 0]) <= 16 and np.ptp(at[:, 1]) <= 24 and all((ring[0] == ring[-1]).all() for ring in rings)
        found[t["label"]] = found.get(t["label"], 0) + sum(float((q[:-1, 0] * q[1:, 1] - q[1:, 0] * q[:-1, 1]).sum()) / 2 for q in rings)
    assert found == want and max(want.values()) > 3000
