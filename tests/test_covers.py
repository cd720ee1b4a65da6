import random

import pytest
from pyspark.sql import functions as F

from sitespark.operators import covers, polygons, spatial
from sitespark.plans import shapes, sites

DATA = "/root/testdata/sf0.001"


def places(r, n):
    return [(k, float(r.randrange(-60, 60)), float(r.randrange(-60, 60))) for k in range(n)] + [(900, None, 1.0), (901, 3.0, 3.0), (902, 3.0, 3.0)]


def test_sums_and_minima_over_rings_of_discs(spark):
    """Points on the limits, repeated places, places without a value; small cells, so that most are wholly in a band."""
    r = random.Random(1)
    points = places(r, 400)
    anchors = [(k, r.uniform(-70, 70), float(r.randrange(-70, 70))) for k in range(30)] + [(50, 3.0, 8.0), (51, None, 2.0)]
    limits = [25, 400, 1600]
    kind = covers.discs("u", "v", limits)
    p, a = spark.createDataFrame(points, "k long, x double, y double"), spark.createDataFrame(anchors, "a long, u double, v double")
    got = {(t["x"], t["y"]): (t["n"], t["b"]["w"], t["b"]["a"]) for t in covers.folded(p, a, kind, "x", "y", {"n": ("sum", F.col("band")), "b": ("min", F.struct((-F.col("band") * F.col("a")).alias("w"), "a"))}).collect()}
    want, held = {}, {}
    for k, x, y in points:
        for n, u, v in anchors:
            if x is not None and u is not None and (d := (x - u) ** 2 + (y - v) ** 2) <= limits[-1]:
                band = next(i for i, limit in enumerate(limits, 1) if d <= limit)
                held.setdefault(n, set()).add(k)
                want.setdefault((x, y), {})[n] = band
    assert got == {p: (sum(b.values()), *min((-band * n, n) for n, band in b.items())) for p, b in want.items()}
    sums = covers.gathered(a, p, kind, "a", "x", "y", {"n": ("sum", F.lit(1)), "k": ("max", F.col("k"))}).collect()
    assert {t["a"]: (t["n"], t["k"]) for t in sums} == {n: (len(k), max(k)) for n, k in held.items()}


def test_points_in_polygons_with_holes(spark):
    r = random.Random(2)
    square = lambda x, y, h: [{"x": x + i * h, "y": y + j * h} for i, j in ((-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1))]
    made = [(k, r.uniform(-50, 50), r.uniform(-50, 50), r.uniform(2, 40)) for k in range(20)] + [(90, 0.0, 0.0, 60.5)]
    s = spark.createDataFrame([(k, [square(x, y, h), square(x, y, h / 2)]) for k, x, y, h in made], "s long, rings array<array<struct<x:double,y:double>>>")
    points = places(r, 300)
    got = polygons.points_in(spark.createDataFrame(points, "k long, x double, y double"), s, "x", "y", "rings", 5.0).select("k", "s").collect()
    want = [(k, n) for k, x, y in points if x is not None for n, u, v, h in made if max(abs(x - u), abs(y - v)) < h and max(abs(x - u), abs(y - v)) > h / 2]
    assert sorted(map(tuple, got)) == sorted(want)


@pytest.mark.parametrize("name", ["close_pairs", "highest_zone", "parcels_in_zones", "sites_in_diamonds"])
def test_listed_rows_are_not_broadcast(spark, name):
    """Their files look small, what is listed of them is not."""
    plan = (getattr(sites, name, None) or getattr(shapes, name))(spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "NestedLoop" not in plan


def test_crowded_places_look_no_farther_than_they_must(spark):
    asked = []

    def match(rest, r):
        asked.append((r, rest.count()))
        return rest.filter(F.col("x") < r).withColumn("best", F.lit(r))

    out = spatial.widening(spark.createDataFrame([(float(k), 0.0) for k in range(10)], "x double, y double"), "x", "y", 2.0, 6.0, match)
    assert asked == [(2.0, 10), (4.0, 8), (6.0, 6)] and sorted((t["x"], t["best"]) for t in out.collect()) == [(0.0, 2.0), (1.0, 2.0), (2.0, 4.0), (3.0, 4.0), (4.0, 6.0), (5.0, 6.0)]


def test_the_nearest_of_edges(spark):
    """Long slanted, level and upright edges against a search that begins with small cells; areas count 0 inside."""
    r = random.Random(4)
    lines = [(k, [[{"x": a, "y": b}, {"x": a + r.choice([0, 1, 30]) * r.uniform(-1, 1), "y": b + r.choice([0, 1, 30]) * r.uniform(-1, 1)}]]) for k in range(40) for a, b in [(r.uniform(-60, 60), r.uniform(-60, 60))]]
    points = places(r, 200)
    got = polygons.nearest_shape(spark.createDataFrame(points, "k long, x double, y double"), spark.createDataFrame(lines, "s long, rings array<array<struct<x:double,y:double>>>"), "k", "s", "x", "y", "rings", 25.0, is_area=False).collect()

    def far(x, y, ring):
        (a, b), (c, d) = ((p["x"], p["y"]) for p in ring)
        n = (c - a) ** 2 + (d - b) ** 2
        t = max(0, min(1, ((x - a) * (c - a) + (y - b) * (d - b)) / n)) if n else 0
        return ((x - a - t * (c - a)) ** 2 + (y - b - t * (d - b)) ** 2) ** 0.5

    assert len(got) == len(points)
    for t in got:
        best = min((far(t["x"], t["y"], ring), s) for s, (ring,) in lines) if t["x"] is not None else (99, 0)
        assert (t["s"] is None) if best[0] > 25 else (t["s"] == best[1] and t["distance"] == pytest.approx(best[0]))
