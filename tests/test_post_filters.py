import numpy as np
from pyspark.sql import functions as F

from sitespark.functions import geometry, overlay
from sitespark.operators import dissolve, nodes, post_filters

CANDIDATE = f"id long, rings {overlay.RINGS}, status string, status_reason string, composite_score double, slope_review_flag boolean, confidence string, num_anchors int, utility_status string, parcel_count int"


def square(x, y, n):
    return [[{"x": float(a), "y": float(b)} for a, b in ((x, y), (x + n, y), (x + n, y + n), (x, y + n), (x, y))]]


def shape(rows):
    return {r["id"]: None if r["rings"] is None else [np.array([(p["x"], p["y"]) for p in ring]) for ring in r["rings"]] for r in rows}


def test_subtraction_over_cells(spark):
    """A bar across four squares, one of them wholly covered, one not touched; slanted others against one overlay without cells."""
    a = spark.createDataFrame([(1, square(0, 0, 30)), (2, square(100, 10, 4)), (3, square(0, 90, 10)), (None, square(40, 0, 30)), (4, None)], f"id long, rings {overlay.RINGS}")
    b = spark.createDataFrame([([[{"x": float(x), "y": float(y)} for x, y in ((-5, 8), (200, 8), (200, 18), (-5, 18), (-5, 8))]],)], f"other {overlay.RINGS}")
    rows = dissolve.subtracted(a, "id", "rings", b, "other", 8.0).collect()
    got = shape(rows)
    assert {r["id"]: r["touched"] for r in rows} == {1: True, 2: True, 3: False, None: True, 4: False}
    assert [overlay.rings_area(got[k]) for k in (1, 3, None)] == [600, 100, 600] and got[2] is None and len(got[1]) == 2
    r = np.random.default_rng(5)
    star = lambda: (lambda t, q, c: np.vstack([p := np.column_stack([q * np.cos(t), q * np.sin(t)]) + c, p[:1]]))(np.sort(r.uniform(0, 6.28, 9)), r.uniform(2, 20, 9), r.uniform(-15, 15, 2))
    whole, away = [star() for _ in range(6)], [star() for _ in range(4)]
    as_row = lambda ring: [[{"x": float(x), "y": float(y)} for x, y in ring]]
    got = shape(dissolve.subtracted(spark.createDataFrame([(k, as_row(s)) for k, s in enumerate(whole)], f"id long, rings {overlay.RINGS}"), "id", "rings", spark.createDataFrame([(as_row(s),) for s in away], f"other {overlay.RINGS}"), "other", 16.0).collect())
    union = []
    for s in away:
        union = overlay.overlay(union, [s], "union")
    for k, s in enumerate(whole):
        want = overlay.overlay([s], union, "difference")
        assert abs(overlay.rings_area(got[k] or []) - overlay.rings_area(want)) < 1e-6 and len(got[k] or []) == len(want)


def test_only_shapes_across_cells_are_put_together(spark, monkeypatch):
    """Of five squares one crosses a border between cells and the bar, one is beside the bar in its cell."""
    asked, real = [], dissolve.joined
    monkeypatch.setattr(dissolve, "joined", lambda cells, *a: asked.append({r["key"]["of"] for r in cells.collect()}) or real(cells, *a))
    a = spark.createDataFrame([(1, square(10, 10, 20)), (2, square(60, 10, 20)), (3, square(10, 50, 10)), (4, square(80, 20, 4)), (5, square(10, 200, 10))], f"id long, rings {overlay.RINGS}")
    b = spark.createDataFrame([([[{"x": float(x), "y": float(y)} for x, y in ((-5, 18), (100, 18), (100, 26), (-5, 26), (-5, 18))]],)], f"other {overlay.RINGS}")
    rows = dissolve.subtracted(a, "id", "rings", b, "other", 64.0).collect()
    got = shape(rows)
    assert asked == [{2}] and {r["id"]: r["touched"] for r in rows} == {1: True, 2: True, 3: False, 4: True, 5: False}
    assert [overlay.rings_area(got[k]) for k in (1, 2, 3, 5)] == [240, 240, 100, 100] and got[4] is None and len(got[1]) == len(got[2]) == 2


def test_pairs_are_listed_where_cells_cannot_tell(spark, monkeypatch):
    """Candidates deep inside a zone need no pair; those on its edge, around it, or beside a line do."""
    asked, real = [], post_filters.polygons.meeting
    monkeypatch.setattr(post_filters.polygons, "meeting", lambda left, *a: asked.append({r["id"] for r in left.collect()}) or real(left, *a))
    deep = [(k, square(4200 + 4 * k, 4200, 9)) for k in range(400)]
    a = spark.createDataFrame([*deep, (500, square(9990, 500, 30)), (501, square(10_000, 600, 30)), (502, square(10_001, 700, 30)), (503, square(-900, -900, 12_000)), (504, square(11_000, 9000, 100)), (505, None)], f"id long, rings {overlay.RINGS}")
    line = [[{"x": 11_050.0, "y": 8500.0}, {"x": 11_050.0, "y": 9500.0}]]
    zones = spark.createDataFrame([(square(0, 0, 10_000),), (line,), (None,)], f"zone {overlay.RINGS}")
    hit = [r["id"] for r in post_filters.touching(a, "id", "rings", zones, "zone", 4096.0).collect()]
    assert sorted(hit) == [*range(400), 500, 501, 503, 504] and asked == [{500, 501, 502, 503, 504, 505}]


def test_the_chain(spark):
    side = np.sqrt(60 / geometry.ACRES_PER_M2_ROUNDED)  # 60 acres
    row = lambda k, x, n, status="kept": (k, square(x, 0, n), status, None, 92.0, False, "high", 3, "named", None)
    candidates = spark.createDataFrame([row(1, 0, side), row(2, 10_000, side), row(3, 20_000, side, "excluded"), row(4, 30_000, 2 * side), row(5, 40_000, 4 * side, "manual_review"), row(6, 60_000, 4 * side)], CANDIDATE)
    lands = spark.createDataFrame([(square(100, 100, 5), "4", "PVT", "NRA"), (square(10_100, 100, 5), "2", "FED", "NRA"), (square(20_100, 100, 5), "3", "FED", None)], f"rings {overlay.RINGS}, gap string, manager string, designation string")
    airports = spark.createDataFrame([(square(10_000 + float(side), 0, 50),), (square(100, 100, 5),)], f"rings {overlay.RINGS}")
    roads = spark.createDataFrame([([[{"x": 30_000.0 + x, "y": -500.0}, {"x": 30_000.0 + x, "y": 5000.0}]],) for x in (100, 150, 200, 250, 300, 350, 400, 450)] + [([[{"x": 60_500.0, "y": -500.0}, {"x": 60_500.0, "y": 9000.0}]],)], f"lines {overlay.RINGS}")
    out = {r["id"]: r for r in post_filters.post_filtered(candidates, "id", "rings", lands, airports, roads, 4096.0).collect()}
    assert {k: (r["status"], r["status_reason"]) for k, r in out.items()} == {1: ("excluded", None), 2: ("excluded", post_filters.AIRPORT), 3: ("excluded", None), 4: ("kept", None), 5: ("manual_review", None), 6: ("kept", None)}
    cut = 4 * side * (4 * side - 50) * geometry.ACRES_PER_M2_ROUNDED
    assert abs(out[6]["area_acres"] - cut) < 1e-6 and out[6]["size_class"] == "campus" and out[6]["recommended_action"] == "Shortlist" and out[5]["recommended_action"] == "Manual Review"
    assert abs(out[4]["area_acres"] - 2 * side * (2 * side - 400) * geometry.ACRES_PER_M2_ROUNDED) < 1e-6 and out[4]["acreage_tier"] == "moderate"


def test_nodes(spark):
    g = spark.createDataFrame([(1, 2, "b", "coal", "t", 6, 2001, 5.0, 7.0), (1, 1, "a", "gas", None, 5, None, 1.0, 2.0), (1, 3, "c", "gas", "u", 1, 2009, 5.0, 7.0), (2, 1, "x", "gas", "t", 9, 2000, 1.0, 1.0), (3, 1, "y", "gas", "t", 90, 2000, 1.0, None)], "plant int, unit int, name string, fuel string, tech string, mw long, year int, lon double, lat double")
    assert [tuple(r) for r in nodes.plants(g, ["plant"], 10).collect()] == [(1, 12, 2009, 3, "a", 1.0, 2.0, "coal", "t")]
    n = g.withColumn("status", F.when(F.col("unit") == 3, "operating").otherwise("retired"))
    assert sorted(map(tuple, nodes.nuclear_plants(n, ["plant"]).collect())) == [(1, "a", "operating", 12, None, 1.0, 2.0), (2, "x", "retired", 9, 2000, 1.0, 1.0)]
