"""Many pairs of shapes at once against the sweep of each."""

import numpy as np
import pyarrow as pa
import pytest

from sitespark.functions import batches, overlay

from test_overlay import box, boxes, star


def columns(pairs):
    return [overlay.packed([p[k] for p in pairs]) for k in range(2)]


def both(pairs, name):
    """Areas and outlines by batches, with the sweep for the rows left to it, and by the sweep alone."""
    left, right = columns(pairs)
    (found,), alone = batches.overlays(batches.read(left), batches.read(right), [overlay.OPERATIONS[name]])
    got = list(overlay.unpacked(overlay.replaced(found, left, right, alone, lambda a, b: overlay.overlay(a, b, name))))
    return got, [overlay.overlay(a, b, name) for a, b in pairs], alone


def turned(rings):
    """Directed edges, in order: where areas touch in a point, the sweep may walk on from one to the other."""
    return sorted(e for r in rings for e in np.hstack([r[:-1], r[1:]]).tolist())


@pytest.mark.parametrize("name", list(overlay.OPERATIONS))
def test_batches_have_the_outlines_of_the_sweep(name):
    r = np.random.default_rng(8)
    pairs = [(boxes(r), boxes(r)) for _ in range(400)] + [([star(r), star(r, 5)], [star(r)]) for _ in range(150)]
    pairs += [([], []), ([], [box(0, 0, 2, 2)]), ([box(0, 0, 2, 2)], []), ([box(0, 0, 9, 9), box(2, 2, 7, 7)], [box(3, 3, 4, 8)]), ([np.array([(0, 0), (4, 4), (4, 0), (0, 4)], float)], []), ([star(r, 200)], [box(15, 15, 25, 25)])]
    got, want, alone = both(pairs, name)
    assert alone.sum() <= 5 and alone[-1]
    for g, w in zip(got, want, strict=True):
        assert turned(g) == turned(w)


def test_sizes_of_rows_differ_by_far():
    """Each row has a grid of its own size: a row of millions beside one of thousandths."""
    pairs = [([box(0, 0, k, k)], [box(k / 2, k / 2, 2 * k, 2 * k)]) for k in (1e-3, 1.0, 1e9)]
    got, _, alone = both(pairs, "intersection")
    assert not alone.any() and [overlay.rings_area(g) for g in got] == pytest.approx([k * k / 4 for k in (1e-3, 1.0, 1e9)], rel=1e-9)


def test_small_pairs_are_not_swept_one_by_one(monkeypatch):
    """A column of boxes takes no call of the sweep, on the ladder neither."""
    monkeypatch.setattr(overlay.sweep, "sides", lambda *a, **k: pytest.fail("swept"))
    pairs = [([box(k % 7, 0, k % 7 + 5, 5)], [box(3, 3, 8, 8)]) for k in range(50)]
    left, right = columns(pairs)
    a, b = batches.read(left), batches.read(right)
    (shared, united), alone = batches.overlays(a, b, [overlay.OPERATIONS["intersection"], overlay.OPERATIONS["union"]])
    rest, again = overlay.first_rung(a, b, 1.0)
    want = np.array([max(0, min(k % 7 + 5, 8) - max(k % 7, 3)) * 2 for k in range(50)])
    assert not alone.any() and not again.any()
    assert (batches.areas(shared) == want).all() and (batches.areas(united) == 50 - want).all() and (batches.areas(rest) == 25 - want).all()


def test_null_rows_and_slices():
    column = pa.array([None, [[{"x": 0.0, "y": 0.0}, {"x": 2.0, "y": 0.0}, {"x": 2.0, "y": 2.0}, {"x": 0.0, "y": 0.0}]], []] * 3, overlay.ARROW_RINGS).slice(1, 7)
    (found,), alone = batches.overlays(batches.read(column), batches.none(7), [overlay.OPERATIONS["union"]])
    assert not alone.any() and batches.areas(found).tolist() == [2, 0, 0, 2, 0, 0, 2] and [v.as_py() is None for v in batches.write(found)] == [False] * 7


def test_subdivided_shapes_are_cut_many_at_once(spark):
    """Boxes that one, two and four cells hold, each piece with its area, and a slanted shape."""
    from pyspark.sql import functions as F
    from sitespark.operators import polygons

    square = lambda x, y, h: [[{"x": x + i * h, "y": y + j * h} for i, j in ((-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1))]]
    slanted = [[{"x": float(x), "y": float(y)} for x, y in ((20, 10), (30, 20), (20, 30), (10, 20), (20, 10))]]
    df = spark.createDataFrame([(1, square(5.0, 5.0, 3.0)), (2, square(10.0, 5.0, 3.0)), (3, square(10.0, 10.0, 4.0)), (4, slanted), (5, None)], f"k long, rings {overlay.RINGS}")
    plan = polygons.subdivide(df, "k", "rings", 10.0, 1.0)
    got = sorted((r["parent_id"], r["cx"], r["cy"], r["area"]) for r in plan.collect())
    want = [(1, 0, 0, 36.0), (2, 0, 0, 18.0), (2, 1, 0, 18.0), *((3, x, y, 16.0) for x in (0, 1) for y in (0, 1)), *((4, x, y, 50.0) for x in (1, 2) for y in (1, 2))]
    assert got == want
    left = overlay.packed([[np.array([(p["x"], p["y"]) for p in slanted[0]])]] * 4)
    right = overlay.packed([[box(x, y, x + 10, y + 10)] for x in (10, 20) for y in (10, 20)])
    (found,), alone = batches.overlays(batches.read(left), batches.read(right), [overlay.OPERATIONS["intersection"]])
    assert not alone.any() and batches.areas(found).tolist() == [50.0] * 4


def test_areas_far_from_the_origin_keep_their_digits(spark):
    from pyspark.sql import functions as F

    x, y = 2.0**40, 2.0**41 + 3
    df = spark.createDataFrame([([[{"x": x + a, "y": y + b} for a, b in ((0, 0), (3, 0), (3, 1), (0, 1), (0, 0))]],), ([[]],), ([],)], f"rings {overlay.RINGS}")
    assert [r[0] for r in df.coalesce(1).select(overlay.total_area(F.col("rings"))).collect()] == [3.0, 0.0, 0.0]
