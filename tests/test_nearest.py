import random

import pytest

from sitespark.operators import spatial


@pytest.mark.parametrize("most", [1, 8])
def test_nearest_however_far(spark, most):
    """Clusters, repeated places, ties, rows far outside and rows without a place."""
    r = random.Random(most)
    right = [(k, *(round(c + r.gauss(0, s), 1) for c in r.choice([(0, 0), (1000, 1000), (-4000, 50)]))) for k in range(300) for s in [r.choice([0.5, 30])]]
    right += [(1000 + k, 7.0, 7.0) for k in range(40)] + [(5000, None, 1.0), (5001, 100.0, 0.0), (5002, -100.0, 0.0)]
    left = [(k, r.uniform(-5000, 5000), r.uniform(-5000, 5000)) for k in range(150)] + [(900, 1e7, -1e7), (901, None, 3.0), (902, 7.0, 7.0), (903, 1000.3, 1000.1)]
    got = {x["k"]: (x["d2"], x["a"]) for x in spatial.nearest(spark.createDataFrame(left, "k long, x double, y double"), spark.createDataFrame(right, "a long, u double, v double"), "k", "a", "x", "y", "u", "v", 40.0, most=most).collect()}
    assert len(got) == len(left)
    for k, x, y in left:
        if x is None:
            assert got[k] == (None, None)
        else:
            want = min((((x - u) ** 2 + (y - v) ** 2), a) for a, u, v in right if u is not None)
            assert got[k][1] == want[1] and got[k][0] == pytest.approx(want[0])


def test_leaves_are_bounded_and_plans_don_t_grow(spark):
    r = random.Random(3)
    df = spark.createDataFrame([(k, r.gauss(0, 1) if k % 3 else r.gauss(500, 0.001), r.gauss(0, 1)) for k in range(3000)], "a long, u double, v double")
    nodes, leaves, _ = spatial.quadtree(df, "u", "v", 20, 24)
    assert leaves.count() == 3000 and leaves.groupBy("level", "ix", "iy").count().agg({"count": "max"}).first()[0] <= 20
    far = spark.createDataFrame([(k, 1e4 * k, -1e4) for k in range(20)], "k long, x double, y double")
    plan = spatial.nearest(far, df, "k", "a", "x", "y", "u", "v", 1.0, most=20)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= 8


def test_nothing_to_find(spark):
    left = spark.createDataFrame([(1, 0.0, 0.0)], "k long, x double, y double")
    none = spark.createDataFrame([], "a long, u double, v double")
    assert [tuple(r) for r in spatial.nearest(left, none, "k", "a", "x", "y", "u", "v", 1.0).collect()] == [(1, 0.0, 0.0, None, None)]
    assert spatial.nearest(left.limit(0), none, "k", "a", "x", "y", "u", "v", 1.0).count() == 0
