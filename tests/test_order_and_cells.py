import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitespark.operators import raster, relational
from sitespark.sources import sinks


def test_numbered_whatever_the_order_column(spark):
    r = random.Random(1)
    rows = [(r.choice([None, *range(50)]), k) for k in range(3000)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(5)
    got = [(x["a"], x["b"]) for x in relational.numbered(df, [F.col("a"), F.col("b")]).orderBy("place").collect()]
    assert got == sorted(rows, key=lambda t: (t[0] is not None, t[0] or 0, t[1]))
    assert sorted(x["place"] for x in relational.numbered(df, [F.col("a")]).collect()) == list(range(3000))
    assert relational.numbered(df.limit(0), [F.col("a")]).count() == 0


def test_rises_over_gaps_and_nulls(spark):
    """Places far apart, so that most spans of them are empty: the row before is the row before."""
    rows = [(k * 100_003, None if k % 7 == 3 else (k * 37) % 11) for k in range(200)]
    got = {x["k"]: x["before"] for x in relational.rises(spark.createDataFrame(rows, "k long, v int").repartition(4), [F.col("k")], "v", 0.5, 9).collect()}
    want = {b[0]: a[1] for a, b in zip(rows, rows[1:]) if a[1] is not None and b[1] is not None and b[1] - a[1] > 0.5}
    assert got == want


def test_percentiles_are_exact(spark):
    r = random.Random(2)
    rows = [(r.choice(["a", "b", None]), r.choice([None, round(r.gauss(0, 9), 2)])) for _ in range(999)] + [("one", 5.0), ("none", None)]
    got = {x["g"]: (x["m"], x["p"], x["top"]) for x in relational.percentiles(spark.createDataFrame(rows, "g string, v double").repartition(3), ["g"], "v", {"m": 0.5, "p": 0.9, "top": 1.0}).collect()}
    for g in ("a", "b", None, "one"):
        v = [x for k, x in rows if k == g and x is not None]
        assert got[g] == pytest.approx(tuple(np.percentile(v, [50, 90, 100])))
    assert "none" not in got


@pytest.mark.parametrize("cell", [3, 8, 64])
def test_morphology_by_cells(spark, cell):
    """Against whole-image arrays; the image has a gap, and one tile is empty."""
    rng = np.random.default_rng(cell)
    image, on = np.ones((17, 20), bool), rng.random((17, 20)) < 0.8
    image[5:7, 3:9] = False
    on &= image

    def step(a, grow):
        wide = np.pad(a, 1)
        around = [wide[1 + i : 18 + i, 1 + j : 21 + j] for i in (-1, 0, 1) for j in (-1, 0, 1)]
        return np.logical_or.reduce(around) & image if grow else np.logical_and.reduce(around)

    frame = lambda a: spark.createDataFrame([(t, int(r) - 4, int(c)) for t in (1, 2) for r, c in np.argwhere(a)], "tile int, row int, col int")
    cells = lambda df: sorted((r["tile"], r["row"] + 4, r["col"]) for r in df.collect())
    want = lambda a: sorted((t, int(r), int(c)) for t in (1, 2) for r, c in np.argwhere(a))
    assert cells(raster.clean(frame(on), frame(image), cell=cell)) == want(step(step(step(step(on, False), True), True), False))
    assert cells(raster.dilate(frame(on), frame(image), cell=cell)) == want(step(on, True))
    assert cells(raster.erode(frame(on), cell=cell)) == want(step(on, False))
    assert raster.clean(frame(on).limit(0), frame(image)).count() == 0


def test_overwrites_keep_a_table_at_the_path(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    for k in range(3):
        got = sinks.overwrite_in_place(spark.read.parquet(path).withColumn("id", F.col("id") + 1), path)
        assert sorted(r["id"] for r in got.collect()) == [k + 1, k + 2, k + 3]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["t", "t.backup"] and sorted(r["id"] for r in spark.read.parquet(path + ".backup").collect()) == [0, 1, 2]


@pytest.mark.parametrize("diagonal", [True, False])
@pytest.mark.parametrize("cell", [4, 9, 64])
def test_components_by_cells(spark, cell, diagonal):
    """Against a flood fill; two tiles, three groups of which one is null."""
    rng = np.random.default_rng(cell)
    grids = {t: rng.integers(0, 4, (21, 18)) for t in (1, 2)}
    grids[2][:, 3:15] = 1  # one component over many cells
    rows = [(t, int(r) - 5, int(c), None if g[r, c] == 3 else int(g[r, c])) for t, g in grids.items() for r, c in np.argwhere(g > 0)]
    steps = raster.EIGHT if diagonal else raster.FOUR
    got = {(x["tile"], x["row"], x["col"]): (x["cls"], x["component"]) for x in raster.components(spark.createDataFrame(rows, "tile int, row int, col int, cls int"), steps, cell=cell).collect()}
    kind, seen = {(t, r, c): k for t, r, c, k in rows}, {}
    for start in sorted(kind):
        if start in seen:
            continue
        todo, seen[start] = [start], start[1] * (1 << 20) + start[2]
        while todo:
            t, r, c = todo.pop()
            for dr, dc in steps:
                near = (t, r + dr, c + dc)
                if near in kind and near not in seen and kind[near] == kind[start]:
                    seen[near] = seen[start]
                    todo.append(near)
    assert got == {p: (kind[p], seen[p]) for p in kind}


def test_components_of_nothing(spark):
    assert raster.components(spark.createDataFrame([], "tile int, row int, col int, cls int")).count() == 0
