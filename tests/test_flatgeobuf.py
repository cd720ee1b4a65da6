import glob
import json
import os
import random
import shutil
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitespark.functions import geometry, parts
from sitespark.functions.hilbert import hilbert
from sitespark.sources import flatgeobuf as fgb


def shapes(spark, n=3000):
    k = F.col("id")
    x, y = k * 7919 % 100003, k * 104729 % 99991
    return spark.range(n).select("id", F.concat(F.lit("é-"), k.cast("string")).alias("name"), F.when(k % 3 > 0, k / 7).alias("value"), (k % 2 == 0).alias("even"), F.array(geometry.box_ring(x, y, x + 1 + k % 50, y + 1 + k % 70)).alias("rings")).repartition(3)


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("fgb") / "t")
    fgb.write_shapes(shapes(spark), path, most=500, files=3)
    return path


def plain(df):
    return {(r["id"], r["name"], r["value"], r["even"], tuple((p["x"], p["y"]) for ring in r["rings"] for p in ring)) for r in df.collect()}


def test_round_trip(spark, written):
    df = fgb.read_shapes(spark, written)
    assert [f.dataType.simpleString() for f in df.schema][:4] == ["bigint", "string", "double", "boolean"]
    assert plain(df) == plain(shapes(spark)) and df.count() == 3000
    index = json.load(open(f"{written}/_index.json"))
    assert sum(f["count"] for f in index["files"]) == 3000 and len(index["files"]) >= 6 and "_temporary" not in os.listdir(written)


@pytest.mark.parametrize("box", [(0, 0, 100003, 99991), (20_000, 20_000, 26_000, 27_000), (50_000.5, 3, 50_000.5, 90_000), (-9, -9, -1, -1)])
def test_boxes(spark, written, box):
    want = shapes(spark).withColumn("b", geometry.bounds(F.flatten("rings"))).filter((F.col("b.xmin") <= box[2]) & (F.col("b.ymin") <= box[3]) & (F.col("b.xmax") >= box[0]) & (F.col("b.ymax") >= box[1]))
    assert plain(fgb.read_shapes(spark, written, box)) == plain(want)
    pushed = fgb.read_shapes(spark, written).filter((F.col("xmin") <= box[2]) & (F.col("ymin") <= box[3]) & (F.col("xmax") >= box[0]) & (F.col("ymax") >= box[1]))
    assert plain(pushed) == plain(want)


def test_small_files_are_read_together(spark, written):
    """A task for some megabytes, not for each file; and bounds of all shapes at once, of those without points too."""
    inf = float("inf")
    (part,) = fgb.Reader(written, [-inf, -inf, inf, inf]).partitions()
    assert len(part.files) >= 6 and fgb.read_shapes(spark, written).rdd.getNumPartitions() == 1
    assert [len(p.files) for p in fgb.together([("a", 3 << 20), ("b", 1 << 20), ("c", 1), ("d", 9 << 20)], ())] == [2, 1, 1] and fgb.together([], ())[0].files == []
    box = np.array([(1, 2), (5, 2), (5, 9), (1, 2)], float)
    assert fgb.bounds_of([[], [box], [box[:0]], [box[:0], box, box + 1]]).tolist()[1::2] == [[1, 2, 5, 9], [1, 2, 6, 10]] and np.isnan(fgb.bounds_of([[], [box]])[0]).all()


class Counted:
    """Bytes read of a file."""

    def __init__(self, path):
        self.data, self.n = open(path, "rb").read(), 0

    def __call__(self, at, n):
        self.n += len(self.data[at : at + n])
        return self.data[at : at + n]


def test_a_box_reads_a_fraction_of_the_bytes(spark, tmp_path):
    path = str(tmp_path / "one")
    fgb.write_shapes(shapes(spark, 20_000), path, files=1)
    (name,) = glob.glob(f"{path}/*.fgb")
    read = Counted(name)
    file = fgb.File(read, len(read.data))
    reader = fgb.Reader(path, [])
    box = (40_000, 40_000, 43_000, 43_000)
    hits = [raw for data in reader._wanted(file, read, box) for raw in data]
    assert 5 < len(hits) < 60 and read.n < len(read.data) / 20


def test_files_outside_are_not_opened(spark, written, tmp_path):
    """Files whose bounds miss the box are replaced by noise."""
    copy = str(tmp_path / "copy")
    shutil.copytree(written, copy)
    box, spoilt = (20_000, 20_000, 26_000, 27_000), 0
    for f in json.load(open(f"{copy}/_index.json"))["files"]:
        b = f["bounds"]
        if not (b[0] <= box[2] and b[1] <= box[3] and b[2] >= box[0] and b[3] >= box[1]):
            open(f"{copy}/{f['name']}", "wb").write(b"noise")
            spoilt += 1
    assert spoilt and plain(fgb.read_shapes(spark, copy, box)) == plain(fgb.read_shapes(spark, written, box))


def test_tree_by_its_definition():
    """Any level's node bounds the sixteen nodes it points to, and leaves point to features in order."""
    r = np.random.default_rng(5)
    for n in (1, 2, 16, 17, 257, 4100):
        low = r.uniform(0, 100, (n, 2))
        boxes = np.hstack([low, low + r.uniform(0, 5, (n, 2))])
        nodes = np.frombuffer(fgb.tree_bytes(boxes, np.arange(n) * 10), fgb.NODE)
        levels = fgb.level_sizes(n)
        assert len(nodes) == sum(levels) and (nodes["offset"][-n:] == np.arange(n) * 10).all()
        for i, node in enumerate(nodes[:-n]):
            kids = nodes[node["offset"] : node["offset"] + 16]
            level_end = np.cumsum(levels[::-1])
            k = int(np.searchsorted(level_end, i, "right"))
            kids = nodes[node["offset"] : min(node["offset"] + 16, level_end[k + 1])]
            assert node["xmin"] == kids["xmin"].min() and node["ymax"] == kids["ymax"].max() and node["xmax"] == kids["xmax"].max()
        for _ in range(20):
            x, y = r.uniform(-5, 105, 2)
            box = (x, y, x + r.uniform(0, 20), y + r.uniform(0, 20))
            want = np.flatnonzero((boxes[:, 0] <= box[2]) & (boxes[:, 1] <= box[3]) & (boxes[:, 2] >= box[0]) & (boxes[:, 3] >= box[1]))
            got = fgb.search(lambda a, m: nodes[a : a + m], n, box, 16)
            assert got[:, 0].tolist() == want.tolist() and (got[:, 1] == want * 10).all()


def test_header_fields_by_hand(written):
    """The parts of a file that other programs look at, read with struct alone."""
    told = json.load(open(f"{written}/_index.json"))["files"][0]
    data = open(f"{written}/{told['name']}", "rb").read()
    assert data[:8] == b"fgb\x03fgb\x00"
    (size,) = struct.unpack_from("<I", data, 8)
    root = 12 + struct.unpack_from("<I", data, 12)[0]
    table = root - struct.unpack_from("<i", data, root)[0]
    slot = lambda k: struct.unpack_from("<H", data, table + 4 + 2 * k)[0]
    assert struct.unpack_from("<Q", data, root + slot(8))[0] == told["count"] > 0 and struct.unpack_from("<H", data, root + slot(9))[0] == 16
    assert 12 + size < len(data) and (12 + size) % 4 == 0


def test_odd_shapes(spark, tmp_path):
    path, box = str(tmp_path / "odd"), lambda x, n: geometry.box_ring(F.lit(x), F.lit(x), F.lit(x + n), F.lit(x + n))
    df = spark.range(1).select(F.explode(F.array(F.struct(F.lit(1).alias("k"), F.array(box(0, 10), box(2, 3), box(20, 5), box(3, 1)).alias("rings")), F.struct(F.lit(2).alias("k"), F.lit(None).cast(fgb.RINGS).alias("rings")), F.struct(F.lit(None).alias("k"), F.array().cast(fgb.RINGS).alias("rings")))).alias("s")).select("s.*")
    fgb.write_shapes(df.select("k", "rings", F.array("k").alias("list")), path)
    got = {r["k"]: r for r in fgb.read_shapes(spark, path).collect()}
    assert len(got) == 3 and got[2]["rings"] == [] and got[1]["list"] == "[1]" and got[1]["xmax"] == 25.0
    areas = sorted(parts.twice_area(np.array([(p["x"], p["y"]) for p in r])) / 2 for r in got[1]["rings"])
    assert areas == [-9.0, 1.0, 25.0, 100.0]  # the hole runs the other way, the island in it is a part
    assert fgb.read_shapes(spark, path, (21, 21, 22, 22)).count() == 1
    empty = str(tmp_path / "empty")
    fgb.write_shapes(df.filter("k > 9"), empty)
    assert fgb.read_shapes(spark, empty).count() == 0 and fgb.read_shapes(spark, empty).columns == ["k", "xmin", "ymin", "xmax", "ymax", "rings"]


def test_hilbert_neighbours(spark):
    """The curve visits each cell of a 16 x 16 square once, going from cell to neighbouring cell."""
    rows = spark.range(256).select((F.col("id") % 16).alias("x"), F.expr("id div 16").alias("y")).select("x", "y", hilbert(F.col("x"), F.col("y"), 0, 0, 15, 15, 4).alias("h")).orderBy("h").collect()
    assert [r["h"] for r in rows] == list(range(256))
    assert all(abs(a["x"] - b["x"]) + abs(a["y"] - b["y"]) == 1 for a, b in zip(rows, rows[1:]))


def test_interior_points_are_inside():
    r = random.Random(2)
    for _ in range(200):
        n, c = r.randrange(3, 12), (r.uniform(-9, 9), r.uniform(-9, 9))
        ring = [(c[0] + d * np.cos(a), c[1] + d * np.sin(a)) for a, d in zip(sorted(r.uniform(0, 6.28) for _ in range(n)), (r.uniform(0.1, 5) for _ in range(n)))]
        ring = np.array([*ring, ring[0]])
        p = parts.scan_point([ring])
        assert p is not None and parts.holds(ring, np.array(p))
    square, hole = np.array([(0, 0), (9, 0), (9, 9), (0, 9), (0, 0)], float), np.array([(1, 1), (8, 1), (8, 8), (1, 8), (1, 1)], float)
    x, y = parts.scan_point([square, hole])
    assert not (1 <= x <= 8 and 1 <= y <= 8) and parts.scan_point([]) is None
