import json
import os
import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitespark.sources import geotiff, tiff
from sitespark.sources.geotiff import Grid


@pytest.mark.parametrize("seed", range(6))
def test_lzw_round_trip(seed):
    r = random.Random(seed)
    data = bytes(r.choice([0, 0, 0, 1, r.randrange(256)]) for _ in range(r.choice([0, 1, 500, 70_000])))
    assert tiff.lzw_decode(tiff.lzw_encode(data)) == data


def test_lzw_of_another_writer():
    """The example of the TIFF 6.0 specification: 7 7 7 8 8 7 7 6 6 as codes 256 7 258 8 8 258 6 6 257 of 9 bits."""
    codes = [256, 7, 258, 8, 8, 258, 6, 6, 257]
    bits = "".join(f"{c:09b}" for c in codes)
    data = bytes(int(bits[i : i + 8].ljust(8, "0"), 2) for i in range(0, len(bits), 8))
    assert tiff.lzw_decode(data) == bytes([7, 7, 7, 8, 8, 7, 7, 6, 6]) and tiff.lzw_encode(bytes([7, 7, 7, 8, 8, 7, 7, 6, 6])) == data


def test_packbits():
    assert tiff.packbits_decode(bytes([0xFE, 0xAA, 0x02, 0x80, 0x00, 0x2A, 0xFD, 0xAA, 0x80])) == bytes([0xAA] * 3 + [0x80, 0, 0x2A] + [0xAA] * 4)


def opened(data):
    return tiff.Tiff(lambda at, n: data[at : at + n])


def pixels_of(image):
    out = np.zeros((image.height, image.width), image.dtype.newbyteorder("="))
    return out, image.blocks((0, image.height), (0, image.width))


@pytest.mark.parametrize("dtype", ["uint8", "int16", "uint32", "float32", "float64"])
@pytest.mark.parametrize("compress,predictor", [("none", 1), ("lzw", 1), ("deflate", 1), ("lzw", 2), ("deflate", 2)])
def test_encoded_blocks(dtype, compress, predictor):
    if predictor == 2 and dtype[0] == "f":
        return
    a = (np.random.default_rng(1).integers(0, 200, (70, 131)) // 10).astype(dtype)
    data = tiff.encode(a, (1000.0, 5000.0, 30.0, 20.0), 5070, 7, compress, predictor, tile=32)
    image = opened(data)
    assert image.transform == (1000.0, 5000.0, 30.0, 20.0) and image.epsg == 5070 and image.nodata == 7
    out, blocks = pixels_of(image)
    for r, c, at, n in blocks:
        part = image.decode(data[at : at + n], r, c)
        out[r : r + part.shape[0], c : c + part.shape[1]] = part
    assert (out == a).all()


def strips(a, order=">", big=False, predictor=1, rows=16):
    """A striped file of the other byte order, or a BigTIFF, built here field by field."""
    high, wide = a.shape
    kind = a.dtype.newbyteorder(order)
    parts = []
    for r in range(0, high, rows):
        block = a[r : r + rows].astype(kind)
        if predictor == 3:
            size = kind.itemsize
            planes = block.astype(f">f{size}").view(np.uint8).reshape(len(block), wide, size).transpose(0, 2, 1).reshape(len(block), -1)
            raw = np.diff(planes, axis=1, prepend=np.zeros((len(block), 1), np.uint8)).astype(np.uint8).tobytes()
        else:
            raw = block.tobytes()
        parts.append(zlib.compress(raw))
    at, offsets = 16, []
    body = b""
    for p in parts:
        offsets.append(at + len(body))
        body += p
    tags = [(256, 3, [wide]), (257, 3, [high]), (258, 3, [kind.itemsize * 8]), (259, 3, [8]), (273, 16 if big else 4, offsets), (277, 3, [1]), (278, 3, [rows]), (279, 4, [len(p) for p in parts]), (317, 3, [predictor]), (339, 3, [{"u": 1, "i": 2, "f": 3}[kind.kind]])]
    sizes = {3: "H", 4: "I", 16: "Q"}
    room, extra = 8 if big else 4, at + len(body)
    entries = b""
    for tag, k, values in tags:
        raw = struct.pack(f"{order}{len(values)}{sizes[k]}", *values)
        if len(raw) > room:
            body += raw
            raw, extra = struct.pack(order + ("Q" if big else "I"), extra), extra + len(raw)
        entries += struct.pack(order + "HH" + ("Q" if big else "I"), tag, k, len(values)) + raw.ljust(room, b"\0")
    mark = b"MM" if order == ">" else b"II"
    head = mark + (struct.pack(order + "HHHQ", 43, 8, 0, extra) if big else struct.pack(order + "HI", 42, extra)).ljust(14, b"\0")
    return head + body + struct.pack(order + ("Q" if big else "H"), len(tags)) + entries + bytes(8)


@pytest.mark.parametrize("order,big,dtype,predictor", [(">", False, "int16", 1), ("<", True, "uint16", 1), (">", True, "float32", 3), ("<", False, "float64", 3)])
def test_other_files(spark, tmp_path, order, big, dtype, predictor):
    a = (np.random.default_rng(3).integers(0, 999, (45, 20)) / 4).astype(dtype)
    (tmp_path / "x.tif").write_bytes(strips(a, order, big, predictor))
    got = {(r["row"], r["col"]): r["value"] for r in geotiff.read_raster(spark, str(tmp_path / "x.tif")).collect()}
    assert got == {(i, j): float(a[i, j]) for i in range(45) for j in range(20)}


GRID = Grid(100_000.0, 900_000.0, 30.0, 30.0, "int32", -1, 5070)


@pytest.fixture(scope="module")
def raster(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raster") / "r")
    df = spark.range(300 * 500).select((F.col("id") / 500).cast("long").alias("row"), (F.col("id") % 500).alias("col"), (F.col("id") * 7919 % 1009).alias("value")).repartition(5)
    geotiff.write_raster(df.filter("value != 5"), path, GRID, block=128, compress="lzw", predictor=2)
    return path


def expected(rows, cols):
    return {(i, j): (None if (v := (i * 500 + j) * 7919 % 1009) == 5 else float(v)) for i in rows for j in cols}


def test_written_raster_reads_back(spark, raster):
    assert len([f for f in os.listdir(raster) if f.endswith(".tif")]) == 12 and "_temporary" not in os.listdir(raster)
    got = {(r["row"], r["col"]): r["value"] for r in geotiff.read_raster(spark, raster).collect()}
    assert got == expected(range(300), range(500))


def test_window_reads_its_tiles_only(spark, raster, tmp_path):
    """All blocks outside the window's are overwritten: a scan of the window doesn't notice, one of everything fails."""
    import shutil

    broken = str(tmp_path / "broken")
    shutil.copytree(raster, broken)
    for f in json.loads(open(f"{broken}/_index.json").read())["files"]:
        data = bytearray(open(f"{broken}/{f['name']}", "rb").read())
        image = opened(bytes(data))
        for r, c, at, n in image.blocks((0, 999), (0, 999)):
            if not (f["row"] == 128 and f["col"] == 256):
                data[at : at + n] = b"\xff" * n
        open(f"{broken}/{f['name']}", "wb").write(data)
    df = geotiff.read_raster(spark, broken)
    got = df.filter("row >= 130 and row < 140 and col between 300 and 310")
    assert {(r["row"], r["col"]): r["value"] for r in got.collect()} == expected(range(130, 140), range(300, 311))
    by_place = df.filter((F.col("x") > 100_000 + 300 * 30) & (F.col("x") < 100_000 + 303 * 30) & (F.col("y") < 900_000 - 131 * 30) & (F.col("y") > 900_000 - 133 * 30))
    assert {(r["row"], r["col"]) for r in by_place.collect()} == {(i, j) for i in (131, 132) for j in (300, 301, 302)}
    option = geotiff.read_raster(spark, broken, xmin=109_100, xmax=109_200, ymin=896_000, ymax=896_050)
    assert 0 < option.count() < 60
    reader = geotiff.Reader(broken, {"xmin": 109_100.0, "xmax": 109_200.0, "ymin": 896_000.0, "ymax": 896_050.0}, 0)
    parts = reader.partitions()
    assert len(parts) == 1 and len(parts[0].blocks) == 1


def test_overwrite_and_failures(spark, tmp_path):
    path = str(tmp_path / "r")
    geotiff.write_raster(spark.sql("SELECT 0 AS row, 0 AS col, 1 AS value"), path, Grid(dtype="uint8"))
    geotiff.write_raster(spark.sql("SELECT 3 AS row, 2 AS col, CAST(NULL AS INT) AS value UNION ALL SELECT 3, 1, 9"), path, Grid(dtype="float32"))
    assert [(r["row"], r["col"], r["value"]) for r in geotiff.read_raster(spark, path).filter("value is not null").collect()] == [(3, 1, 9.0)]
    with pytest.raises(Exception, match="no number"):
        bad = spark.range(4).select(F.col("id").alias("row"), F.col("id").alias("col"), F.when(F.col("id") == 3, F.raise_error(F.lit("no number")).cast("double")).otherwise(1.0).alias("value"))
        geotiff.write_raster(bad, path, Grid())
    assert [(r["row"], r["col"]) for r in geotiff.read_raster(spark, path).filter("value is not null").collect()] == [(3, 1)]
    geotiff.write_raster(spark.createDataFrame([], "row long, col long, value double"), path, Grid())
    assert geotiff.read_raster(spark, path).count() == 0
    with pytest.raises(Exception, match="no GeoTIFF|No such file|nothing"):
        geotiff.read_raster(spark, str(tmp_path / "nothing")).count()
