"""Readers for vector, sheet and paged JSON files. Rows are made on the executors; geometry arrives as rings."""

from __future__ import annotations

import io
import re
import struct
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RINGS = "array<array<struct<x:double,y:double>>>"


def geojson(spark: SparkSession, path: str, properties: str = "map<string,string>") -> DataFrame:
    """Features of GeoJSON files: properties, kind, rings (of polygons and lines; points make a ring of one vertex)."""
    schema = f"features array<struct<properties:{properties},geometry:struct<type:string,coordinates:string>>>"
    rows = spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode("features").alias("f"))
    return rows.select("f.properties", F.col("f.geometry.type").alias("kind"), rings_of(F.col("f.geometry.type"), F.col("f.geometry.coordinates")).alias("rings"))


def rings_of(kind: Column, text: Column) -> Column:
    """Rings from the JSON text of coordinates."""
    def pts(a):
        return F.transform(a, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))

    point = F.array(pts(F.array(F.from_json(text, "array<double>"))))
    line = F.array(pts(F.from_json(text, "array<array<double>>")))
    area = F.transform(F.from_json(text, "array<array<array<double>>>"), pts)
    many = F.transform(F.flatten(F.from_json(text, "array<array<array<array<double>>>>")), pts)
    return F.when(kind == "Point", point).when(kind.isin("LineString", "MultiPoint"), line).when(kind.isin("Polygon", "MultiLineString"), area).when(kind == "MultiPolygon", many)


def esri_json(spark: SparkSession, path: str) -> DataFrame:
    """Features of Esri JSON pages: attributes and rings."""
    schema = "features array<struct<attributes:map<string,string>,geometry:struct<rings:array<array<array<double>>>>>>"
    rows = spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode("features").alias("f"))
    return rows.select("f.attributes", F.transform("f.geometry.rings", lambda r: F.transform(r, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))).alias("rings"))


def overpass(spark: SparkSession, path: str) -> DataFrame:
    """Elements of an OpenStreetMap answer: a node's place, or the centre of a way."""
    schema = "elements array<struct<id:bigint,type:string,lat:double,lon:double,center:struct<lat:double,lon:double>,tags:map<string,string>>>"
    rows = spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode("elements").alias("e"))
    return rows.select("e.id", "e.type", F.coalesce("e.lon", "e.center.lon").alias("lon"), F.coalesce("e.lat", "e.center.lat").alias("lat"), "e.tags")


def _shapes(data: bytes) -> Iterator[list | None]:
    at = 100
    while at + 8 <= len(data):
        size = struct.unpack(">i", data[at + 4 : at + 8])[0] * 2
        body = data[at + 8 : at + 8 + size]
        at += 8 + size
        kind = struct.unpack("<i", body[:4])[0]
        if kind in (1, 11, 21):
            x, y = struct.unpack("<dd", body[4:20])
            yield [[{"x": x, "y": y}]]
        elif kind in (3, 5, 13, 15, 23, 25):
            parts, points = struct.unpack("<ii", body[36:44])
            starts = [*struct.unpack(f"<{parts}i", body[44 : 44 + 4 * parts]), points]
            xy = struct.unpack(f"<{2 * points}d", body[44 + 4 * parts : 44 + 4 * parts + 16 * points])
            yield [[{"x": xy[2 * i], "y": xy[2 * i + 1]} for i in range(a, b)] for a, b in zip(starts[:-1], starts[1:], strict=True)]
        else:
            yield None


def _attributes(data: bytes) -> Iterator[dict]:
    n, head, size = struct.unpack("<ihh", data[4:12])
    fields, at = [], 32
    while data[at] != 0x0D:
        fields.append((data[at : at + 11].split(b"\0")[0].decode("latin-1"), data[at + 16]))
        at += 32
    for k in range(n):
        row, at, out = data[head + k * size : head + (k + 1) * size], 1, {}
        for name, width in fields:
            out[name] = row[at : at + width].decode("utf-8", "replace").strip() or None
            at += width
        yield out


def zipped_shapefile(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the shapefile in each ZIP archive: properties (text) and rings."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch.content:
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for name in sorted(n for n in z.namelist() if n.lower().endswith(".shp")):
                        dbf = next((n for n in z.namelist() if n.lower() == name.lower()[:-4] + ".dbf"), None)
                        shapes = list(_shapes(z.read(name)))
                        rows = list(_attributes(z.read(dbf))) if dbf else [{}] * len(shapes)
                        yield pd.DataFrame({"properties": rows, "rings": shapes})

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(read, f"properties map<string,string>, rings {RINGS}")


_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}


def sheet_rows(content: bytes, sheet: int | str = 0) -> Iterator[list[str | None]]:
    """Rows of an .xlsx sheet, by place or name, as text."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in s.iter(f"{{{_NS['m']}}}t")) for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", _NS)]
        names = [s.get("name") for s in ElementTree.fromstring(z.read("xl/workbook.xml")).find("m:sheets", _NS)]
        place = names.index(sheet) if isinstance(sheet, str) else sheet
        for row in ElementTree.fromstring(z.read(f"xl/worksheets/sheet{place + 1}.xml")).iter(f"{{{_NS['m']}}}row"):
            out: list[str | None] = []
            for c in row.findall("m:c", _NS):
                letters = re.match("[A-Z]+", c.get("r") or "")
                at = sum((ord(x) - 64) * 26**i for i, x in enumerate(reversed(letters.group()))) - 1 if letters else len(out)
                out += [None] * (at - len(out))
                v = c.find("m:v", _NS)
                text = "".join(t.text or "" for t in c.iter(f"{{{_NS['m']}}}t")) if c.get("t") == "inlineStr" else v.text if v is not None else None
                out.append(shared[int(text)] if c.get("t") == "s" and text is not None else text)
            yield out


def xlsx(spark: SparkSession, path: str, columns: list[str], sheet: int | str = 0, skip: int = 1, id_pattern: str | None = None) -> DataFrame:
    """A sheet of each workbook by position, as text, after `skip` rows; id_pattern keeps rows whose first cell matches."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch.content:
                rows = [(r + [None] * len(columns))[: len(columns)] for r in list(sheet_rows(content, sheet))[skip:]]
                yield pd.DataFrame(rows, columns=columns, dtype=object)

    out = spark.read.format("binaryFile").load(path).select("content").mapInPandas(read, ", ".join(f"`{c}` string" for c in columns))
    return out.filter(F.col(columns[0]).rlike(id_pattern)) if id_pattern else out


def lattice(spark: SparkSession, xmin: float, ymin: float, xmax: float, ymax: float, step: float) -> DataFrame:
    """Points of an aligned lattice over a box."""
    a, b = int(xmin // step), int(-(-xmax // step))
    c, d = int(ymin // step), int(-(-ymax // step))
    rows = spark.range(a, b + 1).select((F.col("id") * step).alias("x"))
    return rows.withColumn("y", F.explode(F.sequence(F.lit(c), F.lit(d)))).withColumn("y", F.col("y") * step)


def wkb_rings(wkb: Column) -> Column:
    """Rings of WKB points, lines, polygons and their collections."""

    @F.pandas_udf(RINGS)
    def decode(values: pd.Series) -> pd.Series:
        return values.map(lambda b: None if b is None else _wkb(bytes(b), 0)[0])

    return decode(wkb)


def _wkb(b: bytes, at: int) -> tuple[list, int]:
    e = "<" if b[at] else ">"
    kind = struct.unpack_from(e + "I", b, at + 1)[0] & 0xFF
    at += 5

    def run(n: int, at: int):
        xy = struct.unpack_from(f"{e}{2 * n}d", b, at)
        return [{"x": xy[2 * i], "y": xy[2 * i + 1]} for i in range(n)], at + 16 * n

    if kind == 1:
        ring, at = run(1, at)
        return [ring], at
    n = struct.unpack_from(e + "I", b, at)[0]
    at += 4
    if kind == 2:
        ring, at = run(n, at)
        return [ring], at
    out = []
    for _ in range(n):
        if kind == 3:
            m = struct.unpack_from(e + "I", b, at)[0]
            ring, at = run(m, at + 4)
            out.append(ring)
        else:
            rings, at = _wkb(b, at)
            out += rings
    return out, at


def ring_wkb(rings: Column) -> Column:
    """WKB of a polygon's rings."""

    @F.pandas_udf("binary")
    def encode(values: pd.Series) -> pd.Series:
        def one(rings):
            if rings is None:
                return None
            return struct.pack("<BII", 1, 3, len(rings)) + b"".join(struct.pack("<I", len(r)) + b"".join(struct.pack("<dd", p["x"], p["y"]) for p in r) for r in rings)

        return values.map(one)

    return encode(rings)
