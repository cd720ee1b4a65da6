"""File geodatabase layers as a Spark data source: tables of a .gdb folder, read by blocks of 1,024 rows.

A table is a file of rows (.gdbtable) and a file of their places (.gdbtablx), which lists them in blocks of 1,024; a task reads
some blocks. index_blocks writes the bounds of each block's shapes with a Spark job; a read with that index and a box (options
xmin, ymin, xmax, ymax, or comparisons of the columns of that name) plans only tasks for blocks that meet it, and skips the other rows'
shapes by the bounds in front of them.
"""

from __future__ import annotations

import datetime
import json
import math
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.overlay import packed
from .flatgeobuf import BOX, RINGS_TYPE
from .flatgeobuf import Reader as BoxReader
from .stores import Store

BLOCK = 1024
#: Field types of the format, and the Spark types they are read as: fixed values.
SHORT, LONG, SINGLE, DOUBLE, STRING, DATE, OBJECT_ID, GEOMETRY, BINARY, UUID, GLOBAL_ID, XML = 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 11, 12
TYPES = {SHORT: T.IntegerType(), LONG: T.IntegerType(), SINGLE: T.FloatType(), DOUBLE: T.DoubleType(), STRING: T.StringType(), DATE: T.TimestampType(), BINARY: T.BinaryType(), UUID: T.StringType(), GLOBAL_ID: T.StringType(), XML: T.StringType()}
ARROW = {SHORT: pa.int32(), LONG: pa.int32(), SINGLE: pa.float32(), DOUBLE: pa.float64(), STRING: pa.string(), DATE: pa.timestamp("us", "UTC"), BINARY: pa.binary(), UUID: pa.string(), GLOBAL_ID: pa.string(), XML: pa.string()}
FIXED = {SHORT: "<h", LONG: "<i", SINGLE: "<f", DOUBLE: "<d", DATE: "<d"}
#: Dates are days from here.
EPOCH = datetime.datetime(1899, 12, 30, tzinfo=datetime.UTC)


class Bytes:
    """A place in bytes, and the format's integers: seven bits a byte, the lowest first; signed ones have the sign in the
    second bit of the first byte."""

    def __init__(self, data: bytes, at: int = 0):
        self.data, self.at = data, at

    def unsigned(self) -> int:
        value = shift = 0
        while True:
            b = self.data[self.at]
            self.at += 1
            value |= (b & 127) << shift
            if b < 128:
                return value
            shift += 7

    def signed(self) -> int:
        b = self.data[self.at]
        self.at += 1
        negative, value, shift = b & 64, b & 63, 6
        while b >= 128:
            b = self.data[self.at]
            self.at += 1
            value |= (b & 127) << shift
            shift += 7
        return -value if negative else value

    def take(self, n: int) -> bytes:
        self.at += n
        return self.data[self.at - n : self.at]

    def get(self, form: str):
        return struct.unpack("<" + form, self.take(struct.calcsize("<" + form)))[0]

    def name(self) -> str:
        return self.take(2 * self.get("B")).decode("utf-16-le")


@dataclass
class Field:
    name: str
    kind: int
    nullable: bool


class Layer:
    """A table's fields and the scale of its coordinates, from the head of its .gdbtable."""

    def __init__(self, head: Bytes):
        b = Bytes(head.data, 32)
        b.at = b.get("q")
        self.end = b.at + 4 + Bytes(head.data, b.at).get("i")
        b.at += 8
        flags = b.get("I")
        self.utf8, self.fields, self.scale, self.origin = bool(flags & 256), [], 1.0, (0.0, 0.0)
        for _ in range(b.get("h")):
            name, _, kind = b.name(), b.name(), b.get("B")
            nullable = True
            if kind == OBJECT_ID:
                b.take(2)
                self.fields.append(Field(name, kind, False))
                continue
            if kind == GEOMETRY:
                b.take(1)
                nullable = bool(b.get("B") & 1)
                b.take(b.get("h"))
                more = b.get("B")
                self.origin, self.scale = (b.get("d"), b.get("d")), b.get("d")
                b.take(16 * bool(more & 2) + 16 * bool(more & 4) + 8 + 8 * bool(more & 2) + 8 * bool(more & 4) + 32)
                b.take(16 * bool(flags >> 31 & 1) + 16 * bool(flags >> 30 & 1))
                b.take(1)
                b.take(8 * b.get("i"))
            elif kind in (STRING, XML):
                b.take(4)
                flag = b.get("B")
                nullable = bool(flag & 1)
                b.take(b.unsigned() if flag & 4 else 1)  # a default value, or its length 0
            elif kind in (BINARY, UUID, GLOBAL_ID):
                b.take(1)
                nullable = bool(b.get("B") & 1)
            elif kind in FIXED:
                b.take(1)
                flag = b.get("B")
                nullable = bool(flag & 1)
                b.take(b.get("B"))
            else:
                raise ValueError(f"field {name}: type {kind} is not known")
            self.fields.append(Field(name, kind, nullable))
        self.id_name = next((f.name for f in self.fields if f.kind == OBJECT_ID), None)
        self.stored = [f for f in self.fields if f.kind != OBJECT_ID]
        self.plain = [f for f in self.stored if f.kind != GEOMETRY]

    def schema(self) -> T.StructType:
        own = [T.StructField(self.id_name, T.LongType())] if self.id_name else []
        shape = [*(T.StructField(c, T.DoubleType()) for c in BOX), T.StructField("rings", RINGS_TYPE)] if len(self.plain) < len(self.stored) else []
        return T.StructType(own + [T.StructField(f.name, TYPES[f.kind]) for f in self.plain] + shape)

    def row(self, raw: bytes) -> tuple[list, bytes | None]:
        """Values of the plain fields, and the shape's bytes."""
        n = sum(f.nullable for f in self.stored)
        nulls, b, k, values, shape = int.from_bytes(raw[: -(-n // 8)], "little"), Bytes(raw, -(-n // 8)), 0, [], None
        for f in self.stored:
            missing = f.nullable and nulls >> k & 1
            k += f.nullable
            if missing:
                value = None
            elif f.kind in FIXED:
                value = struct.unpack(FIXED[f.kind], b.take(struct.calcsize(FIXED[f.kind])))[0]
                value = EPOCH + datetime.timedelta(days=value) if f.kind == DATE else value
            elif f.kind in (UUID, GLOBAL_ID):
                u = b.take(16)
                value = "{%08X-%04X-%04X-%s-%s}" % (*struct.unpack("<IHH", u[:8]), u[8:10].hex().upper(), u[10:].hex().upper())
            else:
                value = b.take(b.unsigned())
                if f.kind in (STRING, XML):
                    value = value.decode("utf-8" if self.utf8 else "utf-16-le")
            if f.kind == GEOMETRY:
                shape = value
            else:
                values.append(value)
        return values, shape

    def bounds(self, shape: bytes | None) -> tuple[float, float, float, float] | None:
        head = self._head(shape)
        return head[1] if head else None

    def _head(self, shape: bytes | None):
        """(place behind the bounds, bounds, points, parts); for a point its place."""
        if not shape:
            return None
        b = Bytes(shape)
        kind = b.unsigned()
        (ox, oy), s = self.origin, self.scale
        if kind & 255 in (1, 9, 11, 21, 52):
            x, y = b.unsigned(), b.unsigned()
            return None if not x else (None, ((x - 1) / s + ox, (y - 1) / s + oy) * 2, 1, 1)
        points = b.unsigned()
        if not points:
            return None
        parts = 1 if kind & 255 in (8, 18, 20, 28, 53) else b.unsigned()
        if kind & 0x20000000:  # curves: their number; the vertices stand for them
            b.unsigned()
        x, y, w, h = (b.unsigned() for _ in range(4))
        return b, (x / s + ox, y / s + oy, (x + w) / s + ox, (y + h) / s + oy), points, parts

    def rings(self, shape: bytes | None) -> list[np.ndarray]:
        head = self._head(shape)
        if head is None:
            return []
        b, bounds, points, parts = head
        if b is None:
            return [np.array([bounds[:2]])]
        sizes = [b.unsigned() for _ in range(parts - 1)]
        sizes.append(points - sum(sizes))
        moves = np.array([b.signed() for _ in range(2 * points)], np.int64).reshape(-1, 2)
        at = np.cumsum(moves, axis=0) / self.scale + np.array(self.origin)
        return np.split(at, np.cumsum(sizes)[:-1])


class Table:
    """A table's two files."""

    def __init__(self, store: Store, number: int):
        self.store, self.rows, self.places = store, f"a{number:08x}.gdbtable", f"a{number:08x}.gdbtablx"
        (head,) = store.ranges(self.places, [(0, 16)])
        _, self.blocks, self.count, self.width = struct.unpack("<iiii", head)
        (head,) = store.ranges(self.rows, [(0, 40)])
        at = struct.unpack_from("<q", head, 32)[0]
        (size,) = store.ranges(self.rows, [(at, 4)])
        (data,) = store.ranges(self.rows, [(0, at + 4 + struct.unpack("<i", size)[0])])
        self.layer = Layer(Bytes(data))

    def block(self, k: int) -> Iterator[tuple[int, bytes]]:
        """(object id, row) of the rows that a block has."""
        n = min(BLOCK, self.count - k * BLOCK)
        (raw,) = self.store.ranges(self.places, [(16 + k * BLOCK * self.width, n * self.width)])
        offsets = [int.from_bytes(raw[i * self.width : (i + 1) * self.width], "little") for i in range(n)]
        live = sorted((o, k * BLOCK + i + 1) for i, o in enumerate(offsets) if o)
        with self.store.fs.open_input_file(self.store.at(self.rows)) as f:
            at = 0
            while at < len(live):  # rows that lie near one another are read together
                to = at
                while to + 1 < len(live) and live[to + 1][0] - live[at][0] < 4 << 20:
                    to += 1
                start, last = live[at][0], live[to][0]
                data = f.read_at(last - start + 4, start)
                data += f.read_at(struct.unpack_from("<i", data, last - start)[0], last + 4)
                for offset, number in live[at : to + 1]:
                    (size,) = struct.unpack_from("<i", data, offset - start)
                    yield number, data[offset - start + 4 : offset - start + 4 + size]
                at = to + 1


def layers(path: str) -> dict[str, int]:
    """The tables of a geodatabase and their numbers, from its catalogue, which is the first table."""
    catalogue = Table(Store(path), 1)
    at = [f.name.lower() for f in catalogue.layer.plain].index("name")
    return {catalogue.layer.row(raw)[0][at]: number for k in range(-(-catalogue.count // BLOCK)) for number, raw in catalogue.block(k)}


@dataclass
class Part(InputPartition):
    blocks: list
    box: tuple


class Reader(DataSourceReader):
    def __init__(self, path: str, layer: str, box: list[float], index: str | None, blocks: int):
        self.path, self.number, self.box, self.index, self.blocks = path, layers(path)[layer], box, index, blocks

    pushFilters = BoxReader.pushFilters

    def partitions(self) -> list[Part]:
        table, box = Table(Store(self.path), self.number), tuple(self.box)
        wanted = range(-(-table.count // BLOCK))
        if self.index and box != (-math.inf, -math.inf, math.inf, math.inf):
            known = {int(k): b for k, b in json.loads(Store(self.index).all("")).items()}
            wanted = [k for k in wanted if k in known and known[k] and known[k][0] <= box[2] and known[k][1] <= box[3] and known[k][2] >= box[0] and known[k][3] >= box[1]]
        found = list(wanted)
        return [Part(found[i : i + self.blocks], box) for i in range(0, len(found), self.blocks)] or [Part([], box)]

    def read(self, part: Part) -> Iterator[pa.RecordBatch]:
        if not part.blocks:
            return
        table, box = Table(Store(self.path), self.number), part.box
        layer, shaped = table.layer, len(table.layer.plain) < len(table.layer.stored)
        everything = box == (-math.inf, -math.inf, math.inf, math.inf)
        for k in part.blocks:
            ids, values, bounds, rings = [], [], [], []
            for number, raw in table.block(k):
                plain, shape = layer.row(raw)
                b = layer.bounds(shape)
                if not everything and not (b and b[0] <= box[2] and b[1] <= box[3] and b[2] >= box[0] and b[3] >= box[1]):
                    continue
                ids.append(number)
                values.append(plain)
                bounds.append(b or (None,) * 4)
                rings.append(layer.rings(shape) if shaped else [])
            arrays = [pa.array(ids, pa.int64())] if layer.id_name else []
            arrays += [pa.array([v[i] for v in values], ARROW[f.kind]) for i, f in enumerate(layer.plain)]
            if shaped:
                arrays += [*(pa.array([b[i] for b in bounds], pa.float64()) for i in range(4)), packed(rings)]
            yield pa.RecordBatch.from_arrays(arrays, layer.schema().names)


class FileGdb(DataSource):
    @classmethod
    def name(cls) -> str:
        return "filegdb"

    def schema(self) -> T.StructType:
        return Table(Store(self.options["path"]), layers(self.options["path"])[self.options["layer"]]).layer.schema()

    def reader(self, schema) -> Reader:
        o = self.options
        box = [float(o.get(c, d)) for c, d in zip(BOX, (-math.inf, -math.inf, math.inf, math.inf), strict=True)]
        return Reader(o["path"], o["layer"], box, o.get("index"), int(o.get("blocks", 16)))


def read_layer(spark: SparkSession, path: str, layer: str, box: tuple[float, float, float, float] | None = None, index: str | None = None, blocks: int = 16) -> DataFrame:
    """A layer's rows: its object id, its fields, bounds (xmin, ymin, xmax, ymax) and rings; with a box those that meet it. blocks:
    how many blocks of 1,024 rows a task reads. Shapes without a point have null bounds and no ring; points are one place."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(FileGdb)
    options = {"layer": layer, "blocks": blocks} | (dict(zip(BOX, box, strict=True)) if box else {}) | ({"index": index} if index else {})
    return spark.read.format("filegdb").options(**options).load(path)


def index_blocks(spark: SparkSession, path: str, layer: str, to: str) -> None:
    """Write the bounds of each block's shapes as JSON; one row a block reaches the driver."""
    rows = read_layer(spark, path, layer)
    number = Table(Store(path), layers(path)[layer]).layer.id_name
    found = rows.groupBy(F.floor((F.col(number) - 1) / BLOCK).alias("block")).agg(F.min("xmin"), F.min("ymin"), F.max("xmax"), F.max("ymax")).collect()
    store, _, name = to.rpartition("/")
    Store(store).put(name, json.dumps({str(r[0]): None if r[1] is None else list(r[1:]) for r in found}).encode())
