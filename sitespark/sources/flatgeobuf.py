"""FlatGeobuf as a Spark data source: shapes along a Hilbert curve, a packed R-tree in every file, reads of a box only.

write_shapes(df, path, rings) sorts shapes by the Hilbert number of their centres into ranges, and each task writes a file of
its range: header, tree, features. The folder's index has each file's bounds, the level of the tree above the files. A read
with a box (options xmin, ymin, xmax, ymax, or comparisons of the columns of that name) leaves out files, then walks each file's tree
and reads the byte ranges of the features that it finds.
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
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

from ..functions import geometry
from ..functions.hilbert import hilbert
from ..functions.overlay import RINGS, packed, unpacked
from ..functions.parts import split
from ..operators.shared import checkpointed, spread
from .stores import INDEX, FolderWriter, Store, Written

#: The format's magic bytes, column types, geometry types and tree fan-out: fixed values.
MAGIC = bytes([0x66, 0x67, 0x62, 0x03, 0x66, 0x67, 0x62, 0x00])
BOOL, INT, LONG, FLOAT, DOUBLE, STRING, DATETIME, BINARY = 2, 5, 7, 9, 10, 11, 13, 14
POLYGON, MULTIPOLYGON = 3, 6
FANOUT = 16
NODE = np.dtype([("xmin", "<f8"), ("ymin", "<f8"), ("xmax", "<f8"), ("ymax", "<f8"), ("offset", "<u8")])
KINDS = {"boolean": BOOL, "integer": INT, "long": LONG, "float": FLOAT, "double": DOUBLE, "string": STRING, "timestamp": DATETIME, "binary": BINARY}
TYPES = {BOOL: T.BooleanType(), 0: T.IntegerType(), 1: T.IntegerType(), 3: T.IntegerType(), 4: T.IntegerType(), INT: T.IntegerType(), 6: T.LongType(), LONG: T.LongType(), 8: T.LongType(), FLOAT: T.FloatType(), DOUBLE: T.DoubleType(), STRING: T.StringType(), 12: T.StringType(), DATETIME: T.StringType(), BINARY: T.BinaryType()}
FORMATS = {0: "b", 1: "B", BOOL: "?", 3: "h", 4: "H", INT: "i", 6: "I", LONG: "q", 8: "Q", FLOAT: "f", DOUBLE: "d"}
BOX = ("xmin", "ymin", "xmax", "ymax")
#: Bytes between two wanted features that are read along rather than skipped.
NEAR = 4096
READ_BYTES = 32 << 20
#: Bytes of small files that a task reads.
TASK_BYTES = 4 << 20


class Buffer:
    """A flatbuffer written back to front: what is pushed first ends last."""

    def __init__(self):
        self.parts: list[bytes] = []
        self.n = 0

    def push(self, raw: bytes) -> None:
        self.parts.append(raw)
        self.n += len(raw)

    def pad(self, to: int, before: int = 0) -> None:
        if k := -(self.n + before) % to:
            self.push(bytes(k))

    def vector(self, raw: bytes, item: int, count: int) -> int:
        self.pad(max(4, item), len(raw))
        self.push(raw)
        self.push(struct.pack("<I", count))
        return self.n

    def string(self, s: str) -> int:
        raw = s.encode()
        self.pad(4, len(raw) + 1)
        self.push(raw + b"\0")
        self.push(struct.pack("<I", len(raw)))
        return self.n

    def references(self, to: list[int]) -> int:
        self.pad(4)
        for at in reversed(to):
            self.push(struct.pack("<I", self.n + 4 - at))
        self.push(struct.pack("<I", len(to)))
        return self.n

    def table(self, fields: dict[int, tuple[str, object]]) -> int:
        """fields: for an index a struct format and value; format "" is a reference."""
        start, at = self.n, {}
        for i, (kind, value) in sorted(fields.items(), key=lambda f: struct.calcsize("<" + (f[1][0] or "I"))):
            self.pad(struct.calcsize("<" + (kind or "I")))
            self.push(struct.pack("<" + kind, value) if kind else struct.pack("<I", self.n + 4 - value))
            at[i] = self.n
        self.pad(4)
        self.push(b"")
        place = len(self.parts) - 1
        self.n += 4
        table = self.n
        slots = max(at, default=-1) + 1
        raw = struct.pack(f"<HH{slots}H", 4 + 2 * slots, table - start, *(table - at[i] if i in at else 0 for i in range(slots)))
        self.pad(2, len(raw))
        self.push(raw)
        self.parts[place] = struct.pack("<i", self.n - table)
        return table

    def finish(self, root: int) -> bytes:
        """With its size before it."""
        self.pad(8, 8)
        self.push(struct.pack("<I", self.n + 4 - root))
        return struct.pack("<I", self.n) + b"".join(reversed(self.parts))


class Table:
    """A table of a flatbuffer."""

    def __init__(self, data: bytes, at: int):
        self.data, self.at = data, at
        self.slots = at - struct.unpack_from("<i", data, at)[0]
        self.size = struct.unpack_from("<H", data, self.slots)[0]

    @staticmethod
    def root(data: bytes, at: int = 0) -> Table:
        return Table(data, at + struct.unpack_from("<I", data, at)[0])

    def _field(self, i: int) -> int:
        if 4 + 2 * i >= self.size:
            return 0
        off = struct.unpack_from("<H", self.data, self.slots + 4 + 2 * i)[0]
        return self.at + off if off else 0

    def value(self, i: int, kind: str, default=None):
        at = self._field(i)
        return struct.unpack_from("<" + kind, self.data, at)[0] if at else default

    def _target(self, i: int) -> int:
        at = self._field(i)
        return at + struct.unpack_from("<I", self.data, at)[0] if at else 0

    def table(self, i: int) -> Table | None:
        at = self._target(i)
        return Table(self.data, at) if at else None

    def tables(self, i: int) -> list[Table]:
        at = self._target(i)
        n = struct.unpack_from("<I", self.data, at)[0] if at else 0
        places = [at + 4 + 4 * k for k in range(n)]
        return [Table(self.data, p + struct.unpack_from("<I", self.data, p)[0]) for p in places]

    def array(self, i: int, kind: str) -> np.ndarray:
        at = self._target(i)
        return np.frombuffer(self.data, kind, struct.unpack_from("<I", self.data, at)[0], at + 4) if at else np.empty(0, kind)

    def string(self, i: int, default: str = "") -> str:
        at = self._target(i)
        return self.data[at + 4 : at + 4 + struct.unpack_from("<I", self.data, at)[0]].decode() if at else default


def header_bytes(name: str, columns: list[tuple[str, int]], count: int, bounds: np.ndarray | None, epsg: int | None) -> bytes:
    b = Buffer()
    fields: dict = {2: ("B", 0), 8: ("Q", count), 9: ("H", FANOUT)}
    if epsg is not None:
        fields[10] = ("", b.table({0: ("", b.string("EPSG")), 1: ("i", epsg)}))
    fields[7] = ("", b.references([b.table({0: ("", b.string(n)), 1: ("B", kind)}) for n, kind in columns]))
    if bounds is not None:
        fields[1] = ("", b.vector(np.asarray(bounds, "<f8").tobytes(), 8, 4))
    fields[0] = ("", b.string(name))
    return b.finish(b.table(fields))


def geometry_table(b: Buffer, rings: list[np.ndarray]) -> int | None:
    parts = split(rings)
    if not parts:
        return None

    def one(part: list[np.ndarray]) -> int:
        xy = b.vector(np.concatenate(part).astype("<f8").tobytes(), 8, 2 * sum(map(len, part)))
        fields: dict = {1: ("", xy), 6: ("B", POLYGON)}
        if len(part) > 1:
            ends = np.cumsum([len(r) for r in part]).astype("<u4")
            fields[0] = ("", b.vector(ends.tobytes(), 4, len(ends)))
        return b.table(fields)

    return one(parts[0]) if len(parts) == 1 else b.table({7: ("", b.references([one(p) for p in parts])), 6: ("B", MULTIPOLYGON)})


def rings_of(g: Table | None) -> list[np.ndarray]:
    """Closed rings of polygons and multipolygons; other geometries as they are, one sequence each."""
    if g is None:
        return []
    if inner := g.tables(7):
        return [r for t in inner for r in rings_of(t)]
    xy, ends = g.array(1, "<f8").reshape(-1, 2), g.array(0, "<u4")
    return np.split(xy, ends[:-1]) if len(ends) > 1 else [xy] if len(xy) else []


def property_bytes(values: tuple, kinds: list[int]) -> bytes:
    out = []
    for i, (v, kind) in enumerate(zip(values, kinds, strict=True)):
        if v is None:
            continue
        out.append(struct.pack("<H", i))
        if kind in FORMATS:
            out.append(struct.pack("<" + FORMATS[kind], v))
        else:
            raw = v if kind == BINARY else (v.isoformat() if isinstance(v, datetime.datetime) else v).encode()
            out.append(struct.pack("<I", len(raw)) + raw)
    return b"".join(out)


def properties_of(raw: bytes, kinds: list[int]) -> list:
    values, at = [None] * len(kinds), 0
    while at < len(raw):
        (i,) = struct.unpack_from("<H", raw, at)
        at += 2
        kind = kinds[i]
        if kind in FORMATS:
            (values[i],) = struct.unpack_from("<" + FORMATS[kind], raw, at)
            at += struct.calcsize("<" + FORMATS[kind])
        else:
            (n,) = struct.unpack_from("<I", raw, at)
            text = raw[at + 4 : at + 4 + n]
            values[i] = bytes(text) if kind == BINARY else text.decode()
            at += 4 + n
    return values


def feature_bytes(rings: list[np.ndarray], values: tuple, kinds: list[int]) -> bytes:
    b = Buffer()
    raw = property_bytes(values, kinds)
    fields: dict = {1: ("", b.vector(raw, 1, len(raw)))} if raw else {}
    if (g := geometry_table(b, rings)) is not None:
        fields[0] = ("", g)
    return b.finish(b.table(fields))


def level_sizes(n: int, fanout: int = FANOUT) -> list[int]:
    """Nodes of each level, leaves first."""
    out = [n]
    while out[-1] > 1:
        out.append(-(-out[-1] // fanout))
    return out if n != 1 else [1, 1]


def tree_bytes(boxes: np.ndarray, offsets: np.ndarray) -> bytes:
    """The packed tree over leaves in order: levels from the root, a node's offset the place of its first child, or of its feature."""
    levels = level_sizes(len(boxes))
    starts = np.cumsum([0, *levels[:0:-1]])[::-1]  # of each level, leaves first
    nodes = np.zeros(sum(levels), NODE)
    low, high, refs = boxes[:, :2], boxes[:, 2:], offsets
    for k, (start, size) in enumerate(zip(starts, levels, strict=True)):
        level = nodes[start : start + size]
        level["xmin"], level["ymin"] = low.T
        level["xmax"], level["ymax"] = high.T
        level["offset"] = refs
        if k + 1 < len(levels):
            at = np.arange(0, size, FANOUT)
            low, high, refs = np.fmin.reduceat(low, at), np.fmax.reduceat(high, at), start + at
    return nodes.tobytes()


def search(read, count: int, box: tuple[float, float, float, float], fanout: int) -> np.ndarray:
    """The leaves (place, offset) that meet the box; read(first, n) gives nodes of the tree. Only nodes below a hit are read."""
    levels = level_sizes(count, fanout)
    starts = np.cumsum([0, *levels[:0:-1]])
    ends = np.append(starts[1:], sum(levels))
    found = np.arange(1)
    for depth, (start, end) in enumerate(zip(starts, ends, strict=True)):
        spans = np.flatnonzero(np.diff(found, prepend=-9) > 1)
        nodes = np.concatenate([read(int(found[a]), int(found[b - 1] - found[a] + 1)) for a, b in zip(spans, np.append(spans[1:], len(found)), strict=True)])
        hit = (nodes["xmin"] <= box[2]) & (nodes["ymin"] <= box[3]) & (nodes["xmax"] >= box[0]) & (nodes["ymax"] >= box[1])
        if depth == len(levels) - 1:
            return np.stack([found[hit] - start, nodes["offset"][hit].astype(np.int64)], 1)
        if not hit.any():
            break
        first = nodes["offset"][hit].astype(np.int64)
        below = (first[:, None] + np.arange(fanout)).ravel()
        found = below[below < ends[depth + 1]]
    return np.empty((0, 2), np.int64)


class File:
    """A FlatGeobuf file: its header, and where tree and features start."""

    def __init__(self, read, size: int):
        start = read(0, 12)
        if start[:4] != MAGIC[:4]:
            raise ValueError("not a FlatGeobuf file")
        n = struct.unpack_from("<I", start, 8)[0]
        h = Table.root(read(12, n))
        self.count, self.fanout, self.size = h.value(8, "Q", 0), h.value(9, "H", FANOUT), size
        self.columns = [(c.string(0), c.value(1, "B", 0)) for c in h.tables(7)]
        crs = h.table(10)
        self.epsg = crs.value(1, "i", 0) if crs else None
        self.bounds = h.array(1, "<f8")
        self.tree = 12 + n
        indexed = self.fanout > 1 and self.count
        self.features = self.tree + (sum(level_sizes(self.count, self.fanout)) * NODE.itemsize if indexed else 0)
        self.indexed = bool(indexed)


RINGS_TYPE = T.ArrayType(T.ArrayType(T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])))


@dataclass
class Part(InputPartition):
    files: list[tuple[str, int]]
    box: tuple


def together(files: list[tuple[str, int]], box: tuple) -> list[Part]:
    """Files (name, size) by some megabytes a task, as a task costs more than a small file."""
    parts, held, size = [], [], 0
    for name, n in files:
        if held and size + n > TASK_BYTES:
            parts.append(Part(held, box))
            held, size = [], 0
        held, size = [*held, (name, n)], size + n
    return [*parts, Part(held, box)]


def bounds_of(shapes: list[list[np.ndarray]]) -> np.ndarray:
    """xmin, ymin, xmax, ymax of each shape, all at once; not numbers where there are no points."""
    sizes = np.array([sum(map(len, s)) for s in shapes], np.int64)
    out, some = np.full((len(shapes), 4), np.nan), np.flatnonzero(sizes)
    if len(some):
        points, at = np.concatenate([r for s in shapes for r in s]), (np.cumsum(sizes) - sizes)[some]
        out[some] = np.hstack([np.minimum.reduceat(points, at), np.maximum.reduceat(points, at)])
    return out


class Reader(DataSourceReader):
    def __init__(self, path: str, box: list[float]):
        self.path, self.box = path, box

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Comparisons with the shapes' bounds narrow the box: xmin <= v is a shape that starts before v, and so on. Spark still
        applies them."""
        for f in filters:
            axis = f.attribute[0] if len(f.attribute) == 1 else ""
            if axis in ("xmin", "ymin") and isinstance(f, (LessThan, LessThanOrEqual, EqualTo)):
                k = 2 if axis == "xmin" else 3
                self.box[k] = min(self.box[k], float(f.value))
            if axis in ("xmax", "ymax") and isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo)):
                k = 0 if axis == "xmax" else 1
                self.box[k] = max(self.box[k], float(f.value))
            yield f

    def partitions(self) -> list[Part]:
        store, box, all_ = Store(self.path), tuple(self.box), tuple(self.box) == (-math.inf, -math.inf, math.inf, math.inf)
        if store.exists(INDEX):
            files = json.loads(store.all(INDEX))["files"]
            keep = [f for f in files if all_ or f["bounds"] and f["bounds"][0] <= box[2] and f["bounds"][1] <= box[3] and f["bounds"][2] >= box[0] and f["bounds"][3] >= box[1]]
            return together([(f["name"], f["size"]) for f in keep], box)
        return together([(n, store.size(n)) for n in store.names((".fgb",))], box)

    def read(self, part: Part) -> Iterator[pa.RecordBatch]:
        store = Store(self.path)
        for name, size in part.files:
            with store.fs.open_input_file(store.at(name)) as f:
                read = lambda at, n: f.read_at(n, at)  # noqa: E731,B023
                file = File(read, size)
                for data in self._wanted(file, read, part.box):
                    yield self._batch(file, data, part.box)

    def _wanted(self, file: File, read, box: tuple) -> Iterator[list[bytes]]:
        """Features as bytes, some at a time."""
        if not file.indexed or box == (-math.inf, -math.inf, math.inf, math.inf):
            at, rest = file.features, b""
            while at < file.size or rest:
                rest += read(at, READ_BYTES)
                at = min(file.size, at + READ_BYTES)
                found, k = [], 0
                while k + 4 <= len(rest) and k + 4 + (n := struct.unpack_from("<I", rest, k)[0]) <= len(rest):
                    found.append(rest[k + 4 : k + 4 + n])
                    k += 4 + n
                rest = rest[k:]
                yield found
                if at >= file.size:
                    return
        nodes = lambda first, n: np.frombuffer(read(file.tree + first * NODE.itemsize, n * NODE.itemsize), NODE)
        hits = search(nodes, file.count, box, file.fanout)
        if not len(hits):
            return
        leaves = sum(level_sizes(file.count, file.fanout)) - file.count
        spans = []  # a feature ends where the next one starts, which the next leaf tells
        for a, b in self._stretches(hits[:, 0]):
            first, last = int(hits[a, 0]), int(hits[b - 1, 0])
            ends = nodes(leaves + first, min(last + 2, file.count) - first)["offset"].astype(np.int64)
            if last + 1 == file.count:
                ends = np.append(ends, file.size - file.features)
            spans += [(int(o), int(ends[p - first + 1])) for p, o in hits[a:b]]
        held: list[bytes] = []
        at = 0
        while at < len(spans):
            to = at
            while to + 1 < len(spans) and spans[to + 1][0] - spans[to][1] <= NEAR and spans[to + 1][1] - spans[at][0] <= READ_BYTES:
                to += 1
            data = read(file.features + spans[at][0], spans[to][1] - spans[at][0])
            held += [data[s - spans[at][0] + 4 : e - spans[at][0]] for s, e in spans[at : to + 1]]
            at = to + 1
            if len(held) >= 4096:
                yield held
                held = []
        yield held

    @staticmethod
    def _stretches(places: np.ndarray) -> Iterator[tuple[int, int]]:
        cuts = np.flatnonzero(np.diff(places, prepend=-1 << 40) > FANOUT)
        yield from zip(cuts, np.append(cuts[1:], len(places)), strict=True)

    def _batch(self, file: File, data: list[bytes], box: tuple) -> pa.RecordBatch:
        kinds, rows, shapes = [k for _, k in file.columns], [], []
        for raw in data:
            t = Table.root(raw)
            shapes.append(rings_of(t.table(0)))
            rows.append(t)
        bounds = bounds_of(shapes)
        with np.errstate(invalid="ignore"):
            keep = np.isnan(bounds).any(1) | (bounds[:, 0] <= box[2]) & (bounds[:, 1] <= box[3]) & (bounds[:, 2] >= box[0]) & (bounds[:, 3] >= box[1])
        keep |= np.array([not s for s in shapes], bool)
        rows = [properties_of(rows[i].array(1, "u1").tobytes(), kinds) for i in np.flatnonzero(keep)]
        types = {"boolean": pa.bool_(), "integer": pa.int32(), "long": pa.int64(), "float": pa.float32(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary()}
        arrays = [pa.array([r[i] for r in rows], types[TYPES[k].typeName()]) for i, k in enumerate(kinds)]
        arrays += [pa.array(b, pa.float64(), from_pandas=True) for b in bounds[keep].T]
        return pa.RecordBatch.from_arrays([*arrays, packed([shapes[i] for i in np.flatnonzero(keep)])], [*(n for n, _ in file.columns), *BOX, "rings"])


class Writer(FolderWriter):
    """A file for each task and `most` shapes, in the order in which they come."""

    def __init__(self, path: str, schema: T.StructType, most: int, epsg: int | None, overwrite: bool):
        self.columns = [(f.name, KINDS[f.dataType.typeName()]) for f in schema.fields if f.name != "rings"]
        self.rings_at, self.most, self.epsg = schema.names.index("rings"), most, epsg
        super().__init__(path, overwrite, {"columns": self.columns, "epsg": epsg})

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        store, files = Store(self.path), []
        kinds, held, boxes = [k for _, k in self.columns], [], []

        def flush() -> None:
            b = np.array(boxes)
            sizes = np.array([len(x) for x in held], np.int64)
            bounds = [float(x) for x in (*np.nanmin(b[:, :2], 0), *np.nanmax(b[:, 2:], 0))] if not np.isnan(b).all() else None
            head = header_bytes("shapes", self.columns, len(held), bounds, self.epsg)
            data = b"".join([MAGIC, head, tree_bytes(b, np.cumsum(sizes) - sizes), *held])
            files.append({"name": self.put(store, "part.fgb", data), "size": len(data), "count": len(held), "bounds": bounds})

        for batch in batches:
            values = list(zip(*(c.to_pylist() for i, c in enumerate(batch.columns) if i != self.rings_at), strict=True)) if len(self.columns) else [()] * batch.num_rows
            shapes = list(unpacked(batch.column(self.rings_at)))
            for rings, row, box in zip(shapes, values, bounds_of(shapes), strict=True):
                boxes.append(box)
                held.append(feature_bytes(rings, row, kinds))
                if len(held) >= self.most:
                    flush()
                    held, boxes = [], []
        if held:
            flush()
        return Written(files)


class FlatGeobuf(DataSource):
    @classmethod
    def name(cls) -> str:
        return "flatgeobuf"

    def schema(self) -> T.StructType:
        store = Store(self.options["path"])
        if store.exists(INDEX):
            index = json.loads(store.all(INDEX))
            columns = [tuple(c) for c in index["columns"]]
        else:
            name = store.names((".fgb",))[0]
            with store.fs.open_input_file(store.at(name)) as f:
                columns = File(lambda at, n: f.read_at(n, at), store.size(name)).columns
        return T.StructType([T.StructField(n, TYPES[k]) for n, k in columns] + [T.StructField(c, T.DoubleType()) for c in BOX] + [T.StructField("rings", RINGS_TYPE)])

    def reader(self, schema) -> Reader:
        o = self.options
        return Reader(o["path"], [float(o.get("xmin", -math.inf)), float(o.get("ymin", -math.inf)), float(o.get("xmax", math.inf)), float(o.get("ymax", math.inf))])

    def writer(self, schema: T.StructType, overwrite: bool) -> Writer:
        o = self.options
        return Writer(o["path"], schema, int(o.get("most", 200_000)), int(o["epsg"]) if "epsg" in o else None, overwrite)


def register(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(FlatGeobuf)
    return spark


def read_shapes(spark: SparkSession, path: str, box: tuple[float, float, float, float] | None = None) -> DataFrame:
    """Attributes, bounds (xmin, ymin, xmax, ymax) and rings of the shapes, or of those whose bounds meet the box."""
    return register(spark).read.format("flatgeobuf").options(**dict(zip(BOX, box, strict=True)) if box else {}).load(path)


def along_curve(df: DataFrame, rings: str, files: int | None = None) -> DataFrame:
    """df in ranges of the Hilbert numbers of the shapes' centres, each sorted; one pass finds the bounds of all."""
    b = geometry.bounds(F.flatten(rings))
    x, y = (b["xmin"] + b["xmax"]) / 2, (b["ymin"] + b["ymax"]) / 2
    df = checkpointed(spread(df), "shapes")  # read three times: bounds, ranges, rows
    all_ = df.select(x.alias("x"), y.alias("y")).agg(F.min("x"), F.min("y"), F.max("x"), F.max("y")).first()
    number = hilbert(x, y, *all_) if all_[0] is not None else F.lit(0).cast("long")
    n = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.withColumn("_h", number).repartitionByRange(n, "_h").sortWithinPartitions("_h").drop("_h")


def write_shapes(df: DataFrame, path: str, rings: str = "rings", epsg: int | None = 5070, most: int = 200_000, files: int | None = None) -> None:
    """Write shapes and their attributes of plain types; other types as JSON text. Null or empty shapes are kept without a
    geometry, and no box finds them."""
    register(df.sparkSession)
    plain = [F.col(f.name) if f.dataType.typeName() in KINDS else F.to_json(f.name).alias(f.name) if f.dataType.typeName() in ("array", "map", "struct") else F.col(f.name).cast("string").alias(f.name) for f in df.schema if f.name != rings and f.name not in BOX]
    out = along_curve(df.select(*plain, F.col(rings).cast(RINGS).alias("rings")), "rings", files)
    out.write.format("flatgeobuf").mode("overwrite").options(most=most, **({"epsg": epsg} if epsg is not None else {})).save(path)
