"""GeoTIFF as a Spark data source: rows (row, col, x, y, value) of a raster, read by blocks and written by blocks.

A raster is one file, or a folder of files on one grid, as the writer makes it. Row and column count from the grid's north-west
corner. Register with register(spark); then

    spark.read.format("geotiff").load(path).filter("row between 100 and 200 and x < 5000")

reads the strips or tiles that the comparisons of row, col, x and y leave, where spark.sql.python.filterPushdown.enabled is
set, and otherwise those of the options xmin, ymin, xmax, ymax. write_raster(df, path, grid) is the way to write.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from . import tiff
from .stores import INDEX, FolderWriter, Store, Written

#: Compressed bytes that one task reads, about.
TASK_BYTES = 32 << 20


@dataclass
class Grid:
    """Where a raster's pixels are: west and north edge, pixel width and height, and how values are kept."""

    west: float = 0.0
    north: float = 0.0
    dx: float = 30.0
    dy: float = 30.0
    dtype: str = "float64"
    nodata: float | None = None
    epsg: int | None = 5070


@dataclass
class Part(InputPartition):
    """Some blocks of one file: (row, col, offset, length) each, the file's place in the raster, and the rows and columns of
    the file that are asked for."""

    name: str
    row: int
    col: int
    rows: tuple
    cols: tuple
    blocks: list


class Window:
    """Rows [r0, r1) and columns [c0, c1) that are asked for."""

    def __init__(self):
        self.r0 = self.c0 = -math.inf
        self.r1 = self.c1 = math.inf

    def narrow(self, axis: str, low: float, high: float) -> None:
        if axis == "row":
            self.r0, self.r1 = max(self.r0, low), min(self.r1, high)
        else:
            self.c0, self.c1 = max(self.c0, low), min(self.c1, high)

    def within(self, row: int, col: int, height: int, width: int) -> tuple[tuple[int, int], tuple[int, int]]:
        """In the rows and columns of a file at (row, col)."""
        clip = lambda low, high, n: (int(min(max(low, 0), n)), int(min(max(high, 0), n)))
        return clip(self.r0 - row, self.r1 - row, height), clip(self.c0 - col, self.c1 - col, width)


class Raster:
    """The files of a raster with their headers; the index that a writer leaves saves reading each one's."""

    def __init__(self, path: str):
        self.store = Store(path)
        if self.store.exists(INDEX):
            index = json.loads(self.store.all(INDEX))
            self.grid = Grid(**index["grid"])
            self.files = {f["name"]: (f["row"], f["col"], f["height"], f["width"]) for f in index["files"]}
            return
        heads = {n: self.head(n) for n in self.store.names((".tif", ".tiff"))}
        if not heads:
            raise FileNotFoundError(f"no GeoTIFF in {path}")
        first = next(iter(heads.values()))
        west, north, dx, dy = min(h.transform[0] for h in heads.values()), max(h.transform[1] for h in heads.values()), *first.transform[2:]
        self.grid = Grid(west, north, dx, dy, first.dtype.newbyteorder("=").name, first.nodata, first.epsg)
        self.files = {n: (round((north - h.transform[1]) / dy), round((h.transform[0] - west) / dx), h.height, h.width) for n, h in heads.items()}

    def head(self, name: str) -> tiff.Tiff:
        with self.store.fs.open_input_file(self.store.at(name)) as f:
            return tiff.Tiff(lambda offset, length: f.read_at(length, offset))


class Reader(DataSourceReader):
    def __init__(self, path: str, window: dict[str, float], band: int):
        self.path, self.band, self.bounds = path, band, window
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Comparisons of row, col, x and y choose blocks; Spark still applies them to the pixels."""
        for f in filters:
            if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual, In)) and f.attribute in (("row",), ("col",), ("x",), ("y",)):
                self.filters.append(f)
            yield f

    def _window(self, grid: Grid) -> Window:
        w = Window()
        name = {"x": ("col", grid.west, grid.dx), "y": ("row", grid.north, -grid.dy)}
        limits = [("x", self.bounds.get("xmin"), self.bounds.get("xmax")), ("y", self.bounds.get("ymin"), self.bounds.get("ymax"))]
        for f in self.filters:
            axis = f.attribute[0]
            if isinstance(f, In):
                known = [v for v in f.value if v is not None]
                limits.append((axis, min(known, default=None), max(known, default=None)))
            else:
                limits.append((axis, f.value if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)) else None, f.value if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)) else None))
        for axis, low, high in limits:
            if axis in name:
                axis, start, step = name[axis]
                low, high = (None if v is None else (float(v) - start) / step - 0.5 for v in ((low, high) if step > 0 else (high, low)))
            # a pixel more on either side: what lies on the edge is left to the exact comparison
            w.narrow(axis, -math.inf if low is None else math.floor(low) - 1, math.inf if high is None else math.ceil(high) + 2)
        return w

    def partitions(self) -> list[Part]:
        raster = Raster(self.path)
        window, parts = self._window(raster.grid), []
        for name, (row, col, height, width) in raster.files.items():
            rows, cols = window.within(row, col, height, width)
            if rows[0] >= rows[1] or cols[0] >= cols[1]:
                continue
            blocks, size = [], 0
            for b in raster.head(name).blocks(rows, cols, self.band):
                blocks.append(b)
                size += b[3]
                if size >= TASK_BYTES:
                    parts.append(Part(name, row, col, rows, cols, blocks))
                    blocks, size = [], 0
            if blocks:
                parts.append(Part(name, row, col, rows, cols, blocks))
        return parts or [Part("", 0, 0, (0, 0), (0, 0), [])]

    def read(self, part: Part) -> Iterator[pa.RecordBatch]:
        if not part.blocks:
            return
        store = Store(self.path)
        with store.fs.open_input_file(store.at(part.name)) as f:
            image = tiff.Tiff(lambda offset, length: f.read_at(length, offset))
            west, north, dx, dy = image.transform
            rows, cols = part.rows, part.cols
            for row, col, offset, length in part.blocks:
                a = image.decode(f.read_at(length, offset) if length else b"", row, col, self.band)
                top, left = max(0, rows[0] - row), max(0, cols[0] - col)
                a = a[top : rows[1] - row, left : cols[1] - col]
                i, j = (k.ravel() for k in np.meshgrid(np.arange(a.shape[0]) + row + top, np.arange(a.shape[1]) + col + left, indexing="ij"))
                flat = a.ravel()
                values = flat.astype(np.float64)
                known = ~np.isnan(values) if flat.dtype.kind == "f" else np.ones(len(flat), bool)
                if image.nodata is not None:
                    known &= values != image.nodata
                yield pa.RecordBatch.from_arrays([pa.array(i + part.row, pa.int64()), pa.array(j + part.col, pa.int64()), pa.array(west + (j + 0.5) * dx), pa.array(north - (i + 0.5) * dy), pa.array(values, mask=~known)], ["row", "col", "x", "y", "value"])


class Writer(FolderWriter):
    """Each task writes whole blocks, one file each."""

    def __init__(self, path: str, grid: Grid, block: int, compress: str, predictor: int, names: list[str], overwrite: bool):
        super().__init__(path, overwrite, {"grid": vars(grid)})
        self.grid, self.block, self.compress, self.predictor, self.names = grid, block, compress, predictor, names

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        store, files, held, now = Store(self.path), [], [], None
        kind = np.dtype(self.grid.dtype)
        fill = self.grid.nodata if self.grid.nodata is not None else (math.nan if kind.kind == "f" else 0)

        def flush() -> None:
            rows, cols, values = (np.concatenate(x) for x in zip(*held, strict=True))
            pixels = np.full((int(rows.max()) + 1, int(cols.max()) + 1), fill, kind)
            pixels[rows, cols] = values
            r, c = now[0] * self.block, now[1] * self.block
            data = tiff.encode(pixels, (self.grid.west + c * self.grid.dx, self.grid.north - r * self.grid.dy, self.grid.dx, self.grid.dy), self.grid.epsg, self.grid.nodata, self.compress, self.predictor)
            name = self.put(store, f"r{r}_c{c}.tif", data)
            files.append({"name": name, "row": r, "col": c, "height": pixels.shape[0], "width": pixels.shape[1]})

        for batch in batches:
            row, col = (batch.column(self.names.index(n)).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("row", "col"))
            value = batch.column(self.names.index("value")).to_numpy(zero_copy_only=False).astype(np.float64)
            missing = np.isnan(value)
            value = np.where(missing, 0, value).astype(kind)
            value[missing] = fill
            key = np.stack([row // self.block, col // self.block])
            cuts = np.flatnonzero(np.concatenate([[True], (key[:, 1:] != key[:, :-1]).any(0)])) if len(row) else []
            for a, b in zip(cuts, [*cuts[1:], len(row)], strict=True):
                at = (int(key[0, a]), int(key[1, a]))
                if at != now and held:
                    flush()
                    held = []
                now = at
                held.append((row[a:b] - at[0] * self.block, col[a:b] - at[1] * self.block, value[a:b]))
        if held:
            flush()
        return Written(files)

    def ordered(self, files: list[dict]) -> list[dict]:
        if len({(f["row"], f["col"]) for f in files}) < len(files):
            raise ValueError("a block came from two tasks: write with write_raster, which brings a block's pixels together")
        return sorted(files, key=lambda f: (f["row"], f["col"]))


class GeoTiff(DataSource):
    @classmethod
    def name(cls) -> str:
        return "geotiff"

    def schema(self) -> str:
        return "row long, col long, x double, y double, value double"

    def reader(self, schema) -> Reader:
        return Reader(self.options["path"], {k: float(self.options[k]) for k in ("xmin", "ymin", "xmax", "ymax") if k in self.options}, int(self.options.get("band", 1)) - 1)

    def writer(self, schema, overwrite: bool) -> Writer:
        o = self.options
        grid = Grid(float(o.get("west", 0)), float(o.get("north", 0)), float(o.get("dx", 30)), float(o.get("dy", 30)), o.get("dtype", "float64"), float(o["nodata"]) if "nodata" in o else None, int(o["epsg"]) if "epsg" in o else None)
        return Writer(o["path"], grid, int(o.get("block", 1024)), o.get("compress", "deflate"), int(o.get("predictor", 1)), list(schema.names), overwrite)


def register(spark: SparkSession) -> SparkSession:
    """Make format("geotiff") known to the session, and let comparisons reach it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(GeoTiff)
    return spark


def read_raster(spark: SparkSession, path: str, **options) -> DataFrame:
    return register(spark).read.format("geotiff").options(**options).load(path)


def write_raster(df: DataFrame, path: str, grid: Grid, block: int = 1024, compress: str = "deflate", predictor: int = 1) -> None:
    """Write (row, col, value) as a raster of files of block x block pixels, a pixel's last value counting. Null values and
    pixels without a row are no data (0 where the grid has none and holds integers). One shuffle brings blocks together."""
    if predictor == 2 and np.dtype(grid.dtype).kind == "f":
        raise ValueError("predictor 2 is for integers")
    register(df.sparkSession)
    at = [F.floor(F.col(c) / block).cast("long") for c in ("row", "col")]
    rows = df.select(F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), F.col("value").cast("double").alias("value")).repartition(*at).sortWithinPartitions(*at)
    options = {"block": block, "compress": compress, "predictor": predictor} | {k: v for k, v in vars(grid).items() if v is not None}
    rows.write.format("geotiff").mode("overwrite").options(**options).save(path)
