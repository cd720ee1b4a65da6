"""Shared folder tables, binary column packing and Arrow helpers used by the operators of this package."""

from __future__ import annotations

import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: xxHash64 seeds and odd multipliers of the integer mixers: fixed values, so that reruns agree.
MIX_A, MIX_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or a temporary one where it is unset and the master is local."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    root = "file://" + tempfile.mkdtemp(prefix="sitespark-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


class Work:
    """Tables that cut lineage: Parquet in the shared folder, read again by whoever needs them."""

    #: Folders that this driver has made and not removed.
    made: list[Work] = []

    def __init__(self, spark: SparkSession, name: str, python: bool = True):
        if python:
            small_batches(spark)
        self.spark, self.root = spark, f"{shared_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        Work.made.append(self)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, name: str, df: DataFrame, codec: str = "zstd", free: bool = False) -> DataFrame:
        """Write df and read it back with its own schema, so that an empty table stays readable. free: for a table made by a
        large exchange, let Spark remove the shuffle files, which it does once the driver has collected what refers to them."""
        df.write.mode("overwrite").option("compression", codec).parquet(self.path(name))
        if free:
            self.free()
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def free(self) -> None:
        """Let Spark remove shuffle files that nothing refers to any more, once the scheduler has let go of the last job."""
        for _ in range(2):
            time.sleep(0.3)
            self.spark.sparkContext._jvm.System.gc()

    def drop(self, *names: str) -> None:
        """Delete tables nothing will read again."""
        jvm = self.spark.sparkContext._jvm
        for at in map(self.path, names):
            path = jvm.org.apache.hadoop.fs.Path(at)
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    @staticmethod
    def remove_since(mark: int) -> None:
        """Delete the folders made since len(Work.made) was mark. For callers that have written what depends on them."""
        while len(Work.made) > mark:
            work = Work.made.pop()
            work.drop("")


def small_batches(spark: SparkSession, rows: int = 256) -> None:
    """Send at most so many rows to Python at a time: a batch of 10,000 long texts or packed chunks, the default, takes its
    memory several times over in the JVM's buffers, the pipe and the worker. The session keeps the setting, as plans are
    run after the operator has returned."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


@contextmanager
def batches_of(spark: SparkSession, rows: int):
    """Within, plans that run send at most so many rows to Python at a time; then the session's own setting holds again."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, "10000")
    if int(before) <= 0 or int(before) > rows:
        spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def tie_break(schema: StructType, row: str) -> Column:
    """A number that orders rows which share all else, the same in each run; maps can't be hashed and are left out."""
    columns = [F.col(row).getField(f.name) for f in schema if "map<" not in f.dataType.simpleString() and f.dataType.typeName() != "variant"]
    return F.xxhash64(*columns) if columns else F.lit(0).cast("long")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def texts(batch: pa.RecordBatch, at: int) -> list[str]:
    """Column `at` as strings; null is empty."""
    return [x or "" for x in batch.column(at).to_pylist()]


def raw_texts(batch: pa.RecordBatch, at: int) -> list[bytes]:
    """Column `at` as UTF-8; null is empty."""
    return [x or b"" for x in batch.column(at).cast(pa.binary()).to_pylist()]


def pack(a: np.ndarray, level: int = 1) -> bytes:
    """An array's bytes by significance (all first bytes, then all second ones ...), compressed."""
    a = np.ascontiguousarray(a)
    return zstandard.ZstdCompressor(level=level).compress(a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes() if len(a) else b"")


def unpack(data: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(flat.reshape(size, -1).T).reshape(-1).view(dtype) if len(flat) else np.empty(0, dtype)


def pack_sorted(a: np.ndarray) -> bytes:
    """Ascending unsigned 64-bit values, as differences."""
    return pack(np.diff(a, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)


class WordHashes(dict):
    """64-bit hashes of words, kept for the frequent ones; call trim() between batches to bound memory."""

    def __init__(self, most: int = 200_000):
        import xxhash

        super().__init__()
        self.most, self.hash = most, xxhash.xxh3_64_intdigest

    def __missing__(self, word: bytes) -> int:
        self[word] = h = self.hash(word)
        return h

    def trim(self) -> None:
        if len(self) > self.most:
            self.clear()

    def of(self, text: bytes) -> np.ndarray:
        """Hashes of the words of a text: lower-cased A-Z, split at \\x20 and \\x09-\\x0D."""
        words = text.lower().split()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(a: np.ndarray) -> np.ndarray:
    """A bijection of unsigned 64-bit integers that spreads their bits."""
    with np.errstate(over="ignore"):
        a = (a ^ (a >> np.uint64(31))) * MIX_A
        a = (a ^ (a >> np.uint64(29))) * MIX_B
        return a ^ (a >> np.uint64(32))


def blocks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most `rows`."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def release() -> None:
    """Give memory that is free in this process back to the system, since workers outlive their tasks."""
    import ctypes

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass
