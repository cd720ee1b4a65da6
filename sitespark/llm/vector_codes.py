"""Codes for vectors: a codebook for each part of a vector, learnt in Lloyd rounds with Elkan's bounds, exact in integers."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Work, batches_of, pack, release, unpack

#: Scaled components beyond this are taken as this, so that squared distances of 8,192 components stay below 2^63.
MOST = 1 << 24
#: Relative room for rounding in bounds, which are floats; what they don't decide is decided by integers.
ROOM = 1e-6


def whole_components(vector: Column, scale: int) -> Column:
    """floor(scale * x) for each component x, within +-MOST."""
    return F.transform(vector, lambda x: F.floor(F.greatest(F.lit(-float(MOST)), F.least(F.lit(float(MOST)), x.cast("double") * scale))).cast("int"))


def usable(vector: Column) -> Column:
    """Neither null nor holding a null or non-finite component."""
    return vector.isNotNull() & F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double")) != float("inf")), F.lit(False)))


class Codebooks:
    """entries[part, entry, component], the distances that bounds need of them, and how far each moved since the round before."""

    def __init__(self, entries: np.ndarray, before: np.ndarray | None = None):
        self.entries = entries
        self.moved = np.zeros(entries.shape[:2]) if before is None else roots(((entries - before) ** 2).sum(-1)) * (1 + ROOM)
        apart = entries[:, :, None, :] - entries[:, None, :, :]
        self.half = roots((apart**2).sum(-1)) * (0.5 - ROOM)

    @property
    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def roots(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64))


class Bounds:
    """Of a block of vectors and one part: an upper bound on the distance to its entry, and a lower one for every entry.

    Lower bounds are kept as sixteenths of the largest one, rounded down, two in a byte, so that a part with 64 entries
    takes 41 bytes of a row.
    """

    def __init__(self, code: np.ndarray, upper: np.ndarray, lower: np.ndarray):
        self.code, self.upper, self.lower = code, upper, lower

    def packed(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        top = np.nextafter(self.lower.max(1).astype(np.float32), np.float32(0))
        with np.errstate(divide="ignore", invalid="ignore"):
            steps = np.where(top[:, None] > 0, np.floor(self.lower / top[:, None].astype(np.float64) * 15 * (1 - ROOM)), 0)
        steps = np.clip(steps, 0, 15).astype(np.uint8)
        if steps.shape[1] % 2:
            steps = np.pad(steps, ((0, 0), (0, 1)))
        return self.code, np.nextafter(self.upper.astype(np.float32), np.float32(np.inf)), top, steps[:, ::2] << 4 | steps[:, 1::2]

    @staticmethod
    def unpacked(code: np.ndarray, upper: np.ndarray, top: np.ndarray, steps: np.ndarray, entries: int) -> Bounds:
        lower = np.stack([steps >> 4, steps & 15], -1).reshape(len(steps), -1)[:, :entries]
        return Bounds(code, upper.astype(np.float64), lower * (top[:, None].astype(np.float64) / 15))


def first_bounds(x: np.ndarray, entries: np.ndarray) -> Bounds:
    """All distances of a part's vectors x: the nearest entry, ties to the lower index."""
    squares = ((x[:, None, :] - entries) ** 2).sum(-1)
    code = squares.argmin(1)
    far = roots(squares)
    return Bounds(code.astype(np.uint8), far[np.arange(len(x)), code] * (1 + ROOM), far * (1 - ROOM))


def elkan(x: np.ndarray, books: Codebooks, part: int, bounds: Bounds) -> tuple[Bounds, int]:
    """The nearest entries after the codebook has moved, and how many distances were computed.

    Bounds are shifted by the movement. An entry is passed over only where its lower bound, or half its distance from the
    present entry, is strictly greater than the upper bound; every other one is compared by integers, ties to the lower index.
    """
    entries, moved, half = books.entries[part], books.moved[part], books.half[part]
    code = bounds.code.astype(np.int64)
    upper = (bounds.upper + moved[code]) * (1 + ROOM)
    lower = np.maximum(0, bounds.lower - moved) * (1 - ROOM)
    rows = np.arange(len(x))
    open_ = ~(np.maximum(lower, half[code]) > upper[:, None])
    open_[rows, code] = False
    some = np.flatnonzero(open_.any(1))
    own = ((x[some] - entries[code[some]]) ** 2).sum(-1)
    upper[some] = roots(own) * (1 + ROOM)
    lower[some, code[some]] = roots(own) * (1 - ROOM)
    open_ = open_[some] & ~(np.maximum(lower[some], half[code[some]]) > upper[some][:, None])
    at, entry = np.nonzero(open_)
    if len(at):
        squares = ((x[some[at]] - entries[entry]) ** 2).sum(-1)
        lower[some[at], entry] = roots(squares) * (1 - ROOM)
        starts = np.flatnonzero(np.diff(at, prepend=-1))
        best = np.minimum.reduceat(squares, starts)
        hits = np.flatnonzero(squares == np.repeat(best, np.diff(starts, append=len(at))))
        hits = hits[np.flatnonzero(np.diff(at[hits], prepend=-1))]  # the least index among equal ones
        row, candidate = at[starts], entry[hits]
        better = (best < own[row]) | (best == own[row]) & (candidate < code[some[row]])
        row, candidate, best = row[better], candidate[better], best[better]
        code[some[row]] = candidate
        upper[some[row]] = roots(best) * (1 + ROOM)
    return Bounds(code.astype(np.uint8), upper, lower), len(some) + len(at)


def as_blocks(rows: DataFrame, width: int, parts: int) -> Iterator:
    """Batches of rows (id, label, ints) as (ids, labels, x[row, part, component])."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            lists = batch.column(2)
            lengths = np.asarray(lists.value_lengths())
            x = np.zeros((batch.num_rows, width * parts), np.int32)
            x[np.repeat(np.arange(len(lengths)), lengths), np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = np.asarray(lists.flatten())
            yield batch.column(0), batch.column(1), x.reshape(batch.num_rows, parts, width)

    return run


STATE = "ints binary, code binary, upper binary, top binary, lower binary, checked long"


def state_row(ids: pa.Array, labels: pa.Array, ints: bytes, n: int, found: list[Bounds], checked: int) -> pa.RecordBatch:
    code, upper, top, lower = (np.stack(x, 1) if n else np.empty((0,)) for x in zip(*(b.packed() for b in found), strict=True))
    lists = [pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a) for a in (ids, labels)]
    data = [[ints], [code.tobytes()], [upper.tobytes()], [top.tobytes()], [lower.tobytes()]]
    return pa.RecordBatch.from_arrays([*lists, *(pa.array(d, pa.binary()) for d in data), pa.array([checked], pa.int64())], ["ids", "labels", "ints", "code", "upper", "top", "lower", "checked"])


def moved_bounds(row: dict, books: Codebooks) -> tuple[np.ndarray, list[Bounds], int]:
    """A state row's vectors beside their bounds after the codebooks have moved."""
    parts, entries, width = books.entries.shape
    code = np.frombuffer(row["code"], np.uint8).reshape(-1, parts)
    n = len(code)
    x = unpack(row["ints"], np.int32).reshape(n, parts, width).astype(np.int64)
    upper, top = (np.frombuffer(row[k], np.float32).reshape(n, parts) for k in ("upper", "top"))
    lower = np.frombuffer(row["lower"], np.uint8).reshape(n, parts, -1)
    found, checked = [], 0
    for p in range(parts):
        b, c = elkan(x[:, p], books, p, Bounds.unpacked(code[:, p], upper[:, p], top[:, p], lower[:, p], entries))
        found.append(b)
        checked += c
    return x, found, checked


def updated(state: DataFrame, books: Codebooks) -> np.ndarray:
    """Each entry's floor(sum / count), unused ones as they were. A task sums its blocks; what the driver gets are one row
    for each part and entry."""
    parts, entries, width = books.entries.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts * entries, width + 1), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                code = np.frombuffer(row["code"], np.uint8).reshape(-1, parts)
                x = unpack(row["ints"], np.int32).reshape(len(code), parts, width)
                key = (code + np.arange(parts) * entries).ravel()
                total[:, 0] += np.bincount(key, minlength=len(total))
                for c in range(width):  # sums of a block are below 2^53
                    total[:, c + 1] += np.bincount(key, x[:, :, c].ravel(), len(total)).astype(np.int64)
        used = np.flatnonzero(total[:, 0])
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), *(pa.array(total[used, c]) for c in range(width + 1))], ["key", *(f"s{c}" for c in range(width + 1))])
        release()

    names = [f"s{c}" for c in range(width + 1)]
    rows = state.select("ints", "code").mapInArrow(sums, "key int" + "".join(f", {n} long" for n in names)).groupBy("key").agg(*(F.sum(n).alias(n) for n in names)).collect()
    out = books.entries.copy().reshape(parts * entries, width)
    for r in rows:
        out[r["key"]] = [r[n] // r["s0"] for n in names[1:]]
    return out.reshape(books.entries.shape)


def compress_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> DataFrame:
    """(id, label, code, error, label_error, codebooks_sha256) for each row with a usable vector.

    Components become floor(scale * x); a vector is cut into `parts` equal consecutive parts, each with a codebook of its
    own that starts as that part of the `entries` (256 at most) smallest ids. A round assigns every part to its nearest
    entry (squared Euclidean distance, ties to the lower index) and replaces each entry by floor(sum / count) of its parts;
    at the end all parts are assigned again. code has two hex digits a part, error the squared distances summed, label_error
    the sum of errors over equal labels.

    Between rounds a block of 256 rows keeps for each row and part its entry, an upper bound and one lower bound for each
    entry (STATE, written to the shared folder, about 0.7 kB a row at 16 x 64); see elkan. Blocks stay where they are: only
    sums of parts by entry are exchanged, and errors by label at the end. So nothing grows with a group of equal vectors, and a
    label that many rows have is summed in the map tasks and joined by a join that Spark can split.

    Null ids come last in the order of ids and keep their rows; equal ids are ordered by their components. Rows whose vector
    is null or holds null or non-finite components are left out. Vectors of different lengths, or of one that `parts` doesn't
    divide, count as if zeros followed up to the next multiple of `parts`; empty ones are all zeros. With fewer rows than
    `entries` there are as many entries as rows; without rows the result is empty. Scaled components beyond +-2^24 are taken as
    that. Null labels are one label. Columns beside the three named ones play no part.
    """
    if not 0 < entries <= 256:
        raise ValueError("entries must be 1 to 256")
    spark = df.sparkSession
    vector = F.col(vector_col)
    rows = df.filter(usable(vector)).select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), whole_components(vector, scale).alias("ints"))
    id_type, label_type = (f.dataType.simpleString() for f in rows.schema.fields[:2])
    first = rows.orderBy(F.col("id").asc_nulls_last(), "ints").select("ints").limit(entries).collect()
    out = f"id {id_type}, label {label_type}, code string, error long"
    if not first:
        return spark.createDataFrame([], out + ", label_error long, codebooks_sha256 string")
    width = -(-rows.agg(F.max(F.size("ints"))).first()[0] // parts)
    start = np.zeros((len(first), width * parts), np.int64)
    for i, r in enumerate(first):
        start[i, : len(r["ints"])] = r["ints"]
    books = Codebooks(start.reshape(len(first), parts, width).transpose(1, 0, 2).copy())

    work, schema = Work(spark, "vector_codes", python=False), f"ids array<{id_type}>, labels array<{label_type}>, {STATE}"
    read = as_blocks(rows, width, parts)

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, labels, x in read(batches):
            wide = x.astype(np.int64)
            yield state_row(ids, labels, pack(x.ravel()), len(x), [first_bounds(wide[:, p], books.entries[p]) for p in range(parts)], x.shape[0] * parts * books.entries.shape[1])
        release()

    def again(books: Codebooks):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i, row in enumerate(batch.select(["ints", "code", "upper", "top", "lower"]).to_pylist()):
                    x, found, checked = moved_bounds(row, books)
                    yield state_row(batch.column(0)[i].values, batch.column(1)[i].values, row["ints"], len(x), found, checked)
            release()

        return run

    def end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, row in enumerate(batch.select(["ints", "code", "upper", "top", "lower"]).to_pylist()):
                x, found, _ = moved_bounds(row, books)
                code = np.stack([b.code for b in found], 1)
                error = ((x - books.entries[np.arange(parts), code]) ** 2).sum((1, 2))
                yield pa.RecordBatch.from_arrays([batch.column(0)[i].values, batch.column(1)[i].values, pa.array([c.tobytes().hex() for c in code]), pa.array(error, pa.int64())], ["id", "label", "code", "error"])
        release()

    with batches_of(spark, 256):
        state = work.save("state-0", rows.mapInArrow(begin, schema))
    for i in range(rounds):
        books = Codebooks(updated(state, books), books.entries)
        if i < rounds - 1:
            with batches_of(spark, 64):
                state = work.save(f"state-{i + 1}", state.mapInArrow(again(books), schema))
            work.drop(f"state-{i}")
    with batches_of(spark, 64):
        codes = work.save("codes", state.mapInArrow(end, out))
    work.drop(f"state-{max(0, rounds - 1)}")
    sums = codes.groupBy("label").agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit((1 << 63) - 1)).cast("long").alias("label_error"))
    return codes.join(sums.withColumnRenamed("label", "of"), F.col("label").eqNullSafe(F.col("of"))).select("id", "label", "code", "error", "label_error", F.lit(books.sha256).alias("codebooks_sha256"))
