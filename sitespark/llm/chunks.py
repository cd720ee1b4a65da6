"""Chunks of tokenised documents, and an exchange that sums values by 64-bit key and answers every chunk.

A corpus-wide count for each distinct token or n-gram, looked up again for each occurrence, is two large shuffles if
each occurrence is a row. Here documents are first written as chunks of about a quarter million tokens: sorted distinct word
hashes, and for each token the place of its word. A chunk asks with its distinct keys, sorted and packed, and a bucket of
keys sums what all chunks say of them and answers each. What is shuffled grows with the distinct keys of a chunk, and no
key, however frequent, is more than one entry per chunk.

Buckets grow in number with the corpus, and a chunk sends a slice to each bucket it has keys for: with C chunks that is at
most C * C slices of a quarter million / C keys, so beyond some 10,000 chunks (10 GB of text) CHUNK_TOKENS should grow with
the square root of the corpus; chunk_tokens does that.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, blocks, pack, pack_sorted, raw_texts, release, unpack, unpack_sorted

CHUNK_TOKENS = 1 << 18
#: Tokens for each bucket of an exchange, about: what one task holds in memory.
BUCKET_TOKENS = 1_000_000


class Chunk:
    """ids (None for null), flags, and the documents' words: vocabulary[places[starts[i]:starts[i + 1]]]."""

    def __init__(self, row: dict):
        self.ids, self.flags = row["ids"], np.asarray(row["flags"], bool)
        self.vocabulary = unpack_sorted(row["vocabulary"])
        self.places = unpack(row["places"], np.uint32)
        self.starts = np.concatenate([[0], np.cumsum(unpack(row["lengths"], np.uint32), dtype=np.int64)])

    @property
    def hashes(self) -> np.ndarray:
        return self.vocabulary[self.places]


def chunk_tokens(docs: DataFrame) -> int:
    """CHUNK_TOKENS, or more where the plan reads over 10 GB, up to 16 times as many."""
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return min(16, max(1, round((size / 1e10) ** 0.5))) * CHUNK_TOKENS


def tokenised(docs: DataFrame, id_col: str, text_col: str, flag=None) -> DataFrame:
    """The chunks of docs, one row each; to be written before use, since a chunk's name is drawn when it is made.

    Words are lower-cased (A-Z) and split at \\x20 and \\x09-\\x0D; null text has none. flag: a boolean for each document.
    """

    most = chunk_tokens(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        ids, flags, found, size = [], [], [], 0

        def row():
            lengths = np.array([len(x) for x in found], np.uint32)
            vocabulary, places = np.unique(np.concatenate(found) if found else np.empty(0, np.uint64), return_inverse=True)
            values = [[uuid.uuid4().hex], [int(lengths.sum())], [ids], [flags], [pack(lengths)], [pack_sorted(vocabulary)], [pack(places.astype(np.uint32))]]
            types = [pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types, strict=True)], names)

        names = ["chunk", "n_tokens", "ids", "flags", "lengths", "vocabulary", "places"]
        for batch in blocks(batches, 500):
            for key, text, mark in zip(batch.column(0).to_pylist(), raw_texts(batch, 1), batch.column(2).to_pylist(), strict=True):
                ids.append(key)
                flags.append(bool(mark))
                found.append(words.of(text))
                size += len(found[-1])
                if size >= most:
                    yield row()
                    ids, flags, found, size = [], [], [], 0
            words.trim()
        if ids:
            yield row()
        words.clear()
        release()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), (F.lit(False) if flag is None else F.coalesce(flag, F.lit(False))).alias("flag"))
    return rows.mapInArrow(run, "chunk string, n_tokens long, ids array<long>, flags array<boolean>, lengths binary, vocabulary binary, places binary")


def cuts_of(bounds: np.ndarray, keys: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.searchsorted(keys, bounds), [len(keys)]])


def equal_ranges(n: int) -> np.ndarray:
    """The n - 1 keys that part all 64-bit keys into n equal ranges."""
    return np.array([(i << 64) // n for i in range(1, n)], np.uint64)


Slices = Iterator[tuple[int, tuple[bytes, ...]]]
Answer = Callable[[int, list[tuple[bytes, ...]]], tuple[list[tuple[bytes, ...]], bytes, int]]


def exchange(chunks: DataFrame, send: Callable[[dict], Slices], answer: Answer, sent: int, answered: int) -> DataFrame:
    """Answers to what the chunks ask: rows (chunk, bucket, size, a0, a1 ...).

    send yields for a chunk's row a bucket and `sent` packed columns, once for each bucket. answer gets all of a bucket's
    slices, in the order of their chunks' names, and gives `answered` packed columns for each, and a packed summary and a
    number, which are a row without a chunk's name.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                buckets, data = [], [[] for _ in range(sent)]
                for bucket, columns in send(row):
                    buckets.append(bucket)
                    for column, x in zip(data, columns, strict=True):
                        column.append(x)
                if buckets:
                    yield pa.RecordBatch.from_arrays([pa.array(buckets, pa.int32()), pa.array([row["chunk"]] * len(buckets)), *(pa.array(c, pa.binary()) for c in data)], ["bucket", "chunk", *(f"s{k}" for k in range(sent))])
        release()

    def collect(table: pa.Table) -> pa.Table:
        names = table.column("chunk").to_pylist()
        order = sorted(range(len(names)), key=names.__getitem__)
        columns = [table.column(f"s{k}").to_pylist() for k in range(sent)]
        bucket = table.column("bucket")[0].as_py()
        found, summary, size = answer(bucket, [tuple(c[i] for c in columns) for i in order])
        del columns
        names = ["", *(names[i] for i in order)]
        found = [(summary, *[b""] * (answered - 1)), *found]
        release()
        return pa.table([pa.array(names), pa.array([bucket] * len(names), pa.int32()), pa.array([size] * len(names), pa.int64()), *(pa.array([f[k] for f in found], pa.binary()) for k in range(answered))], names=["chunk", "bucket", "size", *(f"a{k}" for k in range(answered))])

    asked = chunks.mapInArrow(ask, "bucket int, chunk string" + "".join(f", s{k} binary" for k in range(sent)))
    return asked.groupBy("bucket").applyInArrow(collect, "chunk string, bucket int, size long" + "".join(f", a{k} binary" for k in range(answered)))


def with_answers(chunks: DataFrame, answers: DataFrame, run: Callable[[dict, list[dict]], pa.Table], schema: str) -> DataFrame:
    """Each chunk's row beside its answers, by bucket. Chunks are of bounded size, and so are the groups."""

    def both(left: pa.Table, right: pa.Table) -> pa.Table:
        out = run(left.to_pylist()[0], sorted(right.to_pylist(), key=lambda r: r["bucket"]))
        release()
        return out

    return chunks.groupBy("chunk").cogroup(answers.filter("chunk != ''").groupBy("chunk")).applyInArrow(both, schema)


def joined(rows: list[dict], column: str, dtype) -> np.ndarray:
    """A packed column of all answers, in the order of the buckets."""
    parts = [unpack(r[column], dtype) for r in rows]
    return np.concatenate(parts) if parts else np.empty(0, dtype)
