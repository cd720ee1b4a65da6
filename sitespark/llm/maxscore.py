"""Exact top-k inner products by MaxScore over shards of postings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a shard and queries of a block, about: what one task holds.
SHARD_ROWS, BLOCK_QUERIES = 8192, 512
LONG = (1 << 63) - 1
#: Added to scores, so that they sort as unsigned bytes.
WIDE = 1 << 250


class Shard:
    """Postings of integer vectors: for each term (dimension) the rows where it isn't 0, with their values."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, copies: np.ndarray):
        self.ids, self.vectors, self.copies = ids, vectors, copies
        n = vectors.shape[1]
        self.most = self.vectors.max(0) if len(ids) else np.zeros(n, vectors.dtype)
        self.least = self.vectors.min(0) if len(ids) else np.zeros(n, vectors.dtype)
        self.rows = [np.flatnonzero(self.vectors[:, d]) for d in range(n)]
        self.values = [self.vectors[r, d] for d, r in enumerate(self.rows)]

    def top(self, query: np.ndarray, own: int | None, k: int, block: int = 8) -> list[tuple[int, int]]:
        """The k best (score, place) of the rows, each as often as it occurs but once less for the row at place `own`; ties
        to the lesser id.

        Terms go by the span of what they can add, in blocks. Postings are traversed while a row that none of them has met
        could still reach the threshold, the k-th best of the scores' lower bounds so far: these terms are the essential
        ones. The others are probed only for rows whose upper bound reaches the threshold, which rises as they are.
        """
        terms = np.flatnonzero(query)
        high = np.maximum(query[terms] * self.most[terms], query[terms] * self.least[terms])
        low = np.minimum(query[terms] * self.most[terms], query[terms] * self.least[terms])
        order = np.argsort(-(high - low), kind="stable")
        terms, high, low = terms[order], high[order], low[order]
        up, down = np.concatenate([np.cumsum(high[::-1])[::-1], [0]]), np.concatenate([np.cumsum(low[::-1])[::-1], [0]])
        score = np.zeros(len(self.ids), self.vectors.dtype)
        live = np.arange(len(self.ids))
        if own is not None and self.copies[own] == 1:
            live = live[live != own]

        def floor(got: np.ndarray, at: int):
            return np.partition(got, len(got) - k)[len(got) - k] + down[at]

        at = 0
        while at < len(terms):
            for d in terms[at : at + block]:
                score[self.rows[d]] += query[d] * self.values[d]
            at = min(len(terms), at + block)
            if len(live) <= k or up[at] < floor(score[live], at):
                break
        while at < len(terms) and len(live) > k:
            got = score[live]
            live = live[got + up[at] >= floor(got, at)]
            stop = min(len(terms), at + block)
            for d in terms[at:stop]:
                score[live] += query[d] * self.vectors[live, d]
            at = stop
        for d in terms[at:]:
            score[live] += query[d] * self.vectors[live, d]
        best = live[np.lexsort((self.ids[live], -score[live]))[:k]]
        out: list[tuple[int, int]] = []
        for i in best:
            out += [(int(score[i]), int(i))] * min(k - len(out), int(self.copies[i]) - (i == own))
        return out


def _matrix(rows: list[list[int]], dims: int) -> np.ndarray:
    """Vectors as rows, short ones filled with 0; Python integers where a product could leave 64 bits."""
    out = np.zeros((len(rows), dims), object)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    most = max((abs(x) for r in rows for x in r), default=0)
    return out if most * most * max(dims, 1) >= 1 << 62 else out.astype(np.int64)


def quantised(vector: str, scale: int = 1024):
    """floor(scale * x) of each component as a double, as decimals without a fraction; null if any is null or not finite."""
    whole = F.transform(F.col(vector), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    bad = F.exists(F.col(vector), lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == F.lit(float("inf"))))
    return F.when(F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(True)), whole)


def exact_top_k(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 100, k: int = 10, scale: int = 1024, shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose id is divisible by `every`, the k other rows with the largest
    integer inner product of the vectors floor(scale * x), ties to the lesser id; all of them if there are fewer.

    Rows with equal ids and vectors are counted first, on the map side where they are many. Rows are dealt to shards and
    queries to blocks, both of bounded size; a task gets one shard and one block, and the shards' best k of each query are
    merged. Vectors that are null or hold a null or non-finite component take no part. A vector that is shorter than another
    is filled with zeros; components beyond 64 bits saturate. Scores are exact in order; the column saturates at 64 bits.
    Null ids take no part. Each row of a repeated id is a query, and a candidate for all rows but itself. Other columns are
    ignored; empty tables give no rows.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), quantised(vector_col, scale).alias("v")).filter("id IS NOT NULL AND v IS NOT NULL")
    rows = rows.groupBy("id", "v").agg(F.count(F.lit(1)).alias("copies"))
    count = rows.agg(F.count(F.lit(1)), F.count_if(F.col("id") % every == 0)).first()
    shards, groups = max(1, -(-count[0] // shard_rows)), max(1, -(-count[1] // block_queries))
    own = F.expr(f"cast(pmod(xxhash64(id, v), {shards}) AS int)")
    block = F.expr(f"cast(pmod(xxhash64(id, v, 1), {groups}) AS int)")
    every_block, every_shard = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))), F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    candidates = rows.select("id", "v", "copies", own.alias("shard"), every_block.alias("block"))
    queries = rows.filter(F.col("id") % every == 0).select("id", "v", "copies", own.alias("home"), F.xxhash64("v").alias("key"), every_shard.alias("shard"), block.alias("block"))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        left = left.sort_by("id")
        mine, asked = left.column("v").to_pylist(), right.column("v").to_pylist()
        if mine and asked:
            dims = max(map(len, [*mine, *asked]))
            both = _matrix([*mine, *asked], dims)
            ids = left.column("id").to_numpy()
            shard = Shard(ids, both[: len(mine)], left.column("copies").to_numpy())
            place = {(i, tuple(v)): n for n, (i, v) in enumerate(zip(ids.tolist(), mine, strict=True))}
            for q, v, times, home, at, key, vector in zip(*(right.column(c).to_pylist() for c in ("id", "v", "copies", "home", "shard", "key")), both[len(mine) :], strict=True):
                for s, i in shard.top(vector, place.get((q, tuple(v))) if home == at else None, k):
                    out.append((q, key, times, int(ids[i]), max(-LONG - 1, min(LONG, s)), (s + WIDE).to_bytes(32, "big")))
        columns = list(zip(*out, strict=True)) or [()] * 6
        return pa.table([*(pa.array(x, pa.int64()) for x in columns[:5]), pa.array(columns[5], pa.binary())], names=["query_id", "key", "times", "vec_id", "score", "order"])

    best = candidates.groupBy("shard", "block").cogroup(queries.groupBy("shard", "block")).applyInArrow(run, "query_id long, key long, times long, vec_id long, score long, order binary")
    rank = F.row_number().over(Window.partitionBy("query_id", "key").orderBy(F.desc("order"), "vec_id"))
    best = best.withColumn("rank", rank).filter(F.col("rank") <= k)
    best = best.withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))  # equal query rows have equal lists
    return best.select("query_id", "rank", "vec_id", "score")
