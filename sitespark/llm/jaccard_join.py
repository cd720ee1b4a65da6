"""N-gram Jaccard self-join with prefix filters under several global orders."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import BUCKET_TOKENS, Chunk, Slices, cuts_of, equal_ranges, exchange, joined, tokenised, with_answers
from .common import Work, mix, pack, pack_sorted, shuffle_partitions, unpack, unpack_sorted
from .components import components

#: Seeds of the orders, then of the leads: fixed values.
ORDER_SEEDS = (np.uint64(0x51ED270B9F3A7C11), np.uint64(0x8C5FB1A2D4E39077), np.uint64(0x2F7D6E15C3B8A049))
LEAD_SEEDS = (np.uint64(0x1B873593CC9E2D51), np.uint64(0x38B34AE5A1E38B93), np.uint64(0x7FEB352D846CA68B), np.uint64(0x2545F4914F6CDD1D))
#: Rows of a side in one block comparison.
MINOR_ROWS, OTHER_ROWS = 128, 512


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct 64-bit shingles of word hashes; fewer words than width make one shingle, none make none."""
    if not len(words):
        return np.empty(0, np.uint64)
    span = min(width, len(words))
    with np.errstate(over="ignore"):
        h = mix(words[: len(words) - span + 1])
        for k in range(1, span):
            h = mix(h + words[k : len(words) - span + 1 + k])
    return np.unique(h)


def prefix_size(n: int, percent: int) -> int:
    """So many first elements under any order: sets of n elements with percent/100 similarity or more share one of them."""
    return n - -(-n * percent // 100) + 1


def _sets(chunk: Chunk, width: int) -> list[np.ndarray]:
    hashes = chunk.hashes
    return [shingles(hashes[a:b], width) for a, b in zip(chunk.starts[:-1], chunk.starts[1:], strict=True)]


def _labels(sets: list[np.ndarray], bits: int) -> np.ndarray:
    """The first bits of all sets' shingles: what they are counted by. A label that occurs once is a shingle that does."""
    return np.concatenate(sets) >> np.uint64(64 - bits) if sets else np.empty(0, np.uint64)


def _ask(width: int, bits: int, buckets: int) -> Callable[[dict], Slices]:
    bounds = equal_ranges(buckets) >> np.uint64(64 - bits)

    def send(row: dict) -> Slices:
        keys, counts = np.unique(_labels(_sets(Chunk(row), width), bits), return_counts=True)
        cuts = cuts_of(bounds, keys)
        for b, (i, j) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if j > i:
                yield b, (pack_sorted(keys[i:j]), pack(counts[i:j].astype(np.uint32)))

    return send


def _count(bucket: int, slices: list) -> tuple[list, bytes, int]:
    parts = [unpack_sorted(s[0]) for s in slices]
    keys, at = np.unique(np.concatenate(parts), return_inverse=True)
    totals = np.bincount(at, np.concatenate([unpack(s[1], np.uint32) for s in slices]), len(keys))
    totals = np.minimum(totals, (1 << 32) - 1).astype(np.uint32)
    cut = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    return [(pack(totals[at[i:j]]),) for i, j in zip(cut[:-1], cut[1:], strict=True)], b"", len(keys)


def _sketch(width: int, percent: int, bits: int):
    """Of each document: its set's size and digest; and if a shingle of its prefix is in other documents too, those of the
    prefix and of the whole set that are, and a few leads. Documents of a chunk with equal sets have this once."""

    def run(row: dict, answers: list[dict]) -> pa.Table:
        import xxhash

        chunk = Chunk(row)
        sets = _sets(chunk, width)
        keys, at = np.unique(_labels(sets, bits), return_inverse=True)
        totals = joined(answers, "a0", np.uint32)
        assert len(totals) == len(keys), "a chunk got another number of answers than it asked for"
        df = totals[at]
        rows, first_of, start = [], {}, 0
        for place, (key, own) in enumerate(zip(chunk.ids, sets, strict=True)):
            n, often = len(own), df[start : start + len(own)]
            start += n
            digest = xxhash.xxh3_128_digest(own.tobytes()) if n else None
            rows.append([row["chunk"], place, key, n, digest, None, None, None])
            if not n or key is None or (first_of.get(digest, key) < key):
                continue
            order = np.lexsort((mix(own ^ ORDER_SEEDS[0]), often))[: prefix_size(n, percent)]
            prefix = own[order][often[order] > 1]
            if not len(prefix):
                continue
            if digest in first_of:  # a greater id of the same set
                rows[first_of[digest, 0]][5:] = [None] * 3
            first_of[digest], first_of[digest, 0] = key, place
            shared = own[often > 1]
            leads = {int(shared[np.argmin(mix(shared ^ seed))]) for seed in LEAD_SEEDS}
            rows[-1][5:] = [prefix.view(np.int64).tolist(), np.array(sorted(leads), np.uint64).view(np.int64).tolist(), pack_sorted(shared)]
        types = [pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["chunk", "place", "id", "n", "digest", "prefix", "leads", "shingles"])

    return run


def _head(own: np.ndarray, n: int, seed: np.uint64, percent: int) -> np.ndarray:
    """Of the shared shingles of a set of n: those that can be in its prefix under a hash order, and some more."""
    p = prefix_size(n, percent)
    return own if p >= len(own) else np.sort(own[np.argpartition(mix(own ^ seed), p - 1)[:p]])


def alike(n: int, m: int, common: int, percent: int) -> bool:
    return 100 * common >= percent * (n + m - common)


def _verify(percent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for r in batch.itertuples(index=False):
                x, y = unpack_sorted(r.shingles), unpack_sorted(r.shingles_b)
                ok = all(len(np.intersect1d(_head(x, r.n, s, percent), _head(y, r.n_b, s, percent), assume_unique=True)) for s in ORDER_SEEDS[1:])
                keep.append(ok and alike(r.n, r.n_b, len(np.intersect1d(x, y, assume_unique=True)), percent))
            yield batch.loc[keep, ["a", "b"]]

    return run


def _members(flat: np.ndarray, cuts: np.ndarray, probe: np.ndarray) -> np.ndarray:
    """How many of each slice's values are in the sorted probe."""
    at = np.minimum(np.searchsorted(probe, flat), len(probe) - 1)
    return np.add.reduceat(probe[at] == flat, cuts) if len(flat) else np.zeros(len(cuts), int)


def _blocks(percent: int):
    """Links between the minor and the other documents of a bucket that are still in different components."""

    def run(table: pa.Table) -> pa.Table:
        frame, out = table.to_pandas(), []
        for _, part in frame.groupby(["token", "minor_block", "other_block"], sort=False):
            minor, other = part[part.side == 0], part[part.side == 1]
            if minor.empty or other.empty:
                continue
            top: dict[int, int] = {}

            def find(x, top=top):
                while top.get(x, x) != x:
                    x = top[x]
                return x

            ids, sizes, groups = other.id.to_numpy(), other.n.to_numpy().astype(np.int64), other.component.tolist()
            sets = [unpack_sorted(x) for x in other.shingles]
            flat = []
            for values in (*([_head(x, n, s, percent) for x, n in zip(sets, sizes, strict=True)] for s in ORDER_SEEDS[1:]), sets):
                flat.append((np.concatenate(values), np.concatenate([[0], np.cumsum([len(v) for v in values])[:-1]])))
            for r in minor.itertuples(index=False):
                fits = (100 * np.minimum(sizes, r.n) >= percent * np.maximum(sizes, r.n)) & (ids != r.id)
                if not fits.any():
                    continue
                own = unpack_sorted(r.shingles)
                for (values, cuts), seed in zip(flat[:2], ORDER_SEEDS[1:], strict=True):
                    fits &= _members(values, cuts, _head(own, r.n, seed, percent)) > 0
                if not fits.any():
                    continue
                common = _members(*flat[2], own)
                for k in np.flatnonzero(fits & (100 * common >= percent * (sizes + r.n - common))):
                    x, y = find(r.component), find(groups[k])
                    if x != y:
                        top[max(x, y)] = min(x, y)
                        out.append((r.id, int(ids[k])))
        a, b = zip(*out, strict=True) if out else ((), ())
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, percent: int = 90, pivot_rounds: int = 5) -> DataFrame:
    """id, n_shingles, component_id: documents whose shingle sets reach percent/100 Jaccard similarity are linked, and a
    component is named by its least id.

    Texts are lower-cased (A-Z) and split at ASCII white space; shingles are told apart by 64-bit hashes. Documents with
    equal sets become one class. The first order ranks shingles by how many documents have them, counted over all documents
    (by as many bits of the hash as the corpus needs), then by hash; the second and third are by other hashes alone. Linked
    sets must share a prefix shingle under every order: classes meet in the buckets of the first, and the other two are
    checked before sets are compared in full.

    Groups of near copies are joined first: classes that share a lead (the least shared shingle under a hash, which near
    copies nearly always have in common) are compared with one pivot, in as many comparisons as they have members. Then
    the prefix buckets that still hold several components are found; their classes are compared with pivots again, a few times, and
    those that are still in another component than most of their bucket with the rest of it, in blocks. No link between
    different components is left untested, so the components are exact.

    Null or empty text: size 0, linked with nothing. Rows that share an id count as one node. A null id keeps its row,
    with a null component, and links nothing. Other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    work = Work(spark, "jaccard")
    chunks = work.save("chunks", tokenised(docs, id_col, text_col))
    n_tokens = chunks.agg(F.sum("n_tokens")).first()[0] or 0
    buckets = max(shuffle_partitions(spark), -(-n_tokens // BUCKET_TOKENS))
    big = n_tokens > BUCKET_TOKENS
    bits = min(64, max(24, n_tokens.bit_length() + 8))
    answers = work.save("answers", exchange(chunks, _ask(width, bits, buckets), _count, 2, 1), free=big)
    schema = "chunk string, place int, id long, n int, digest binary, prefix array<long>, leads array<long>, shingles binary"
    sketch = work.save("sketch", with_answers(chunks, answers, _sketch(width, percent, bits), schema), free=big)
    work.drop("chunks", "answers")

    heads = work.save("heads", sketch.select("id", "n", "digest"))
    owners = sketch.filter("n > 0 AND id IS NOT NULL").groupBy("digest").agg(F.min(F.struct(F.col("id"), F.col("prefix").isNull().alias("bare"), F.col("chunk"), F.col("place"))).alias("o"))
    classes = work.save("classes", owners.select("digest", F.col("o.id").alias("class"), F.col("o.chunk").alias("chunk"), F.col("o.place").alias("place")))
    near = sketch.filter("prefix IS NOT NULL").join(classes.select("chunk", "place"), ["chunk", "place"], "left_semi")
    near = work.save("near", near.select("id", "n", "prefix", "leads", "shingles"), free=big)
    work.drop("sketch")
    labels = work.save("labels-0", near.select(F.col("id").alias("node"), F.col("id").alias("component")).distinct())
    links = None
    if pivot_rounds:
        open_ = _unsettled(near, "leads", labels, work, "leads", percent)
        links, labels = _linked(work, "leads", _pivot_links(open_, near, work, "leads", percent, best=True), links, labels)
        if big:
            work.free()
    open_ = _unsettled(near, "prefix", labels, work, "prefix", percent)
    for turn in range(pivot_rounds):
        if open_.limit(1).count() == 0:
            break
        links, labels = _linked(work, turn, _pivot_links(open_, near, work, turn, percent), links, labels)
        open_ = _without_pivots(open_, labels, work, turn)
    if open_.limit(1).count():
        links, labels = _linked(work, "blocks", _block_links(open_, near, work, percent), links, labels)
    work.drop("near")
    named = classes.join(labels, classes["class"] == labels["node"], "left").select("digest", F.coalesce("component", "class").alias("component"))
    out = heads.join(named, "digest", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"), component.alias("component_id"))


def _linked(work: Work, turn: object, found: DataFrame, links: DataFrame | None, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All links so far, and the components they make."""
    found = work.save(f"links-{turn}", found)
    if found.limit(1).count() == 0:
        return links, labels
    links = found if links is None else links.union(found)
    label = components(links, work, f"turn-{turn}")
    new = labels.select("node").join(label, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
    return links, work.save(f"labels-{turn}", new)


def _mixed(rows: DataFrame) -> DataFrame:
    """Of the buckets that hold more than one component those with different members: a passage puts the same documents
    into many buckets, of which one is enough. Members are told apart by their number and two 64-bit hashes."""
    several = rows.groupBy("token").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count(F.lit(1)).alias("k"), F.bit_xor(F.xxhash64("id")).alias("h"), F.bit_xor(F.xxhash64(F.lit(1), "id")).alias("i")).filter("x != y")
    return several.groupBy("k", "h", "i").agg(F.min("token").alias("token")).select("token")


def _unsettled(near: DataFrame, tokens: str, labels: DataFrame, work: Work, name: str, percent: int) -> DataFrame:
    """Members of the buckets that hold more than one component: token, id, n, component; buckets are those of the leads or
    of the prefixes, apart by size: sets that can be alike are in the same class of sizes or in neighbouring ones, and each
    set is listed for its class and the next, so documents of other sizes that share a passage never meet. Written tables between the steps let joins see sizes, and split keys that many rows have."""
    rows = near.select("id", "n", F.col(tokens).alias("tokens")).join(labels, F.col("id") == F.col("node"))
    rows = work.save(f"rows-{name}", rows.select("id", "n", "component", "tokens"))
    step = math.log(100 / percent) * (1 + 1e-9) if percent < 100 else 1e-9
    size = F.floor(F.ln(F.col("n").cast("double")) / step)
    rows = rows.withColumn("size", F.explode(F.array(size, size + 1))).select(F.explode("tokens").alias("token"), "size", "id", "n", "component")
    rows = rows.select(F.xxhash64("token", "size").alias("token"), "id", "n", "component")
    several = work.save(f"several-{name}", _mixed(rows))
    open_ = work.save(f"open-{name}", rows.join(several, "token"))
    work.drop(f"rows-{name}", f"several-{name}")
    return open_


def _without_pivots(rows: DataFrame, labels: DataFrame, work: Work, turn: int) -> DataFrame:
    """The buckets that still hold several components, less their pivots, which have been compared with all they could be
    linked to there."""
    pivots = work.spark.read.parquet(work.path(f"pivots-{turn}")).select("token", F.col("p.b").alias("pivot"))
    rows = rows.join(pivots, "token").filter("id != pivot").select("token", "id", "n")
    rows = rows.join(labels, F.col("id") == F.col("node")).select("token", "id", "n", "component")
    rows = work.save(f"left-{turn}", rows)
    return work.save(f"open-{turn}", rows.join(work.save(f"several-{turn}", _mixed(rows)), "token"))


def _pivot_links(rows: DataFrame, near: DataFrame, work: Work, turn: object, percent: int, best: bool = False) -> DataFrame:
    """Links between each class and the pivots of its buckets, or only the one it shares most buckets with."""
    order = F.col("id") if best else F.xxhash64(F.lit(str(turn)), "id")
    pivots = rows.groupBy("token").agg(F.min(F.struct(order.alias("o"), F.col("id").alias("b"), F.col("n").alias("m"), F.col("component").alias("c"))).alias("p"))
    pivots = work.save(f"pivots-{turn}", pivots)
    pairs = rows.join(pivots, "token").filter((F.col("component") != F.col("p.c")) & (100 * F.least("n", "p.m") >= percent * F.greatest("n", "p.m")))
    pairs = pairs.groupBy(F.col("id").alias("a"), F.col("p.b").alias("b")).agg(F.count(F.lit(1)).alias("shared"))
    if best:
        pairs = pairs.groupBy("a").agg(F.max(F.struct(F.col("shared"), (-F.col("b")).alias("b"))).alias("best")).select("a", (-F.col("best.b")).alias("b"))
    pairs = work.save(f"pairs-{turn}", pairs.select("a", "b"))
    left = near.select(F.col("id").alias("a"), "n", "shingles")
    right = near.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("shingles").alias("shingles_b"))
    return pairs.join(left, "a").join(right, "b").mapInPandas(_verify(percent), "a long, b long")


def _block_links(rows: DataFrame, near: DataFrame, work: Work, percent: int) -> DataFrame:
    """Links from the classes outside their bucket's largest component to all its classes of other components."""
    counts = work.save("counts", rows.groupBy("token", "component").agg(F.count(F.lit(1)).alias("k")))
    main = counts.groupBy("token").agg(F.max(F.struct("k", "component")).alias("m"), F.sum("k").alias("all"))
    main = main.select("token", F.col("m.component").alias("main"), F.ceil((F.col("all") - F.col("m.k")) / MINOR_ROWS).cast("int").alias("minors"), F.ceil(F.col("all") / OTHER_ROWS).cast("int").alias("others"))
    main = work.save("main", main)
    rows = rows.select("token", "id", "component").join(main, "token")
    minor = rows.filter("component != main").withColumn("minor_block", F.expr("cast(pmod(xxhash64(id), minors) AS int)")).withColumn("other_block", F.explode(F.expr("sequence(0, others - 1)"))).withColumn("side", F.lit(0))
    other = rows.withColumn("other_block", F.expr("cast(pmod(xxhash64(id), others) AS int)")).withColumn("minor_block", F.explode(F.expr("sequence(0, minors - 1)"))).withColumn("side", F.lit(1))
    columns = ["token", "minor_block", "other_block", "side", "id", "component"]
    sides = minor.select(columns).union(other.select(columns)).join(near.select("id", "n", "shingles"), "id")
    blocks = main.agg(F.sum(F.col("minors").cast("long") * F.col("others"))).first()[0] or 0
    groups = max(shuffle_partitions(rows.sparkSession), blocks // 4)
    return sides.withColumn("g", F.expr(f"pmod(xxhash64(token, minor_block, other_block), {groups}L)")).groupBy("g").applyInArrow(_blocks(percent), "a long, b long")


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of docs but those whose component has a lesser id; documents without words and null ids stay."""
    work = Work(docs.sparkSession, "one-of-each")
    found = jaccard_components(docs, id_col, text_col, **options)
    gone = work.save("gone", found.filter(F.col("component_id") != F.col(id_col)).select(F.col(id_col).alias("id")).distinct())
    return docs.join(gone, docs[f"`{id_col}`"] == gone["id"], "left_anti")
