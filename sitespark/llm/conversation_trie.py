"""The prefix trie of conversations as preorder intervals: subtrees are ranges of ranks, their sums differences of prefix sums."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Work, batches_of, pack, shuffle_partitions, unpack

WORD = r"[^\x20\x09-\x0D]+"
#: A node: its depth, and two sums of its turns' hashes, each of place and turn.
NODE = ["depth", "k1", "k2"]
ROOT_PATH = b""


def numbered_turns(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, place from 1, digest, words) of every turn; texts themselves are not shuffled."""
    role, text = F.coalesce(F.col(role_col).cast("string"), F.lit("")), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    turns = conversations.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("digest"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    return turns.withColumn("place", F.row_number().over(Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "digest")).cast("long")).drop("turn")


def borrowed(conv: Column, most: int = 4) -> Column:
    return F.crc32(conv.cast("string").cast("binary")) % most


def rebuilt(turns: DataFrame, group: int = 20) -> DataFrame:
    """(conv, place, digest, words): the first crc32(conv) % 4 turns of the conversation that leads its group of twenty (all of
    them if fewer, none if it is absent), then the conversation's own turns behind its first so many. A conversation without
    any turn left is one row at place 0."""
    lead = F.col("conv") - F.col("conv") % group
    heads = turns.filter((F.col("conv") % group == 0) & (F.col("place") <= 3)).groupBy(F.col("conv").alias("lead")).agg(F.array_sort(F.collect_list(F.struct("place", "digest", "words"))).alias("first"))
    convs = turns.groupBy("conv").agg(F.max("place").alias("own")).withColumn("lead", lead).withColumn("h", borrowed(F.col("conv")))
    convs = convs.join(heads, "lead", "left").withColumn("first", F.slice(F.coalesce("first", F.array().cast("array<struct<place:bigint,digest:string,words:bigint>>")), F.lit(1), F.col("h").cast("int")))
    convs = convs.select("conv", "h", "own", F.size("first").cast("long").alias("taken"), "first")
    lent = convs.select("conv", F.explode("first").alias("t")).select("conv", "t.place", "t.digest", "t.words")
    empty = convs.filter((F.col("taken") == 0) & (F.col("own") <= F.col("h"))).select("conv", F.lit(0).cast("long").alias("place"), F.lit("").alias("digest"), F.lit(0).cast("long").alias("words"))
    own = turns.filter(F.col("place") > borrowed(F.col("conv"))).join(convs.select("conv", "h", "taken"), "conv")
    own = own.select("conv", (F.col("place") - F.col("h") + F.col("taken")).alias("place"), "digest", "words")
    return lent.unionByName(own).unionByName(empty)


def prefixes(sequences: DataFrame) -> DataFrame:
    """Each (conv, place) as the node it reaches: (conv, depth, k1, k2), its parent's p1, p2, words and whether it is the last.

    A prefix is known by two exact sums of its turns' 64-bit hashes, each taken with the place, so a prefix of any length
    costs one addition a turn and two decimals; different sequences of one length agree with a chance of about 2^-126.
    """
    h = [F.when(F.col("place") > 0, F.shiftrightunsigned(F.xxhash64(*c), 1)).otherwise(F.lit(0)).cast("decimal(38,0)") for c in ((F.col("place"), F.col("digest")), (F.lit("second"), F.col("digest"), F.col("place")))]
    rows = sequences.select("conv", F.col("place").alias("depth"), "words", h[0].alias("h1"), h[1].alias("h2"))
    along = Window.partitionBy("conv").orderBy("depth")
    rows = rows.withColumns({f"k{i}": F.sum(f"h{i}").over(along).cast("decimal(38,0)") for i in (1, 2)} | {"last": F.lead("depth").over(along).isNull()})
    return rows.select("conv", *NODE, (F.col("k1") - F.col("h1")).cast("decimal(38,0)").alias("p1"), (F.col("k2") - F.col("h2")).cast("decimal(38,0)").alias("p2"), "words", "last")


def nodes_of(rows: DataFrame) -> DataFrame:
    """Distinct nodes with counts of members and of those that end there; a root above all."""
    aggregates = [F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv_id"), F.count_if("last").alias("n_ends"), F.min(F.when(F.col("last"), F.col("conv"))).alias("an_end"), F.first("words").alias("words")]
    zero = F.lit(0).cast("decimal(38,0)")
    inner = rows.filter("depth > 0").groupBy(*NODE).agg(*aggregates, F.first("p1").alias("p1"), F.first("p2").alias("p2"))
    root = rows.filter("depth <= 1").groupBy().agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv_id"), F.count_if(F.col("depth") == 0).alias("n_ends"), F.min(F.when(F.col("depth") == 0, F.col("conv"))).alias("an_end"))
    root = root.filter("n_convs > 0").select(F.lit(0).cast("long").alias("depth"), zero.alias("k1"), zero.alias("k2"), "n_convs", "conv_id", "n_ends", "an_end", F.lit(0).cast("long").alias("words"), zero.alias("p1"), zero.alias("p2"))
    return inner.unionByName(root)


def with_family(nodes: DataFrame) -> DataFrame:
    """Beside each node its number of children, its parent's conv_id, and whether it heads a chain: whether it has other
    members than its parent. A node that doesn't is its parent's only child, and follows it in preorder."""
    parent = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"), F.col("n_convs").alias("of_parent"))
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count(F.lit(1)).alias("n_children"))
    out = nodes.join(parent, ["depth", "p1", "p2"], "left").join(children, NODE, "left")
    return out.withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))).withColumn("head", (F.col("depth") == 0) | (F.col("n_convs") != F.col("of_parent"))).drop("of_parent")


def head_paths(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """(conv, path of nodes that head chains): each conversation's branchings as (depth, k1, k2, whether the conversation is
    the node's least member), by depth. Turns between branchings play no part in the order of nodes."""
    heads = nodes.filter("head and depth > 0").select(*NODE, "conv_id")
    found = rows.filter("depth > 0").select("conv", *NODE).join(heads, NODE)
    return found.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct(*NODE, (F.col("conv") == F.col("conv_id")).alias("mine")))).alias("heads"))


def step_bytes(k1: Column, k2: Column) -> Column:
    """A branch of a path in sixteen bytes: the order of siblings."""
    return F.unhex(F.md5(F.concat_ws(":", k1.cast("string"), k2.cast("string")).cast("binary")))


def ranked(nodes: DataFrame, paths: DataFrame, work: Work) -> DataFrame:
    """nodes with rank, and prefix sums of leaves and of saved tokens up to and including the node, all in preorder.

    A head's path is its branches' bytes one behind the other, and nodes on its chain share it, so (path, depth) is the
    lexicographic order of nodes. Ranges of it are sorted and summed by themselves, and the sums of the ranges before, one
    row each, are added by a join.
    """
    mine = paths.select("conv", F.explode(F.transform("heads", lambda h, i: F.struct(h["depth"].alias("depth"), h["k1"].alias("k1"), h["k2"].alias("k2"), h["mine"].alias("mine"), F.slice("heads", F.lit(1), i + 1).alias("upto")))).alias("x")).filter("x.mine")
    mine = mine.select("x.depth", "x.k1", "x.k2", F.aggregate(F.transform("x.upto", lambda h: step_bytes(h["k1"], h["k2"])), F.lit(ROOT_PATH), lambda a, b: F.concat(a, b)).alias("path"))
    chain = Window.partitionBy("conv_id").orderBy("depth")
    all_ = nodes.join(mine, NODE, "left").withColumn("path", F.when(F.col("depth") == 0, F.lit(ROOT_PATH)).otherwise(F.col("path")))
    all_ = all_.withColumn("path", F.last("path", ignorenulls=True).over(chain))
    all_ = all_.withColumn("leaf", (F.col("n_children") == 0).cast("long")).withColumn("saving", (F.col("n_convs") - 1) * F.col("words")).drop("p1", "p2", "words", "head")
    cut = all_.repartitionByRange(shuffle_partitions(work.spark), "path", "depth").sortWithinPartitions("path", "depth").drop("path")
    names = cut.columns

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), np.zeros(3, np.int64)
        for batch in batches:
            n = batch.num_rows
            run = np.cumsum([np.ones(n, np.int64), batch.column(names.index("leaf")).to_numpy(), batch.column(names.index("saving")).to_numpy()], axis=1) + at[:, None]
            at = run[:, -1] if n else at
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, part, np.int32)), *map(pa.array, run)], [*names, "part", "rank", "leaves", "savings"])

    schema = ", ".join(f"{n} {t}" for n, t in cut.dtypes) + ", part int, rank long, leaves long, savings long"
    local = work.save("ranges", cut.mapInArrow(sums, schema))
    totals = local.groupBy("part").agg(*(F.max(c).alias(f"{c}_all") for c in ("rank", "leaves")), F.max("savings").alias("savings_all"))
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", *(F.coalesce(F.sum(f"{c}_all").over(before), F.lit(0)).alias(f"{c}_before") for c in ("rank", "leaves", "savings")))
    return local.join(F.broadcast(offsets), "part").select(*names, *((F.col(c) + F.col(f"{c}_before")).alias(c) for c in ("rank", "leaves", "savings")))  # one row for each range


def with_ends(ranks: DataFrame, rows: DataFrame, paths: DataFrame) -> DataFrame:
    """Each node's n_leaves and saved_tokens: prefix sums at its subtree's end less those before itself.

    The last node of a subtree is a leaf, so it is where one of the members ends: the end is the greatest rank of a member's
    last node. Only nodes that head chains have ends of their own; the rest of a chain shares its head's.
    """
    at = F.struct(F.col("rank").alias("rank"), F.col("leaves").alias("leaves"), F.col("savings").alias("savings")).alias("at")
    last = rows.filter("last").select("conv", *NODE).join(ranks.select(*NODE, at), NODE).select("conv", "at")
    of_heads = last.join(paths.select("conv", F.explode("heads").alias("h")), "conv").groupBy("h.depth", "h.k1", "h.k2").agg(F.max("at").alias("end"))
    of_root = last.groupBy().agg(F.max("at").alias("end")).filter("end is not null").select(F.lit(0).cast("long").alias("depth"), *(F.lit(0).cast("decimal(38,0)").alias(k) for k in ("k1", "k2")), "end")
    out = ranks.join(of_heads.unionByName(of_root), NODE, "left").withColumn("end", F.last("end", ignorenulls=True).over(Window.partitionBy("conv_id").orderBy("depth")))
    return out.withColumn("n_leaves", F.col("end.leaves") - F.col("leaves") + F.col("leaf")).withColumn("saved_tokens", F.col("end.savings") - F.col("savings") + F.col("saving")).withColumn("end_rank", F.col("end.rank"))


def end_digests(rows: DataFrame, nodes: DataFrame, work: Work, most: int = 1 << 16) -> DataFrame:
    """(node, digest) of each node where two or more conversations end: SHA-256 of their ascending decimal ids with commas.

    Ids are sorted in ranges of (node, id) and packed there by up to `most`, so a node that a third of all conversations
    end at is a few rows for each range; the digest then reads these one behind the other.
    """
    many = nodes.filter("n_ends > 1").select(*NODE)
    ends = rows.filter("last").select("conv", *NODE).join(many, NODE)
    ends = ends.repartitionByRange(shuffle_partitions(work.spark), *NODE, "conv").sortWithinPartitions(*NODE, "conv")
    node_types = "depth long, k1 decimal(38,0), k2 decimal(38,0)"

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, held, size = None, [], 0

        def flush() -> pa.RecordBatch:
            ids = np.concatenate(held)
            return pa.RecordBatch.from_arrays([pa.array([node[0]], pa.int64()), *(pa.array([k], pa.decimal128(38, 0)) for k in node[1:]), pa.array([int(ids[0])], pa.int64()), pa.array([pack(np.diff(ids, prepend=0))], pa.binary())], [*NODE, "first", "ids"])

        for batch in batches:
            keys, ids = list(zip(*(batch.column(n).to_pylist() for n in NODE), strict=True)), batch.column("conv").to_numpy()
            at = 0
            while at < len(keys):
                to = at
                while to < len(keys) and keys[to] == keys[at]:
                    to += 1
                if keys[at] != node or size >= most:
                    if held:
                        yield flush()
                    node, held, size = keys[at], [], 0
                held.append(ids[at:to])
                size += to - at
                at = to
        if held:
            yield flush()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            keys = list(zip(*(batch.column(n).to_pylist() for n in NODE), strict=True))
            found = []
            for key, data in zip(keys, batch.column("ids").to_pylist(), strict=True):
                if key != node:
                    if node is not None:
                        found.append((*node, digest.hexdigest()))
                    node, digest, comma = key, hashlib.sha256(), ""
                digest.update((comma + ",".join(map(str, np.cumsum(unpack(data, np.int64)).tolist()))).encode())
                comma = ","
            yield table(found)
        if node is not None:
            yield table([(*node, digest.hexdigest())])

    def table(found: list[tuple]) -> pa.RecordBatch:
        types = [pa.int64(), pa.decimal128(38, 0), pa.decimal128(38, 0), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], t) for i, t in enumerate(types)], [*NODE, "digest"])

    parts = work.save("end-ids", ends.mapInArrow(packed, node_types + ", first long, ids binary"))
    return parts.repartition(shuffle_partitions(work.spark), *NODE).sortWithinPartitions(*NODE, "first").mapInArrow(digests, node_types + ", digest string")


def prefix_trie(sequences: DataFrame) -> DataFrame:
    """The nodes of the trie over sequences (conv, place, digest, words), places from 1 without gaps, one row at place 0 for
    an empty sequence: conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256, rank and end_rank (the subtree's interval in preorder)."""
    work = Work(sequences.sparkSession, "trie", python=False)
    rows = work.save("prefixes", prefixes(sequences))
    nodes = work.save("nodes", with_family(work.save("distinct", nodes_of(rows))))
    work.drop("distinct")
    paths = work.save("heads", head_paths(rows, nodes))
    with batches_of(work.spark, 4096):
        ranks = work.save("ranks", ranked(nodes, paths, work))
        work.drop("ranges")
    with batches_of(work.spark, 256):
        digests = work.save("digests", end_digests(rows, nodes, work))
    work.drop("end-ids", "nodes")
    none, one = F.lit(hashlib.sha256(b"").hexdigest()), F.sha2(F.col("an_end").cast("string").cast("binary"), 256)
    out = with_ends(ranks, rows, paths).join(digests, NODE, "left")
    ends = F.when(F.col("n_ends") == 0, none).when(F.col("n_ends") == 1, one).otherwise(F.col("digest"))
    out = work.save("trie", out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", ends.alias("ends_sha256"), "rank", "end_rank"))
    work.drop("prefixes", "heads", "ranks", "digests")
    return out


def conversation_trie(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The prefix trie of all conversations, each rebuilt as in `rebuilt`; one row a node, as in `prefix_trie`.

    Turns are ordered by turn, null first; equal turns by a digest of role and text. Null role or text is empty. Rows without
    a conversation id belong to none and are left out; an empty table gives an empty trie. Other columns play no part.
    What is shuffled has no texts: a turn is a digest and its number of words. A first turn that a third of all conversations
    share is summed in the map tasks where it is counted, and is one side of joins that Spark splits.
    """
    work = Work(conversations.sparkSession, "turns", python=False)
    turns = work.save("turns", numbered_turns(conversations, conv_col, turn_col, role_col, text_col))
    out = prefix_trie(rebuilt(turns))
    work.drop("")
    return out
