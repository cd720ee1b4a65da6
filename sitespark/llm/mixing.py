"""Mixing overlapping sources to target weights by a min-cost flow over membership patterns."""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Work

WORDS = "[^\\x20\\x09-\\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def water_fill(sizes: dict, weights: dict, total: float, most: float = 2.0) -> dict:
    """Targets in proportion to the weights that stop at `most` times a source's size, what exceeds it reshared by weight."""
    left, rest, targets = total, sum(weights[s] for s in sizes), {}
    for s in sorted(sizes, key=lambda s: (most * sizes[s] / weights[s], weights[s])):
        level = left / rest if rest else 0.0
        if most * sizes[s] <= level * weights[s]:
            targets[s] = float(most * sizes[s])
            left, rest = left - most * sizes[s], rest - weights[s]
        else:
            targets |= {x: level * weights[x] for x in sizes if x not in targets}
            break
    return targets


class MinCostFlow:
    """Successive shortest paths with potentials; arcs have a capacity and a cost, both integers."""

    def __init__(self, nodes: int):
        self.arcs: list[list[int]] = []  # to, capacity, cost
        self.out: list[list[int]] = [[] for _ in range(nodes)]

    def add(self, a: int, b: int, capacity: int, cost: int) -> int:
        self.out[a].append(len(self.arcs))
        self.arcs.append([b, capacity, cost])
        self.out[b].append(len(self.arcs))
        self.arcs.append([a, 0, -cost])
        return len(self.arcs) - 2

    def run(self, s: int, t: int) -> int:
        n, sent, potential = len(self.out), 0, [0] * len(self.out)
        while True:
            dist, via = [None] * n, [-1] * n
            dist[s], queue = 0, [(0, s)]
            while queue:
                d, u = heapq.heappop(queue)
                if d > dist[u]:
                    continue
                for e in self.out[u]:
                    v, capacity, cost = self.arcs[e]
                    if capacity > 0 and (dist[v] is None or d + cost + potential[u] - potential[v] < dist[v]):
                        dist[v], via[v] = d + cost + potential[u] - potential[v], e
                        heapq.heappush(queue, (dist[v], v))
            if dist[t] is None:
                return sent
            potential = [p + (d if d is not None else dist[t]) for p, d in zip(potential, dist, strict=True)]
            push, v = None, t
            while v != s:
                push = self.arcs[via[v]][1] if push is None else min(push, self.arcs[via[v]][1])
                v = self.arcs[via[v] ^ 1][0]
            v = t
            while v != s:
                self.arcs[via[v]][1] -= push
                self.arcs[via[v] ^ 1][1] += push
                v = self.arcs[via[v] ^ 1][0]
            sent += push


def route(patterns: dict[tuple, int], targets: dict, repeats: int = 2) -> dict[tuple, dict]:
    """Words that each membership pattern gives each source. A pattern can be used `repeats` times; its k-th use costs k
    for each word, so repetition is spread before it is deepened. Targets that no pattern can fill are filled as far as
    the flow goes."""
    out: dict[tuple, dict] = {}
    for group, names in _apart(patterns, targets):
        places = {s: 2 + len(group) + i for i, s in enumerate(names)}
        flow = MinCostFlow(2 + len(group) + len(names))
        arcs = {}
        for i, pattern in enumerate(group):
            for k in range(1, repeats + 1):
                flow.add(0, 2 + i, patterns[pattern], k)
            for s in pattern:
                arcs[pattern, s] = flow.add(2 + i, places[s], repeats * patterns[pattern], 0)
        for s in names:
            flow.add(places[s], 1, round(targets[s]), 0)
        flow.run(0, 1)
        out |= {p: {s: flow.arcs[arcs[p, s] ^ 1][1] for s in p} for p in group}
    return out


def _apart(patterns: dict[tuple, int], targets: dict) -> list[tuple[list, list]]:
    """Patterns and sources in groups that share nothing, which have flows of their own: a source that overlaps with no
    other is a group of one pattern, so many such sources take no longer than one by one."""
    top = {s: s for s in targets}

    def find(s):
        while top[s] != s:
            top[s] = top[top[s]]
            s = top[s]
        return s

    for pattern in patterns:
        for s in pattern[1:]:
            top[find(s)] = find(pattern[0])
    groups: dict = {}
    for s in sorted(targets, key=lambda s: (s is None, s)):
        groups.setdefault(find(s), ([], []))[1].append(s)
    empty = []
    for pattern in patterns:
        (groups[find(pattern[0])][0] if pattern else empty).append(pattern)
    return [*groups.values(), (empty, [])]


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sources_col: str = "source", weights: tuple = (5, 2, 1), share: float = 1.5, repeats: int = 2, seed: int = 0, most_patterns: int = 100_000, bins: int = 1024) -> DataFrame:
    """id, sources, size, source_size, target, copies, taken: which documents fill the sources' targets, and how often.

    sources_col is a string, or an array of strings for documents that belong to several sources. Sizes are words. The
    sources, by code point, null last, weigh `weights` in turn and share `share` times all words; a target stops at
    `repeats` times its source's size, the excess going to the others by weight. Documents are aggregated by membership
    pattern (the driver receives one row per pattern, and refuses more than most_patterns); a min-cost flow with convex
    repetition costs routes the patterns' words to the sources. A pattern that gives f words out of its size n is taken
    f // n times whole, and the rest comes from its documents in the order of a seeded hash, each whole, up to the one
    whose middle the rest reaches. So taken misses what was routed by half a document at most, no document exceeds
    `repeats` times its size, and reruns agree. source_size and target are those of the document's source (sums, if it
    has several).

    A histogram of the hash finds the bin in which each pattern's rest ends, and only that bin's documents are put in
    order, so no task holds a whole source. Null text has size 0 and a document of size 0 takes 0. A null source is a
    source of its own; an empty array is the pattern of none, which is never taken. Repeated ids with the same source
    are ordered by size and are separate rows.
    """
    spark = docs.sparkSession
    work = Work(spark, "mix")
    several = docs.schema[sources_col].dataType.typeName() == "array"
    member = F.sort_array(F.array_distinct(F.coalesce(F.col(sources_col), F.array(F.lit(None).cast("string")))), asc=False) if several else F.array(F.col(sources_col).cast("string"))
    rank = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))
    rows = docs.select(F.col(id_col).alias("id"), member.alias("sources"), word_count(F.col(text_col).cast("string")).alias("size"), rank.alias("rank"))
    rows = work.save("rows", rows)
    by = [(tuple(r["sources"]), int(r["size"] or 0)) for r in rows.groupBy("sources").agg(F.sum("size").alias("size")).limit(most_patterns + 1).collect()]
    if len(by) > most_patterns:
        raise ValueError(f"more than {most_patterns} membership patterns")
    patterns = dict(sorted(by, key=lambda x: [(s is None, s or "") for s in x[0]]))
    names = sorted({s for p in patterns for s in p}, key=lambda s: (s is None, (s or "").encode()))
    sizes = {s: sum(n for p, n in patterns.items() if s in p) for s in names}
    targets = water_fill(sizes, {s: weights[i % len(weights)] for i, s in enumerate(names)}, share * sum(patterns.values()), float(repeats))
    flows = route(patterns, targets, repeats)
    plan = [(list(p), sum(sizes[s] for s in p), float(sum(targets[s] for s in p)), sum(flows[p].values()) // n if n else 0, sum(flows[p].values()) % n if n else 0) for p, n in patterns.items()]
    plan = spark.createDataFrame(plan, "sources array<string>, source_size long, target double, whole int, rest long")
    key = F.coalesce(F.to_json(F.struct("sources"), {"ignoreNullFields": "false"}), F.lit(""))
    plan = F.broadcast(plan.select(key.alias("pattern"), "source_size", "target", "whole", "rest"))  # one row per pattern, bounded above
    rows = rows.withColumn("pattern", key).withColumn("bin", F.expr(f"cast(conv(substring(rank, 1, 8), 16, 10) AS long) % {bins}")).withColumn("bin", F.col("bin").cast("int"))
    ordered = Window.partitionBy("pattern").orderBy("bin")
    binned = rows.groupBy("pattern", "bin").agg(F.sum("size").alias("n")).withColumn("upto", F.sum("n").over(ordered)).join(plan.select("pattern", "rest"), "pattern")
    edge = work.save("edge", binned.filter("upto >= rest AND upto - n < rest").select("pattern", "bin", (F.col("upto") - F.col("n")).alias("before")).groupBy("pattern").agg(F.min(F.struct("bin", "before")).alias("e")))
    at = rows.join(plan, "pattern").join(F.broadcast(edge), "pattern", "left")
    inside = at.filter(F.col("bin") == F.col("e.bin"))
    run = Window.partitionBy("pattern").orderBy("rank", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = inside.withColumn("extra", (F.col("e.before") + F.sum("size").over(run) - F.col("size") / 2 <= F.col("rest")).cast("int"))
    outside = at.filter(F.col("e").isNull() | (F.col("bin") != F.col("e.bin"))).withColumn("extra", F.coalesce((F.col("bin") < F.col("e.bin")).cast("int"), F.lit(0)))
    out = outside.unionByName(inside)
    copies = F.when(F.col("size") > 0, F.least(F.col("whole") + F.col("extra"), F.lit(repeats))).otherwise(F.lit(0))
    return out.select(F.col("id").alias(id_col), "sources", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).cast("long").alias("taken"))


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of docs as often as the mix takes them. Rows that share an id are taken as often as the first of them.
    Other columns may have any name."""
    work = Work(docs.sparkSession, "mixed")
    taken = mix(docs, id_col, **options).filter("copies > 0").groupBy(F.col(id_col).alias("id")).agg(F.max("copies").alias("copies"))
    taken = work.save("taken", taken)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("key"))
    found = rows.join(taken, rows["key"].eqNullSafe(taken["id"]))
    return found.select("row", F.explode(F.sequence(F.lit(1), "copies")).alias("copy")).select("row.*")
