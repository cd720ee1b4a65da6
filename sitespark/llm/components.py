"""Connected components of a table of links, in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Work


def components(links: DataFrame, work: Work, name: str, rounds: int = 100) -> DataFrame:
    """(node, component) for each node of links (a, b): the least node it reaches.

    Labels start at the least neighbour; each round takes the least label around a node, then the label of that label,
    so chains shorten by halves. Minima combine on the map side, and joins on a hub's label can be split by AQE. Each
    round is written to the shared folder. It ends when no label changes.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter(F.col("a") != F.col("b")).distinct()
    both = work.save(f"{name}-both", both)
    labels = work.save(f"{name}-0", both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")))
    for i in range(1, rounds):
        near = both.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        new = labels.join(near, "node").select("node", "component", F.least("component", "near").alias("to"))
        of = labels.select(F.col("node").alias("to"), F.col("component").alias("next"))
        new = new.join(of, "to", "left").select("node", F.least("to", F.coalesce("next", "to")).alias("component"), (F.least("to", F.coalesce("next", "to")) != F.col("component")).alias("moved"))
        new = work.save(f"{name}-{i}", new)
        work.drop(f"{name}-{i - 1}")
        labels = new.select("node", "component")
        if new.filter("moved").limit(1).count() == 0:
            break
    else:
        raise RuntimeError("components did not settle")
    work.drop(f"{name}-both")
    return labels
