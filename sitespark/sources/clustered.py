"""Parquet in the order of a Hilbert curve, with the bounds of each shape: a box is answered by the row groups' statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry
from ..functions.overlay import RINGS, combined
from .flatgeobuf import BOX, along_curve


def write_clustered(df: DataFrame, path: str, rings: str, files: int | None = None, group_bytes: int = 8 << 20) -> None:
    """Write df with xmin, ymin, xmax, ymax of its shapes, neighbours together, in row groups of about group_bytes. Null or
    empty shapes have null bounds, and no box finds them."""
    b = geometry.bounds(F.flatten(rings))
    placed = along_curve(df.drop(*BOX), rings, files)
    placed.withColumns({c: b[c] for c in BOX}).write.mode("overwrite").option("parquet.block.size", group_bytes).parquet(path)


def in_box(df: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    """Rows whose bounds meet the box: four comparisons that reach the scan."""
    return df.filter((F.col("xmin") <= box[2]) & (F.col("ymin") <= box[3]) & (F.col("xmax") >= box[0]) & (F.col("ymax") >= box[1]))


def clipped(df: DataFrame, rings: str, box: tuple[float, float, float, float]) -> DataFrame:
    """Rows whose bounds meet the box, their shapes cut to it; shapes wholly inside stay as they are, without Python. What is
    left of a shape may be empty."""
    within = (F.col("xmin") >= box[0]) & (F.col("ymin") >= box[1]) & (F.col("xmax") <= box[2]) & (F.col("ymax") <= box[3])
    frame = F.array(geometry.box_ring(*map(F.lit, box)))
    met = in_box(df, box)
    whole = met.filter(within).withColumn(rings, F.col(rings).cast(RINGS))
    return whole.unionByName(met.filter(~within).withColumn(rings, combined(F.col(rings), frame, "intersection")))
