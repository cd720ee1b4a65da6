"""The Hilbert curve as a Column: places near one another get near numbers, so that sorted files have small bounds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hilbert(x: Column, y: Column, xmin: float, ymin: float, xmax: float, ymax: float, order: int = 16) -> Column:
    """The place of (x, y) along the curve over a box, in 4^order steps; places outside count as on its edge, null as its start."""
    side = (1 << order) - 1

    def cell(v: Column, low: float, high: float) -> Column:
        at = F.floor((v - low) / ((high - low) or 1.0) * side)
        return F.coalesce(F.greatest(F.lit(0), F.least(F.lit(side), at)), F.lit(0)).cast("long")

    def step(s: Column, bit: Column) -> Column:
        rx, ry = (F.call_function("shiftright", s[v], bit).bitwiseAND(F.lit(1)) for v in ("x", "y"))
        turned = F.when((ry == 0) & (rx == 1), F.struct((side - s["y"]).alias("x"), (side - s["x"]).alias("y"))).when(ry == 0, F.struct(s["y"].alias("x"), s["x"].alias("y"))).otherwise(F.struct(s["x"].alias("x"), s["y"].alias("y")))
        return F.struct(turned["x"].alias("x"), turned["y"].alias("y"), (s["d"] * 4 + (rx * 3).bitwiseXOR(ry)).alias("d"))

    start = F.struct(cell(x, xmin, xmax).alias("x"), cell(y, ymin, ymax).alias("y"), F.lit(0).cast("long").alias("d"))
    return F.aggregate(F.sequence(F.lit(order - 1), F.lit(0), F.lit(-1)), start, step)["d"]
