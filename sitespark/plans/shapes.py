"""Queries on polygons and lines, each with equivalent DuckDB SQL, as their shapes have closed forms: diamonds, boxes on a
grid, segments."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry, overlay
from ..operators import polygons, raster
from ..operators.shared import spread
from . import sites
from .sites import ANCHORS, BOXES, SITES, query, table

#: Diamonds around anchors, of half-width h.
_HALF = "8000 + anchor_id % 9 * 3000"
DIAMONDS = f"diamonds AS (SELECT anchor_id, ax, ay, {_HALF} AS h, anchor_id * 37 % 101 AS people FROM anchors)"


def diamonds(spark, d):
    a = sites.anchors(spark, d).selectExpr("anchor_id", "ax", "ay", f"{_HALF} AS h", "anchor_id * 37 % 101 AS people")
    x, y, h = F.col("ax"), F.col("ay"), F.col("h")
    ring = F.array(*[geometry.point(x + i * h, y + j * h) for i, j in ((1, 0), (0, 1), (-1, 0), (0, -1), (1, 0))])
    return a.withColumn("rings", F.array(ring))


@query(f"WITH {SITES}, {ANCHORS}, {DIAMONDS} SELECT site_id, anchor_id FROM sites JOIN diamonds ON abs(sx - ax) + abs(sy - ay) < h")
def sites_in_diamonds(spark, d):
    """Points strictly inside polygons."""
    return polygons.points_in(sites.sites(spark, d).select("site_id", "sx", "sy"), diamonds(spark, d), "sx", "sy", "rings", 20000, columns=["site_id", "anchor_id"])


@query(f"""
WITH {SITES}, {BOXES}, {ANCHORS}, {DIAMONDS} SELECT site_id, anchor_id FROM boxes JOIN diamonds ON greatest(0, xmin - ax, ax - xmax) + greatest(0, ymin - ay, ay - ymax) <= h
""")
def parcels_meeting_diamonds(spark, d):
    """Polygons that intersect polygons, touching included."""
    b = sites.boxes(spark, d).withColumn("box", F.array(geometry.box_ring(F.col("xmin"), F.col("ymin"), F.col("xmax"), F.col("ymax"))))
    return polygons.meeting(b, diamonds(spark, d), "box", "rings", 20000, columns=["site_id", "anchor_id"])


_EDGES = "e AS (SELECT anchor_id, people, ax, ay, h, unnest([[1, 0, 0, 1], [0, 1, -1, 0], [-1, 0, 0, -1], [0, -1, 1, 0]]) AS k FROM diamonds), s AS (SELECT anchor_id, people, ax, ay, h, ax + k[1] * h AS x0, ay + k[2] * h AS y0, ax + k[3] * h AS x1, ay + k[4] * h AS y1 FROM e)"
_FAR = "sqrt(power(sx - x0 - t * (x1 - x0), 2) + power(sy - y0 - t * (y1 - y0), 2))"
_T = "greatest(0.0::DOUBLE, least(1.0::DOUBLE, ((sx - x0) * (x1 - x0) + (sy - y0) * (y1 - y0))::DOUBLE / ((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)))) AS t"


@query(f"""
WITH {SITES}, {ANCHORS}, {DIAMONDS}, {_EDGES}, p AS (SELECT site_id, sx, sy, s.*, {_T} FROM sites, s), q AS (SELECT site_id, anchor_id, min({_FAR}) AS far, bool_or(abs(sx - ax) + abs(sy - ay) < h) AS inside, any_value(people) AS people FROM p GROUP BY 1, 2),
i AS (SELECT site_id, first(anchor_id ORDER BY people DESC, anchor_id) AS anchor_id FROM q WHERE inside GROUP BY 1), n AS (SELECT site_id, first(anchor_id ORDER BY far, anchor_id) AS anchor_id, min(far) AS far FROM q WHERE NOT inside AND far <= 30000 GROUP BY 1)
SELECT sites.site_id, i.site_id IS NOT NULL AS inside, coalesce(i.anchor_id, n.anchor_id) AS anchor_id, round(CASE WHEN i.site_id IS NOT NULL THEN 0 ELSE n.far END, 4) AS distance FROM sites LEFT JOIN i ON i.site_id = sites.site_id LEFT JOIN n ON n.site_id = sites.site_id
""")
def water_districts(spark, d):
    """The containing polygon with most people, else the nearest edge within 30 km."""
    out = polygons.inside_else_nearest(sites.sites(spark, d).select("site_id", "sx", "sy"), diamonds(spark, d), "site_id", "anchor_id", "sx", "sy", "rings", 20000, 30000, "people")
    return out.select("site_id", "inside", "anchor_id", F.round("distance", 4).alias("distance"))


_LINES = "l AS (SELECT c_custkey AS line_id, c_custkey * 6967 % 1000000 AS x0, c_custkey * 50021 % 1000000 AS y0, c_custkey * 6967 % 1000000 + c_custkey * 31 % 40001 - 20000 AS x1, c_custkey * 50021 % 1000000 + c_custkey * 77 % 40001 - 20000 AS y1, c_nationkey % 3 AS tracks FROM customer)"


@query(f"""
WITH {SITES}, {_LINES}, p AS (SELECT site_id, sx, sy, l.*, {_T} FROM sites, l), q AS (SELECT site_id, line_id, tracks, {_FAR} AS far FROM p), r AS (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY far, line_id) AS k FROM q WHERE far <= 10000)
SELECT sites.site_id, line_id, tracks, round(far, 4) AS distance FROM sites LEFT JOIN r ON r.site_id = sites.site_id AND k = 1
""")
def nearest_lines(spark, d):
    """The nearest line within 10 km, with an attribute of it."""
    k = F.col("c_custkey")
    x, y = k * 6967 % 1000000, k * 50021 % 1000000
    line = F.array(F.array(geometry.point(x, y), geometry.point(x + k * 31 % 40001 - 20000, y + k * 77 % 40001 - 20000)))
    lines = table(spark, d, "customer").select(k.alias("line_id"), line.alias("rings"), (F.col("c_nationkey") % 3).alias("tracks"))
    out = polygons.nearest_shape(sites.sites(spark, d).select("site_id", "sx", "sy"), lines, "site_id", "line_id", "sx", "sy", "rings", 10000, ["tracks"], is_area=False)
    return out.select("site_id", "line_id", "tracks", F.round("distance", 4).alias("distance"))


_OVER = "greatest(0, least(xmax, ax + h) - greatest(xmin, ax - h)) * greatest(0, least(ymax, ay + h) - greatest(ymin, ay - h))"


@query(f"""
WITH {SITES}, {BOXES}, x AS (SELECT *, xmin + site_id % 700 AS ax, ymin - site_id % 300 AS ay, 100 + site_id % 900 AS h FROM boxes),
o AS (SELECT site_id, (xmax - xmin) * (ymax - ymin) AS whole, 4 * h * h AS other, {_OVER} AS shared FROM x)
SELECT site_id, round(shared::DOUBLE, 2) AS shared, round((whole - shared)::DOUBLE, 2) AS remaining, round((whole + other - shared)::DOUBLE, 2) AS united FROM o
""")
def parcel_overlays(spark, d):
    """Intersection, difference and union of polygons, and their areas."""
    k = F.col("site_id")
    b = spread(sites.boxes(spark, d)).withColumn("ax", F.col("xmin") + k % 700).withColumn("ay", F.col("ymin") - k % 300).withColumn("h", 100 + k % 900)
    b = b.withColumn("a", F.array(geometry.box_ring(F.col("xmin"), F.col("ymin"), F.col("xmax"), F.col("ymax")))).withColumn("b", F.array(geometry.box_ring(F.col("ax") - F.col("h"), F.col("ay") - F.col("h"), F.col("ax") + F.col("h"), F.col("ay") + F.col("h"))))
    areas = [F.round(overlay.total_area(f), 2).alias(n) for n, f in (("shared", overlay.combined(F.col("a"), F.col("b"), "intersection")), ("remaining", overlay.difference_ladder(F.col("a"), F.col("b"))), ("united", overlay.combined(F.col("a"), F.col("b"), "union")))]
    return b.select("site_id", *areas)


_GRID = "g AS (SELECT p_partkey % 25 AS nation, p_partkey * 7919 % 400 AS x, p_partkey * 1047 % 300 AS y, 1 + p_size % 7 AS w, 1 + p_size % 5 AS h FROM part)"


@query(f"""
WITH {_GRID}, c AS (SELECT DISTINCT nation, unnest(range(x, x + w)) AS cx, y, h FROM g), e AS (SELECT DISTINCT nation, cx, unnest(range(y, y + h)) AS cy FROM c), u AS (SELECT nation, count(*) * 1000000.0::DOUBLE AS united FROM e GROUP BY 1),
s AS (SELECT nation, sum(w * h) * 1000000.0::DOUBLE AS summed FROM g GROUP BY 1)
SELECT nation, round(summed, 2) AS summed, round(united, 2) AS united, round(summed / united, 6) AS overlap_ratio FROM s JOIN u USING (nation)
""")
def dissolved_buffers(spark, d):
    """Union of many polygons by group, and how often they overlap."""
    k, n = F.col("p_partkey"), F.col("p_size")
    x, y = k * 7919 % 400 * 1000, k * 1047 % 300 * 1000
    g = table(spark, d, "part").select((k % 25).alias("nation"), F.array(geometry.box_ring(x, y, x + (1 + n % 7) * 1000, y + (1 + n % 5) * 1000)).alias("rings"))
    out = polygons.dissolved_area(g, "nation", "rings", 16000)
    return out.select("nation", F.round("summed", 2).alias("summed"), F.round("united", 2).alias("united"), F.round(F.col("summed") / F.col("united"), 6).alias("overlap_ratio"))


@query(f"""
WITH {SITES}, {BOXES}, c AS (SELECT *, unnest(range(floor(xmin / 4000.0)::BIGINT, floor(xmax / 4000.0)::BIGINT + 1)) AS cx FROM boxes), e AS (SELECT *, unnest(range(floor(ymin / 4000.0)::BIGINT, floor(ymax / 4000.0)::BIGINT + 1)) AS cy FROM c),
p AS (SELECT site_id, cx, cy, (least(xmax, (cx + 1) * 4000) - greatest(xmin, cx * 4000)) * (least(ymax, (cy + 1) * 4000) - greatest(ymin, cy * 4000)) AS a FROM e)
SELECT substr(sha256(site_id || '|' || cx || '|' || cy), 1, 16) AS piece_id, site_id AS parent_id, round(a::DOUBLE, 2) AS area, round_even(a / 900.0::DOUBLE, 0)::BIGINT AS pixel_count FROM p WHERE a >= 202342
""")
def subdivided_parcels(spark, d):
    """Polygons cut by a 4 km grid with ids, parents, areas and pixels."""
    b = sites.boxes(spark, d).withColumn("box", F.array(geometry.box_ring(F.col("xmin"), F.col("ymin"), F.col("xmax"), F.col("ymax"))))
    return polygons.subdivide(b.select("site_id", "box"), "site_id", "box", 4000, 202342).select("piece_id", "parent_id", F.round("area", 2).alias("area"), "pixel_count")


@query(f"WITH {ANCHORS} SELECT anchor_id, round(16 * power(1000 * (1 + anchor_id % 25), 2) * sin(pi() / 16), 1) AS disc FROM anchors")
def buffer_areas(spark, d):
    """Discs as 32-gons, as buffers are made."""
    a = sites.anchors(spark, d)
    return a.select("anchor_id", F.round(geometry.area(overlay.regular_ring(F.col("ax").cast("double") * 0, F.col("ay").cast("double") * 0, 1000.0 * (1 + F.col("anchor_id") % 25))), 1).alias("disc"))


@query(f"""
WITH {SITES}, g AS (SELECT site_id, i AS row, j AS col, (((sx + j * 100) * 13 + (sy + i * 100) * 7) % 1009)::DOUBLE / 20 AS z, abs(i - 3) + abs(j - 3) <= 1 + site_id % 4 AND site_id % 9 > 0 AS inside FROM sites, range(0, 7) a(i), range(0, 7) b(j)),
w AS (SELECT *, lag(z) OVER r AS x0, lead(z) OVER r AS x1, lag(z) OVER c AS y0, lead(z) OVER c AS y1 FROM g WINDOW r AS (PARTITION BY site_id, row ORDER BY col), c AS (PARTITION BY site_id, col ORDER BY row)),
s AS (SELECT site_id, inside, sqrt(power(CASE WHEN x0 IS NULL THEN (x1 - z) / 100 WHEN x1 IS NULL THEN (z - x0) / 100 ELSE (x1 - x0) / 200 END, 2) + power(CASE WHEN y0 IS NULL THEN (y1 - z) / 100 WHEN y1 IS NULL THEN (z - y0) / 100 ELSE (y1 - y0) / 200 END, 2)) * 100 AS slope FROM w),
a AS (SELECT site_id, count(*) FILTER (inside) AS n_inside, avg(slope) FILTER (inside) AS a1, avg(slope) AS a2, quantile_cont(slope, 0.7) FILTER (inside) AS p1, quantile_cont(slope, 0.7) AS p2, max(slope) FILTER (inside) AS m1, max(slope) AS m2 FROM s GROUP BY 1)
SELECT site_id, n_inside, round(CASE WHEN n_inside > 0 THEN a1 ELSE a2 END, 6) AS average, round(CASE WHEN n_inside > 0 THEN p1 ELSE p2 END, 6) AS p70, round(CASE WHEN n_inside > 0 THEN m1 ELSE m2 END, 6) AS most, CASE WHEN n_inside > 0 THEN p1 ELSE p2 END > 8 AS disqualified FROM a
""")
def sampled_slopes(spark, d):
    """A lattice of heights over each parcel, its gradient, and statistics of the samples inside the parcel."""
    g = sites.sites(spark, d).withColumn("row", F.explode(F.sequence(F.lit(0), F.lit(6)))).withColumn("col", F.explode(F.sequence(F.lit(0), F.lit(6))))
    height = (((F.col("sx") + F.col("col") * 100) * 13 + (F.col("sy") + F.col("row") * 100) * 7) % 1009).cast("double") / 20
    inside = (F.abs(F.col("row") - 3) + F.abs(F.col("col") - 3) <= 1 + F.col("site_id") % 4) & (F.col("site_id") % 9 > 0)
    out = raster.sampled_slope(g.select(F.col("site_id").alias("tile"), "row", "col", height.alias("value"), inside.alias("inside")), 100, 100)
    return out.select(F.col("tile").alias("site_id"), "n_inside", F.round("avg", 6).alias("average"), F.round("p70", 6).alias("p70"), F.round("most", 6).alias("most"), "disqualified")
