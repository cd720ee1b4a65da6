"""What happens to finished candidates: public land and airports take whole ones, roads are cut out, and what follows from the
acreage is worked out anew."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry, rules
from ..functions.overlay import RINGS, total_area
from . import covers, dissolve, polygons
from .shared import checkpointed, spread

#: Managers and designations of public land, its protection classes, the road margin in metres, the least acreage, and the
#: reasons given: fixed values.
PUBLIC_MANAGERS = ("FED", "DOD", "MIL", "LOC")
PUBLIC_DESIGNATIONS = ("LREC", "MIL", "MPUB", "NRA")
LOW_PROTECTION = ("3", "4")
ROAD_MARGIN = 25.0
LEAST_ACRES = 50.0
AIRPORT, ROADS = "airport_runway_protection_zone_pdf_rule_10", "road_clip_residual_lt_50ac_pdf_rule_10"


def public_land(gap: Column, manager: Column, designation: Column) -> Column:
    """Land of low protection that the public, the military or recreation uses."""
    return rules.true(gap.isin(*LOW_PROTECTION)) & (rules.true(manager.isin(*PUBLIC_MANAGERS)) | rules.true(designation.isin(*PUBLIC_DESIGNATIONS)))


def touching(candidates: DataFrame, key: str, rings: str, zones: DataFrame, zone_rings: str, size: float) -> DataFrame:
    """The keys of candidates that meet any zone, touching included. Where zones lie thick most candidates have their first vertex in
    a cell wholly inside one (operators.covers); pairs are listed for the others only."""
    first = F.flatten(rings)[0]
    at = candidates.select(key, rings, first["x"].cast("double").alias("_x"), first["y"].cast("double").alias("_y"))
    areas = F.filter(zone_rings, lambda r: (F.size(r) > 3) & (r[0] == F.element_at(r, -1)))
    inside = covers.surely(at, zones.select(areas.cast(RINGS).alias("_zone")), covers.polygons("_zone"), "_x", "_y").withColumn("_in", F.lit(True))
    told = checkpointed(at.join(inside.hint("merge"), ["_x", "_y"], "left").drop("_x", "_y"), "told")
    pairs = polygons.meeting(told.filter("_in is null").select(key, rings), zones.select(F.col(zone_rings).alias("_zone")), rings, "_zone", size, columns=[key])
    return told.filter("_in").select(key).unionByName(pairs.select(key)).distinct()


def excluded(candidates: DataFrame, key: str, hit: DataFrame, reason: str | None) -> DataFrame:
    """Candidates with `status` and `status_reason` set where they are hit; the first reason stays."""
    out = candidates.join(hit.select(key, F.lit(True).alias("_hit")), key, "left")
    now = F.coalesce("_hit", F.lit(False)) & (F.coalesce("status", F.lit("")) != "excluded")
    return out.withColumn("status_reason", F.when(now, F.lit(reason)).otherwise(F.col("status_reason"))).withColumn("status", F.when(now, "excluded").otherwise(F.col("status"))).drop("_hit")


def road_clip(candidates: DataFrame, key: str, rings: str, roads: DataFrame, road_lines: str, size: float) -> DataFrame:
    """candidates with roads cut out of their shapes, and area_m2 and area_acres of what is left."""
    segments = roads.select(F.explode(F.flatten(F.transform(road_lines, geometry.segments))).alias("s"))
    around = segments.select(F.array(dissolve.capsule(F.col("s"), F.lit(ROAD_MARGIN))).alias("road"))
    left = dissolve.subtracted(candidates.select(key, rings), key, rings, around, "road", size).select(key, F.col("rings").alias("_left"))
    area = F.coalesce(total_area(F.col(rings)), F.lit(0.0))
    out = candidates.join(left, key).withColumn(rings, F.col("_left")).drop("_left")
    return out.withColumn("area_m2", area).withColumn("area_acres", F.col("area_m2") * geometry.ACRES_PER_M2_ROUNDED)


def recomputed(candidates: DataFrame) -> DataFrame:
    """acreage_tier, acreage_tier_score, size_class, oversized_flag and recommended_action from the present acreage."""
    a, c = F.col("area_acres"), F.col
    out = candidates.withColumns({"acreage_tier": rules.acreage_tier(a), "acreage_tier_score": rules.acreage_score(a).cast("double"), "size_class": rules.size_class(a), "oversized_flag": rules.oversized(a)})
    action = F.when(c("status") == "manual_review", "Manual Review").when(c("status") == "excluded", "Ignore")
    short = (c("composite_score") >= 90) & a.between(500, 5000) & ~c("slope_review_flag") & ~c("oversized_flag") & c("confidence").isin("medium", "high") & (F.coalesce(c("num_anchors"), F.lit(0)) >= 3)
    action = action.when(rules.true(short), "Shortlist").when((c("composite_score") >= 85) & (c("utility_status") == "zone_fallback"), "Utility Desk Check")
    action = action.when((c("composite_score") >= 75) & c("parcel_count").isNull(), "Parcel Pull").when(c("composite_score") >= 65, "Monitor").otherwise("Ignore")
    return out.withColumn("recommended_action", action)


def post_filtered(candidates: DataFrame, key: str, rings: str, lands: DataFrame, airports: DataFrame, roads: DataFrame, size: float) -> DataFrame:
    """The whole chain: every candidate with its final status, reason, shape, acreage and what follows from it.

    Public land and airports exclude what they touch; roads are cut out of the rest, and what is left below 50 acres is
    excluded. lands: rings, gap, manager, designation; airports: rings; roads: lines.
    """
    public, left = lands.filter(public_land(F.col("gap"), F.col("manager"), F.col("designation"))), "coalesce(status, '') <> 'excluded'"
    out = checkpointed(spread(candidates), "candidates")
    out = checkpointed(excluded(out, key, touching(out, key, rings, public, "rings", size), None), "excluded")
    out = checkpointed(excluded(out, key, touching(out.filter(left), key, rings, airports, "rings", size), AIRPORT), "excluded")
    clipped = road_clip(out.filter(left), key, rings, roads, "lines", size)
    small = F.col("area_acres") < LEAST_ACRES
    clipped = clipped.withColumn("status_reason", F.when(small, ROADS).otherwise(F.col("status_reason"))).withColumn("status", F.when(small, "excluded").otherwise(F.col("status")))
    area = total_area(F.col(rings))
    gone = out.filter("status = 'excluded'").withColumn("area_m2", area).withColumn("area_acres", F.col("area_m2") * geometry.ACRES_PER_M2_ROUNDED)
    return recomputed(clipped.unionByName(gone))
