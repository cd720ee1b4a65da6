"""Reason codes of candidates: (code, sign, condition, weight), for rules.reason_codes. Codes, weights and their order are fixed values.

Conditions name columns of the scored table. A distance of 0 counts as unknown in the conditions on distances, as the rules
have it; an unknown footprint is neither low nor high.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .geometry import METRES_PER_MILE


def _within(column: str, miles: float):
    return (F.col(column) > 0) & (F.col(column) <= miles * METRES_PER_MILE)


def _shared() -> dict:
    c = F.col
    return {
        "strong_queue_signal": ("+", c("queue_tier").isin("strong", "very_strong"), 3),
        "interconnection_agreement_executed": ("+", c("ia_nearby"), 3),
        "500kv_anchor_in_range": ("+", _within("d500", 5), 3),
        "345kv_anchor_in_range": ("+", _within("d345", 5), 2),
        "tier1_pipeline_within_5mi": ("+", _within("d_tier1_pipe", 5), 2),
        "class1_rail_within_3mi": ("+", _within("d_rail", 3), 2),
        "low_seismic_risk": ("+", c("seismic_tier").isin("very_low", "low"), 2),
        "within_water_service_area": ("+", c("in_water"), 2),
        "strategic_scale_candidate": ("+", c("acreage_tier") == "strategic_scale", 2),
        "no_queue_activity": ("-", (F.coalesce(c("queue_tier"), F.lit("")) == "negligible") | (c("anchors") == 0), 3),
        "no_executed_ia_in_range": ("-", ~c("ia_nearby") & (c("anchors") > 0), 2),
        "high_seismic_zone": ("-", c("seismic_tier").isin("high", "very_high"), 2),
        "floodway_adjacent_500m": ("-", c("near_floodway"), 2),
        "fema_ae_overlap": ("-", c("flood_overlap"), 2),
        "drought_tier_high": ("-", c("drought").isin("severe_drought", "extreme_drought", "exceptional_drought"), 1),
        "padus_adjacent_500m": ("-", c("near_protected"), 1),
        "wetland_adjacent_500m": ("-", c("near_wetland"), 1),
        "radar_review_flag": ("-", c("radar_review"), 1),
        "queue_anchor_zone_fallback": ("?", c("utility_status") == "zone_fallback", 1),
        "oversized_polygon": ("?", c("size_class") == "region", 1),
        "allocation_risk_possible": ("?", c("heat"), 1),
    }


GREENFIELD = (
    "strong_queue_signal", "interconnection_agreement_executed", "500kv_anchor_in_range", "345kv_anchor_in_range", "tier1_pipeline_within_5mi", "class1_rail_within_3mi",
    "ideal_slope", "low_seismic_risk", "within_water_service_area", "large_fallow_candidate", "strategic_scale_candidate", "building_density_low",
    "building_density_high", "no_queue_activity", "no_executed_ia_in_range", "high_seismic_zone", "floodway_adjacent_500m", "fema_ae_overlap", "elevated_slope_band",
    "drought_tier_high", "padus_adjacent_500m", "wetland_adjacent_500m", "forest_land", "small_candidate", "radar_review_flag",
    "queue_anchor_zone_fallback", "oversized_polygon", "allocation_risk_possible",
)
REUSE = (
    "strong_queue_signal", "interconnection_agreement_executed", "500kv_anchor_in_range", "345kv_anchor_in_range", "tier1_pipeline_within_5mi", "class1_rail_within_3mi",
    "low_seismic_risk", "within_water_service_area", "strategic_scale_candidate", "high_confidence_real_footprint", "decommissioning_timeline_known", "reuse_node_with_grid_anchor",
    "no_queue_activity", "no_executed_ia_in_range", "high_seismic_zone", "floodway_adjacent_500m", "fema_ae_overlap", "drought_tier_high", "padus_adjacent_500m",
    "wetland_adjacent_500m", "radar_review_flag", "reuse_high_contamination_risk", "legacy_asset_decom_risk", "environmental_review_required",
    "queue_anchor_zone_fallback", "oversized_polygon", "allocation_risk_possible", "estimated_footprint_buffered", "multi_parcel_aggregated",
)


def greenfield() -> list:
    c = F.col
    table = _shared() | {
        "ideal_slope": ("+", c("slope_tier") == "ideal", 2),
        "large_fallow_candidate": ("+", (c("cover") == "cropland") & (c("acres") >= 500), 2),
        "building_density_low": ("+", c("footprint") < 0.25, 1),
        "building_density_high": ("-", c("footprint") >= 1.0, 3),
        "elevated_slope_band": ("-", c("slope_tier") == "penalized", 2),
        "forest_land": ("-", c("cover") == "forest", 1),
        "small_candidate": ("-", c("acreage_tier") == "small", 1),
    }
    return [(code, *table[code]) for code in GREENFIELD]


def reuse() -> list:
    c = F.col
    table = _shared() | {
        "high_confidence_real_footprint": ("+", c("geometry_source") == "OSM_POLYGON", 2),
        "decommissioning_timeline_known": ("+", c("decommissioning_known"), 2),
        "reuse_node_with_grid_anchor": ("+", c("source").isin("EIA-860", "EIA-860-nuclear") & (c("anchors") >= 3), 2),
        "reuse_high_contamination_risk": ("-", c("contaminated"), 3),
        "legacy_asset_decom_risk": ("-", c("legacy"), 2),
        "environmental_review_required": ("-", c("review_required"), 1),
        "estimated_footprint_buffered": ("?", c("geometry_source").isin("BUFFER_FROM_ACREAGE", "BUFFER_FROM_CAPACITY"), 1),
        "multi_parcel_aggregated": ("?", c("alias_count") >= 5, 1),
    }
    return [(code, *table[code]) for code in REUSE]
