"""The whole scoring chains for new sites and for reuse nodes over the star schema, each with equivalent DuckDB SQL.

What the reference takes from its layers is derived from keys by integer arithmetic, in expressions both engines read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import reasons, rules
from ..operators import covers
from ..operators.shared import checkpointed
from . import sites
from .sites import query

MILE = 1609.34

#: Of each candidate: expressions that both engines read. k is the part's key.
CANDIDATE = [
    ("site_id", "k"), ("sx", "k * 7919 % 1000000"), ("sy", "k * 104729 % 1000000"), ("acres", "50 + k * 31 % 6000"),
    ("cover", "CASE k % 5 WHEN 0 THEN 'cropland' WHEN 1 THEN 'grassland' WHEN 2 THEN 'shrub_barren' WHEN 3 THEN 'forest' END"),
    ("slope_mean", "CASE WHEN k % 11 > 0 THEN CAST(k * 13 % 180 AS DOUBLE) / 10 END"), ("slope_max", "CASE WHEN k % 11 > 0 THEN CAST(k * 13 % 180 + k * 7 % 60 AS DOUBLE) / 10 END"),
    ("pga", "CASE WHEN k % 13 > 0 THEN CAST(k * 29 % 120 AS DOUBLE) / 100 END"), ("drought_level", "CASE WHEN k % 6 > 0 THEN k % 6 - 1 END"),
    ("footprint", "CASE WHEN k % 7 > 0 THEN CAST(k * 17 % 700 AS DOUBLE) / 100 END"), ("buildable_ratio", "CASE WHEN k % 17 > 0 THEN CAST(k * 19 % 100 AS DOUBLE) / 100 END"),
    ("d_floodway", "CASE WHEN k % 3 > 0 THEN CAST(k * 37 % 2000 AS DOUBLE) END"), ("d_wetland", "CASE WHEN k % 4 > 0 THEN CAST(k * 41 % 9000 AS DOUBLE) END"),
    ("d_protected", "CASE WHEN k % 5 > 0 THEN CAST(k * 43 % 9000 AS DOUBLE) END"), ("d_radar", "CASE WHEN k % 6 > 1 THEN CAST(k * 47 % 20000 AS DOUBLE) END"),
    ("d500", "CASE WHEN k % 3 > 0 THEN CAST(k * 53 % 45000 AS DOUBLE) END"), ("d345", "CASE WHEN k % 4 > 0 THEN CAST(k * 59 % 45000 AS DOUBLE) END"),
    ("d230", "CASE WHEN k % 8 > 1 THEN CAST(k * 61 % 45000 AS DOUBLE) END"), ("d_pipe", "CASE WHEN k % 9 > 0 THEN CAST(k * 67 % 90000 AS DOUBLE) END"),
    ("pipe_operator", "CASE WHEN k % 3 = 0 THEN 'tier_1' ELSE 'other' END"), ("inches", "CASE WHEN k % 4 > 0 THEN k * 3 % 32 END"),
    ("d_rail", "CASE WHEN k % 10 > 0 THEN CAST(k * 71 % 50000 AS DOUBLE) END"), ("strategic", "k % 3 = 1"), ("tracks", "k % 4"),
    ("in_water", "k % 5 = 0"), ("d_water", "CASE WHEN k % 5 = 0 THEN CAST(0 AS DOUBLE) WHEN k % 7 > 0 THEN CAST(k * 73 % 30000 AS DOUBLE) END"), ("people", "k * 79 % 90000"),
]
CANDIDATES = "SELECT " + ", ".join(f"{e} AS {n}" for n, e in CANDIDATE) + " FROM (SELECT p_partkey AS k FROM part)"


def candidates(spark: SparkSession, d: str) -> DataFrame:
    return sites.table(spark, d, "part").select(F.col("p_partkey").alias("k")).selectExpr(*[f"{e} AS {n}" for n, e in CANDIDATE])


def anchor_stats(spark: SparkSession, d: str) -> DataFrame:
    """Queue statistics of each anchor: projects are its order lines."""
    line = sites.table(spark, d, "lineitem")
    active = F.col("l_linestatus") == "O"
    stats = line.groupBy(F.col("l_suppkey").alias("anchor_id")).agg(
        F.sum(F.when(active, F.col("l_quantity")).otherwise(0)).cast("long").alias("all_mw"),
        F.count_if(active & (F.col("l_returnflag") == "N") & (F.col("l_quantity") > 49)).alias("active"),
        F.count_if(~active & (F.col("l_returnflag") == "R") & (F.col("l_quantity") > 48)).alias("suspended"),
        F.count_if(F.col("l_returnflag") == "R").alias("withdrawn"),
        F.coalesce(F.bool_or(active & (F.col("l_quantity") == 50) & (F.col("l_linenumber") > 4)), F.lit(False)).alias("agreement"),
    )
    a = sites.anchors(spark, d).join(stats, "anchor_id", "left")
    k = F.col("anchor_id")
    method = F.get(F.array(*map(F.lit, ("exact", "fuzzy_high", "fuzzy_high_endpoint", "fuzzy_medium", "fuzzy_low"))), (k % 6).cast("int"))
    a = a.withColumn("mw", F.coalesce("all_mw", F.lit(0)) % 260).withColumn("line_fraction", (k % 10).cast("double") / 10).withColumn("match", rules.match_confidence(method))
    a = a.withColumn("tier", rules.mw_tier(F.col("mw"))).withColumn("best", rules.queue_status_best(F.col("agreement"), F.col("active"), F.col("suspended")))
    return a.withColumn("base10", (rules.mw_score(F.col("tier")) * 6 + rules.status_score(F.col("best")) * 4).cast("long")).withColumn("withdrawn", F.coalesce("withdrawn", F.lit(0)))


ANCHOR_STATS = f"""{sites.ANCHORS}, stats AS (SELECT l_suppkey AS anchor_id, coalesce(sum(l_quantity) FILTER (l_linestatus = 'O'), 0)::BIGINT AS all_mw,
  count(*) FILTER (l_linestatus = 'O' AND l_returnflag = 'N' AND l_quantity > 49) AS active, count(*) FILTER (l_linestatus <> 'O' AND l_returnflag = 'R' AND l_quantity > 48) AS suspended,
  count(*) FILTER (l_returnflag = 'R') AS withdrawn, coalesce(bool_or(l_linestatus = 'O' AND l_quantity = 50 AND l_linenumber > 4), false) AS agreement FROM lineitem GROUP BY 1),
named AS (SELECT a.*, coalesce(all_mw, 0) % 260 AS mw, (a.anchor_id % 10)::DOUBLE / 10 AS line_fraction, CASE a.anchor_id % 6 WHEN 0 THEN 'high' WHEN 1 THEN 'high' WHEN 2 THEN 'medium' WHEN 3 THEN 'medium' WHEN 4 THEN 'low' END AS match,
  CASE WHEN agreement THEN 'executed_ia' WHEN active > 0 THEN 'in_study' WHEN suspended > 0 THEN 'suspended' ELSE 'no_active' END AS best, coalesce(withdrawn, 0) AS withdrawn FROM anchors a LEFT JOIN stats s ON s.anchor_id = a.anchor_id),
tiers AS (SELECT *, CASE WHEN mw < 25 THEN 'negligible' WHEN mw < 50 THEN 'weak' WHEN mw < 100 THEN 'moderate' WHEN mw < 200 THEN 'strong' ELSE 'very_strong' END AS tier FROM named),
anchored AS (SELECT *, (CASE tier WHEN 'weak' THEN 25 WHEN 'moderate' THEN 50 WHEN 'strong' THEN 75 WHEN 'very_strong' THEN 100 ELSE 0 END * 6
  + CASE best WHEN 'executed_ia' THEN 100 WHEN 'in_study' THEN 67 WHEN 'suspended' THEN 37 ELSE 0 END * 4)::BIGINT AS base10 FROM tiers)"""


@query(f"WITH {ANCHOR_STATS} SELECT anchor_id, mw, tier, best, match, base10 / 10 AS signal, withdrawn FROM anchored")
def anchor_signal(spark, d):
    """Queue tiers, best status and signal score of every anchor."""
    return anchor_stats(spark, d).select("anchor_id", "mw", "tier", "best", "match", (F.col("base10") / 10).alias("signal"), "withdrawn")


def anchor_summary(spark: SparkSession, d: str, places: DataFrame, cap: int | None = None) -> DataFrame:
    """Of each place: anchors within 50 km, their contributions in ten-millionths (capped for each anchor if asked),
    the primary one, and what happens within 25 km."""
    band = F.col("band")
    near = band <= 3
    a = anchor_stats(spark, d)
    a = checkpointed(a.select("anchor_id", "ax", "ay", "tier", "match", "kv", "base10", "mw", "withdrawn", (F.col("best") == "executed_ia").alias("agreed"), (F.col("base10") * rules.voltage_percent(F.col("kv")) * rules.confidence_percent(F.col("match"), F.col("line_fraction"))).alias("worth")), "anchors")
    given = F.col("worth") * rules.lookup(band, {1: 100, 2: 67, 3: 33}, 10)
    used = F.least(given, F.lit(cap * 10_000_000)) if cap else given
    rings = covers.discs("ax", "ay", [25_000_000, 100_000_000, 625_000_000, 2_500_000_000])
    found = covers.folded(places, a, rings, "sx", "sy", {
        "n": ("sum", F.lit(1)), "total": ("sum", used), "p": ("min", F.struct((-given).alias("g"), "anchor_id", "tier", "match", "band")),
        "activity10": ("sum", F.when(near, F.col("base10")).otherwise(0)), "mw_nearby": ("sum", F.when(near, F.col("mw")).otherwise(0)), "n_near": ("sum", F.when(near, 1).otherwise(0)),
        "n_agreed": ("sum", F.when(near & F.col("agreed"), 1).otherwise(0)), "withdrawals": ("sum", F.when(near, F.col("withdrawn")).otherwise(0)),
    })
    out = places.join(found.hint("merge"), ["sx", "sy"], "left").withColumn("anchors", F.coalesce("n", F.lit(0)))
    heat = (F.coalesce("mw_nearby", F.lit(0)) > 500) & (F.col("n_agreed") / F.greatest("n_near", F.lit(1)) < 0.3)
    return out.select(
        *places.columns, "anchors", (F.col("anchors") == 0).alias("zone_fallback"), F.col("p.anchor_id").alias("primary_anchor"), F.col("p.tier").alias("queue_tier"), F.col("p.match").alias("anchor_match"),
        rules.distance_band(rules.lookup(F.col("p.band"), {1: 5000, 2: 10_000, 3: 25_000, 4: 50_000}, None)).alias("distance_band"), F.least(F.lit(100.0), F.coalesce("total", F.lit(0)) / 10_000_000.0).alias("utility"),
        F.least(F.lit(100.0), F.coalesce("activity10", F.lit(0)) / 10.0).alias("activity"), F.coalesce("mw_nearby", F.lit(0)).alias("mw_nearby"), F.coalesce(F.col("n_agreed") > 0, F.lit(False)).alias("ia_nearby"),
        F.coalesce("withdrawals", F.lit(0)).alias("withdrawals"), rules.true(heat).alias("heat"), F.when(F.col("anchors") > 0, "complete").otherwise("zone_fallback").alias("utility_status"),
    )


def _summary_sql(places: str, cap: int | None = None) -> str:
    used = f"least(given, {cap * 10_000_000})" if cap else "given"
    return f"""pairs AS (SELECT site_id, a.*, (sx - ax) * (sx - ax) + (sy - ay) * (sy - ay) AS d2 FROM {places} c, anchored a WHERE (sx - ax) * (sx - ax) + (sy - ay) * (sy - ay) <= 2500000000),
given AS (SELECT *, base10 * CASE WHEN kv >= 500 THEN 120 WHEN kv >= 345 THEN 110 WHEN kv >= 230 THEN 105 ELSE 100 END * CASE WHEN d2 <= 25000000 THEN 100 WHEN d2 <= 100000000 THEN 67 WHEN d2 <= 625000000 THEN 33 ELSE 10 END
  * CASE WHEN line_fraction > 0.5 THEN CASE match WHEN 'high' THEN 80 WHEN 'medium' THEN 56 ELSE 40 END ELSE CASE match WHEN 'high' THEN 100 WHEN 'medium' THEN 70 ELSE 50 END END AS given FROM pairs),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY given DESC, anchor_id) AS place FROM given) WHERE place = 1),
found AS (SELECT site_id, count(*) AS anchors, sum({used})::BIGINT AS total, coalesce(sum(base10) FILTER (d2 <= 625000000), 0)::BIGINT AS activity10, coalesce(sum(mw) FILTER (d2 <= 625000000), 0)::BIGINT AS mw_nearby,
  count(*) FILTER (d2 <= 625000000) AS n_near, count(*) FILTER (d2 <= 625000000 AND best = 'executed_ia') AS n_agreed, coalesce(sum(withdrawn) FILTER (d2 <= 625000000), 0)::BIGINT AS withdrawals FROM given GROUP BY 1),
summary AS (SELECT c.*, coalesce(anchors, 0) AS anchors, f.site_id IS NULL AS zone_fallback, b.anchor_id AS primary_anchor, b.tier AS queue_tier, b.match AS anchor_match,
  CASE WHEN b.d2 <= 25000000 THEN 'strong' WHEN b.d2 <= 100000000 THEN 'moderate' WHEN b.d2 <= 625000000 THEN 'weak' WHEN b.d2 IS NOT NULL THEN 'regional' ELSE 'out_of_range' END AS distance_band,
  least(100, coalesce(total, 0) / 10000000.0::DOUBLE) AS utility, least(100, coalesce(activity10, 0) / 10.0::DOUBLE) AS activity, coalesce(mw_nearby, 0) AS mw_nearby, coalesce(n_agreed, 0) > 0 AS ia_nearby, coalesce(withdrawals, 0) AS withdrawals,
  coalesce(mw_nearby > 500 AND n_agreed < 0.3 * n_near, false) AS heat, CASE WHEN f.site_id IS NULL THEN 'zone_fallback' ELSE 'complete' END AS utility_status
  FROM {places} c LEFT JOIN found f USING (site_id) LEFT JOIN best b ON b.site_id = c.site_id)"""


@query(f"""
WITH c AS ({CANDIDATES}), {ANCHOR_STATS}, {_summary_sql("c")}
SELECT site_id, anchors, zone_fallback, primary_anchor, queue_tier, anchor_match, distance_band, round(utility, 4) AS utility, round(activity, 2) AS activity, mw_nearby, ia_nearby, withdrawals, heat, utility_status FROM summary
""")
def hot_nodes(spark, d):
    """Anchors, primary anchor and hot-node fields of every candidate, with the default row where there is no anchor."""
    out = anchor_summary(spark, d, candidates(spark, d))
    return out.select("site_id", "anchors", "zone_fallback", "primary_anchor", "queue_tier", "anchor_match", "distance_band", F.round("utility", 4).alias("utility"), F.round("activity", 2).alias("activity"), "mw_nearby", "ia_nearby", "withdrawals", "heat", "utility_status")


def _scored(c: DataFrame) -> DataFrame:
    """Tiers, flags and the two sub-scores that new sites and reuse nodes share."""
    col = F.col
    c = c.withColumn("acreage_tier", rules.acreage_tier(col("acres"))).withColumn("size_class", rules.size_class(col("acres"))).withColumn("slope_tier", rules.slope_tier(col("slope_mean"), col("slope_max")))
    c = c.withColumn("seismic_tier", F.when(col("pga").isNotNull(), rules.seismic_tier(col("pga")))).withColumn("drought", rules.drought_label(col("drought_level")))
    c = c.withColumn("near_floodway", rules.near(col("d_floodway"))).withColumn("flood_overlap", rules.touches(col("d_floodway"))).withColumn("near_wetland", rules.near(col("d_wetland"))).withColumn("near_protected", rules.near(col("d_protected"))).withColumn("radar_review", rules.near(col("d_radar"), 3 * MILE))
    c = c.withColumn("pipe_tier", rules.pipeline_tier(col("pipe_operator"), col("inches"))).withColumn("d_tier1_pipe", F.when(col("pipe_tier").startswith("tier_1"), col("d_pipe")))
    infra = rules.infrastructure(rules.transmission_score(col("d500"), col("d345"), col("d230")), rules.pipeline_score(col("pipe_tier"), col("d_pipe")), rules.rail_score(col("d_rail"), col("strategic"), col("tracks")), rules.water_score(col("in_water"), col("d_water"), col("people")))
    risk = rules.dev_risk(col("seismic_tier"), col("drought"), col("d_radar") / MILE, col("d_protected"), col("d_wetland"), col("d_floodway"))
    return c.withColumn("infra", infra).withColumn("risk", risk)


def _band_sql(d: str, bands: list[tuple[float, int]], last: int, null: int) -> str:
    return f"CASE WHEN {d} IS NULL THEN {null} " + " ".join(f"WHEN {d} <= {m} * {MILE}::DOUBLE THEN {s}" for m, s in bands) + f" ELSE {last} END"


def _far_sql(d: str, far: float, scores: tuple[int, int, int]) -> str:
    return f"CASE WHEN {d} IS NULL OR {d} > {far}::DOUBLE THEN 100 WHEN {d} >= 500 THEN {scores[0]} WHEN {d} >= 100 THEN {scores[1]} ELSE {scores[2]} END"


_LOWER = [(0, 90), (1, 80), (3, 65), (5, 45), (10, 25), (25, 10)]
_SCORED_SQL = f"""tiered AS (SELECT *, CASE WHEN acres < 100 THEN 'small' WHEN acres < 250 THEN 'moderate' WHEN acres < 500 THEN 'large' WHEN acres < 1000 THEN 'very_large' ELSE 'strategic_scale' END AS acreage_tier,
  CASE WHEN acres < 100 THEN 50 WHEN acres < 250 THEN 70 WHEN acres < 500 THEN 85 WHEN acres < 1000 THEN 95 ELSE 100 END AS acreage_score, CASE WHEN acres < 500 THEN 'site' WHEN acres < 5000 THEN 'campus' ELSE 'region' END AS size_class,
  CASE WHEN slope_mean IS NULL OR slope_max IS NULL THEN 'unknown' WHEN slope_mean <= 5 AND slope_max <= 5 THEN 'ideal' WHEN slope_mean <= 8 AND slope_max <= 8 THEN 'acceptable' ELSE 'penalized' END AS slope_tier,
  CASE WHEN pga < 0.10 THEN 'very_low' WHEN pga < 0.25 THEN 'low' WHEN pga < 0.50 THEN 'moderate' WHEN pga < 1.0 THEN 'high' WHEN pga IS NOT NULL THEN 'very_high' END AS seismic_tier,
  CASE drought_level WHEN 0 THEN 'abnormally_dry' WHEN 1 THEN 'moderate_drought' WHEN 2 THEN 'severe_drought' WHEN 3 THEN 'extreme_drought' WHEN 4 THEN 'exceptional_drought' ELSE 'no_drought' END AS drought,
  coalesce(d_floodway, 1e9) < 500 AS near_floodway, coalesce(d_floodway, 1e9) <= 0 AS flood_overlap, coalesce(d_wetland, 1e9) < 500 AS near_wetland, coalesce(d_protected, 1e9) < 500 AS near_protected, coalesce(d_radar, 1e9) < 3 * {MILE}::DOUBLE AS radar_review,
  CASE WHEN pipe_operator = 'tier_1' THEN 'tier_1' WHEN inches IS NULL THEN 'other' WHEN inches >= 20 THEN 'tier_1_by_diameter' WHEN inches >= 14 THEN 'tier_2' ELSE 'other' END AS pipe_tier FROM summary),
scored AS (SELECT *, CASE WHEN pipe_tier LIKE 'tier\\_1%' ESCAPE '\\' THEN d_pipe END AS d_tier1_pipe,
  0.35::DOUBLE * greatest(({_band_sql("d500", [(0, 100), (1, 90), (3, 75), (5, 55), (10, 35), (25, 15)], 0, 0)})::DOUBLE, ({_band_sql("d345", _LOWER, 0, 0)})::DOUBLE, 0.5::DOUBLE * ({_band_sql("d230", _LOWER, 0, 0)}))
  + 0.25::DOUBLE * CASE WHEN pipe_tier LIKE 'tier\\_1%' ESCAPE '\\' THEN {_band_sql("d_pipe", [(5, 100), (10, 70), (25, 40), (50, 15)], 0, 0)} WHEN pipe_tier = 'tier_2' THEN {_band_sql("d_pipe", [(5, 75), (10, 50), (25, 25), (50, 10)], 0, 0)} ELSE {_band_sql("d_pipe", [(5, 50), (10, 30), (25, 15), (50, 5)], 0, 0)} END
  + 0.20::DOUBLE * CASE WHEN d_rail IS NULL THEN 5 ELSE least(100, {_band_sql("d_rail", [(1, 100), (3, 80), (5, 60), (10, 40), (25, 20)], 5, 5)} + CASE WHEN strategic THEN 10 ELSE 0 END + CASE WHEN tracks >= 2 THEN 5 ELSE 0 END) END
  + 0.20::DOUBLE * least(100, CASE WHEN in_water THEN 100 ELSE {_band_sql("d_water", [(1, 75), (5, 50), (15, 25)], 5, 5)} END + CASE WHEN people > 50000 THEN 10 WHEN people > 10000 THEN 5 ELSE 0 END) AS infra,
  0.25::DOUBLE * CASE seismic_tier WHEN 'very_low' THEN 100 WHEN 'low' THEN 80 WHEN 'moderate' THEN 55 WHEN 'high' THEN 30 WHEN 'very_high' THEN 10 ELSE 80 END
  + 0.20::DOUBLE * CASE drought_level WHEN 0 THEN 85 WHEN 1 THEN 70 WHEN 2 THEN 50 WHEN 3 THEN 30 WHEN 4 THEN 10 ELSE 100 END
  + 0.15::DOUBLE * CASE WHEN d_radar IS NULL OR d_radar / {MILE}::DOUBLE > 10 THEN 100 WHEN d_radar / {MILE}::DOUBLE > 5 THEN 85 WHEN d_radar / {MILE}::DOUBLE > 3 THEN 60 ELSE 30 END
  + 0.15::DOUBLE * {_far_sql("d_protected", 8047, (85, 60, 30))} + 0.15::DOUBLE * {_far_sql("d_wetland", 8047, (85, 60, 35))} + 0.10::DOUBLE * {_far_sql("d_floodway", MILE, (80, 50, 25))} AS risk FROM tiered)"""

_PLUS = """CASE WHEN queue_tier IN ('strong', 'very_strong') THEN {'w': 3, 'c': 'strong_queue_signal'} END, CASE WHEN ia_nearby THEN {'w': 3, 'c': 'interconnection_agreement_executed'} END,
  CASE WHEN d500 > 0 AND d500 <= 5 * 1609.34::DOUBLE THEN {'w': 3, 'c': '500kv_anchor_in_range'} END, CASE WHEN d345 > 0 AND d345 <= 5 * 1609.34::DOUBLE THEN {'w': 2, 'c': '345kv_anchor_in_range'} END,
  CASE WHEN d_tier1_pipe > 0 AND d_tier1_pipe <= 5 * 1609.34::DOUBLE THEN {'w': 2, 'c': 'tier1_pipeline_within_5mi'} END, CASE WHEN d_rail > 0 AND d_rail <= 3 * 1609.34::DOUBLE THEN {'w': 2, 'c': 'class1_rail_within_3mi'} END"""
_RISKS = """CASE WHEN queue_tier = 'negligible' OR anchors = 0 THEN {'w': 3, 'c': 'no_queue_activity'} END, CASE WHEN NOT ia_nearby AND anchors > 0 THEN {'w': 2, 'c': 'no_executed_ia_in_range'} END,
  CASE WHEN seismic_tier IN ('high', 'very_high') THEN {'w': 2, 'c': 'high_seismic_zone'} END, CASE WHEN near_floodway THEN {'w': 2, 'c': 'floodway_adjacent_500m'} END, CASE WHEN flood_overlap THEN {'w': 2, 'c': 'fema_ae_overlap'} END"""
_DRY = """CASE WHEN drought_level >= 2 THEN {'w': 1, 'c': 'drought_tier_high'} END, CASE WHEN near_protected THEN {'w': 1, 'c': 'padus_adjacent_500m'} END, CASE WHEN near_wetland THEN {'w': 1, 'c': 'wetland_adjacent_500m'} END"""
_RADAR = "CASE WHEN radar_review THEN {'w': 1, 'c': 'radar_review_flag'} END"
_OPEN = "CASE WHEN utility_status = 'zone_fallback' THEN {'w': 1, 'c': 'queue_anchor_zone_fallback'} END, CASE WHEN size_class = 'region' THEN {'w': 1, 'c': 'oversized_polygon'} END, CASE WHEN heat THEN {'w': 1, 'c': 'allocation_risk_possible'} END"
_SEISMIC = "CASE WHEN seismic_tier IN ('very_low', 'low') THEN {'w': 2, 'c': 'low_seismic_risk'} END, CASE WHEN in_water THEN {'w': 2, 'c': 'within_water_service_area'} END"
_SCALE = "CASE WHEN acreage_tier = 'strategic_scale' THEN {'w': 2, 'c': 'strategic_scale_candidate'} END"


def _ranked(rules_sql: str) -> str:
    """Codes by falling weight; equal weights keep their order."""
    kept = f"list_filter([{rules_sql}], lambda x: x IS NOT NULL)"
    return " || ".join(f"list_transform(list_filter({kept}, lambda x: x.w = {w}), lambda x: x.c)" for w in (3, 2, 1))


def _codes_sql(source: str, plus: str, minus: str, query_: str) -> str:
    return f"""listed AS (SELECT *, {_ranked(plus)} AS p, {_ranked(minus)} AS m, {_ranked(query_)} AS q FROM {source}),
first AS (SELECT *, p[1:3] || m[1:2] AS base FROM listed), second AS (SELECT *, CASE WHEN len(q) = 0 THEN base WHEN len(base) >= 5 THEN base[1:4] || q[1:1] ELSE base || q[1:1] END AS got FROM first),
coded AS (SELECT *, array_to_string(CASE WHEN len(got) >= 3 THEN got ELSE (got || p[4:] || m[3:] || q[2:])[1:3] END, ',') AS codes FROM second)"""


@query(f"""
WITH c AS ({CANDIDATES}), {ANCHOR_STATS}, {_summary_sql("c")}, {_SCORED_SQL},
built AS (SELECT *, 0.35::DOUBLE * CASE cover WHEN 'grassland' THEN 90 WHEN 'shrub_barren' THEN 80 WHEN 'cropland' THEN 65 WHEN 'forest' THEN 45 ELSE 50 END + 0.25::DOUBLE * acreage_score
  + 0.25::DOUBLE * CASE slope_tier WHEN 'ideal' THEN 100 WHEN 'acceptable' THEN 80 WHEN 'penalized' THEN 50 END
  + 0.15::DOUBLE * greatest(0, 100 - CASE WHEN flood_overlap THEN 30 WHEN near_floodway THEN 10 ELSE 0 END - CASE WHEN footprint IS NULL THEN 120 WHEN footprint < 0.25 THEN 0 WHEN footprint < 1 THEN 10 WHEN footprint < 5 THEN 40 WHEN footprint < 15 THEN 90 ELSE 120 END) AS build,
  concat_ws(';', CASE WHEN footprint > 5 THEN 'building_footprint_>5pct' END, CASE WHEN slope_mean > 15 THEN 'slope_>15pct' END, CASE WHEN buildable_ratio < 0.25 THEN 'buildable_ratio_<25pct' END) AS gate FROM scored),
gated AS (SELECT *, (0.40::DOUBLE * utility + 0.20::DOUBLE * build + 0.15::DOUBLE * infra + 0.15::DOUBLE * risk) / 0.90::DOUBLE AS composite,
  CASE WHEN slope_max > 15 THEN 'excluded' WHEN gate <> '' THEN 'manual_review' ELSE 'pass' END AS status, CASE WHEN slope_max > 15 THEN 'slope_max_gt_15_pct_pdf_rule_13' || CASE WHEN gate <> '' THEN ' (prior_reason: ' || gate || ')' ELSE '' END WHEN gate <> '' THEN gate END AS reason,
  list_filter(['site_control', CASE WHEN primary_anchor IS NULL OR utility_status = 'failed' THEN 'utility' END, CASE WHEN cover IS NULL THEN 'land_cover' END, CASE WHEN slope_mean IS NULL THEN 'slope' END, CASE WHEN pga IS NULL THEN 'seismic' END,
   CASE WHEN drought_level IS NULL THEN 'drought' END, CASE WHEN d500 IS NULL AND d345 IS NULL AND d230 IS NULL THEN 'transmission' END, CASE WHEN d_pipe IS NULL THEN 'pipeline' END, CASE WHEN d_rail IS NULL THEN 'rail' END, CASE WHEN d_water IS NULL THEN 'water' END], lambda x: x IS NOT NULL) AS missing FROM built),
sure AS (SELECT *, least(CASE len(missing) WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END, CASE anchor_match WHEN 'high' THEN 2 WHEN 'medium' THEN 1 ELSE 0 END,
  CASE WHEN (utility >= 50)::INT + coalesce(build >= 50, false)::INT + (infra >= 50)::INT + (risk >= 50)::INT >= 3 THEN 2 WHEN (utility >= 50)::INT + coalesce(build >= 50, false)::INT + (infra >= 50)::INT + (risk >= 50)::INT = 2 THEN 1 ELSE 0 END) AS sure FROM gated),
{_codes_sql("sure", _PLUS + ", CASE WHEN slope_tier = 'ideal' THEN {'w': 2, 'c': 'ideal_slope'} END, " + _SEISMIC + ", CASE WHEN cover = 'cropland' AND acres >= 500 THEN {'w': 2, 'c': 'large_fallow_candidate'} END, " + _SCALE + ", CASE WHEN footprint < 0.25 THEN {'w': 1, 'c': 'building_density_low'} END",
  "CASE WHEN footprint >= 1 THEN {'w': 3, 'c': 'building_density_high'} END, " + _RISKS + ", CASE WHEN slope_tier = 'penalized' THEN {'w': 2, 'c': 'elevated_slope_band'} END, " + _DRY + ", CASE WHEN cover = 'forest' THEN {'w': 1, 'c': 'forest_land'} END, CASE WHEN acreage_tier = 'small' THEN {'w': 1, 'c': 'small_candidate'} END, " + _RADAR, _OPEN)}
SELECT site_id, status, reason, round(utility, 3) AS utility, round(build, 3) AS buildability, round(infra, 3) AS infrastructure, round(risk, 3) AS risk, round(composite, 3) AS composite, (10 * (10 - len(missing)))::DOUBLE AS coverage, array_to_string(missing, ',') AS missing,
 CASE sure WHEN 2 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS confidence,
 CASE WHEN status = 'manual_review' THEN 'Manual Review' WHEN status = 'excluded' THEN 'Ignore' WHEN composite >= 90 AND acres BETWEEN 500 AND 5000 AND slope_tier <> 'penalized' AND acres < 5000 AND sure > 0 AND anchors >= 3 THEN 'Shortlist' WHEN composite >= 85 AND zone_fallback THEN 'Utility Desk Check'
  WHEN composite >= 75 THEN 'Parcel Pull' WHEN composite >= 65 THEN 'Monitor' ELSE 'Ignore' END AS action,
 CASE status WHEN 'manual_review' THEN 'internal_diligence_only' WHEN 'excluded' THEN 'do_not_pitch' ELSE 'apn_owner_pull_required' END AS actionability, codes FROM coded
""")
def full_scores(spark: SparkSession, d: str) -> DataFrame:
    """Gates, the four sub-scores, composite, coverage, confidence, action, actionability and reason codes of every candidate."""
    col = F.col
    c = _scored(anchor_summary(spark, d, candidates(spark, d)))
    # an unknown slope leaves the score, and all that needs it, unknown
    build = rules.buildability(rules.lookup(col("cover"), rules.LAND_COVER, 50), rules.acreage_score(col("acres")), rules.slope_score(col("slope_tier")), rules.constraint_score(col("flood_overlap"), col("near_floodway"), col("footprint")))
    c = c.withColumn("build", build).withColumn("composite", rules.composite(col("utility"), col("build"), col("infra"), col("risk")))
    gate = rules.gate_reasons(col("footprint"), col("slope_mean"), col("buildable_ratio"))
    status, reason = rules.hard_slope_exclusion(F.when(gate.isNull(), "pass").otherwise("manual_review"), gate, col("slope_max"))
    coverage, missing = rules.coverage(col("primary_anchor"), col("utility_status"), col("cover"), col("slope_mean"), col("pga"), col("drought_level"), [col("d500"), col("d345"), col("d230")], col("d_pipe"), col("d_rail"), col("d_water"))
    c = c.withColumn("status", status).withColumn("reason", reason).withColumn("coverage", coverage).withColumn("missing", missing)
    c = c.withColumn("confidence", rules.confidence(col("missing"), col("anchor_match"), [col("utility"), col("build"), col("infra"), col("risk")]))
    act = rules.action(col("status"), col("composite"), col("acres"), col("slope_tier") == "penalized", rules.oversized(col("acres")), col("anchors"), col("confidence"), col("zone_fallback"), F.lit(None))
    return c.select("site_id", "status", "reason", *[F.round(a, 3).alias(b) for a, b in (("utility", "utility"), ("build", "buildability"), ("infra", "infrastructure"), ("risk", "risk"), ("composite", "composite"))], "coverage", F.array_join("missing", ",").alias("missing"), "confidence", act.alias("action"), rules.actionability(col("status")).alias("actionability"), F.array_join(rules.reason_codes(reasons.greenfield()), ",").alias("codes"))


#: Of each reuse node, besides what a candidate has.
NODE = [
    ("source", "CASE k % 4 WHEN 0 THEN 'EIA-860' WHEN 1 THEN 'EIA-860-nuclear' WHEN 2 THEN 'EPA-RE-Powering' ELSE 'OpenStreetMap' END"),
    ("asset", "CASE k % 9 WHEN 0 THEN 'landfill' WHEN 1 THEN 'quarry_mine' WHEN 2 THEN 'abandoned_mine' WHEN 3 THEN 'contaminated_land' WHEN 4 THEN 'coal_plant' WHEN 5 THEN 'gas_plant' WHEN 6 THEN 'nuclear' ELSE 'industrial_land' END"),
    ("reuse_status", "CASE k % 3 WHEN 0 THEN 'retired' WHEN 1 THEN 'retiring' ELSE 'active_industrial' END"), ("program", "CASE k % 5 WHEN 0 THEN 'Superfund (NPL)' WHEN 1 THEN 'State voluntary' WHEN 2 THEN 'rcra corrective_action' END"),
    ("retirement_year", "CASE WHEN k % 7 > 2 THEN 2000 + k % 30 END"), ("own_polygon", "k % 5 = 4"), ("container_acres", "CASE WHEN k % 6 = 1 THEN 100 + k * 83 % 8000 END"), ("known_acres", "CASE WHEN k % 4 = 2 THEN k * 89 % 3000 END"),
    ("mw", "CASE WHEN k % 8 > 2 THEN k * 97 % 2600 END"), ("technology", "CASE WHEN k % 2 = 0 THEN 'Natural Gas Fired Combined Cycle' ELSE 'Gas Turbine' END"), ("alias_count", "1 + k % 7"),
]
NODES = "SELECT " + ", ".join(f"{e} AS {n}" for n, e in CANDIDATE + NODE) + " FROM (SELECT p_partkey AS k FROM part)"

#: Programs that mean known contamination: fixed values.
PROGRAMS = ("SUPERFUND", "RCRA", "BROWNFIELDS", "FEDERAL", "CERCLA", "NPL", "CORRECTIVE_ACTION")


def nodes(spark: SparkSession, d: str) -> DataFrame:
    return sites.table(spark, d, "part").select(F.col("p_partkey").alias("k")).selectExpr(*[f"{e} AS {n}" for n, e in CANDIDATE + NODE])


def risk_flags(n: DataFrame) -> DataFrame:
    """Review, legacy, known decommissioning and known contamination of reuse nodes."""
    c, plant = F.col, F.col("source").isin("EIA-860", "EIA-860-nuclear")
    n = n.withColumn("review_required", (c("source") == "EPA-RE-Powering") | c("asset").isin("contaminated_land", "abandoned_mine", "landfill", "quarry_mine"))
    n = n.withColumn("legacy", c("asset").isin("abandoned_mine", "landfill", "quarry_mine") | (plant & c("reuse_status").isin("retired", "retiring")))
    program = F.upper(F.coalesce("program", F.lit("")))
    told = (c("source") == "EPA-RE-Powering") & F.exists(F.array(*map(F.lit, PROGRAMS)), lambda p: F.contains(program, p))
    return n.withColumn("decommissioning_known", plant & c("retirement_year").isNotNull()).withColumn("contaminated", told | c("asset").isin("landfill", "quarry_mine"))


def footprints(n: DataFrame) -> DataFrame:
    """Acres, where they come from and how far to trust them: own polygon, the smallest container up to 5,000 acres, known
    acres, what a plant of this capacity takes, else 200."""
    c = F.col
    kind = F.when(c("asset") == "nuclear", "nuclear").when(c("asset") == "coal_plant", "coal").when((c("asset") == "gas_plant") & F.lower("technology").rlike("combined cycle|steam turbine"), "gas_cc").when(c("asset") == "gas_plant", "gas")
    template = F.when(kind.isNotNull(), rules.template_acres(kind, F.coalesce("mw", F.lit(0)).cast("double")))
    step = F.when(c("own_polygon"), 1).when(c("container_acres") <= 5000, 2).when(c("known_acres") > 0, 3).when(template.isNotNull(), 4).otherwise(5)
    n = n.withColumn("step", step).withColumn("template", template)
    acres = F.when(c("step") == 1, c("acres").cast("double")).when(c("step") == 2, c("container_acres").cast("double")).when(c("step") == 3, c("known_acres").cast("double")).when(c("step") == 4, c("template")).otherwise(200.0)
    of = lambda *names: F.get(F.array(*map(F.lit, names)), c("step") - 1)
    return n.withColumn("acres", acres).withColumn("geometry_source", of("OSM_POLYGON", "OSM_POLYGON_MATCH", "BUFFER_FROM_ACREAGE", "BUFFER_FROM_CAPACITY", "DEFAULT_BUFFER")).withColumn("geometry_confidence", of("HIGH", "HIGH", "MEDIUM", "MEDIUM", "LOW")).drop("template", "step")


_NODES_SQL = f"""flagged AS (SELECT *, source = 'EPA-RE-Powering' OR asset IN ('contaminated_land', 'abandoned_mine', 'landfill', 'quarry_mine') AS review_required,
  asset IN ('abandoned_mine', 'landfill', 'quarry_mine') OR (source LIKE 'EIA-860%' AND reuse_status IN ('retired', 'retiring')) AS legacy, source LIKE 'EIA-860%' AND retirement_year IS NOT NULL AS decommissioning_known,
  (source = 'EPA-RE-Powering' AND len(list_filter(['SUPERFUND', 'RCRA', 'BROWNFIELDS', 'FEDERAL', 'CERCLA', 'NPL', 'CORRECTIVE_ACTION'], lambda t: contains(upper(coalesce(program, '')), t))) > 0) OR asset IN ('landfill', 'quarry_mine') AS contaminated,
  CASE asset WHEN 'nuclear' THEN greatest(800.0::DOUBLE, least(3000.0::DOUBLE, 0.5::DOUBLE * coalesce(mw, 0) + 600)) WHEN 'coal_plant' THEN greatest(300.0::DOUBLE, least(2000.0::DOUBLE, 0.5::DOUBLE * coalesce(mw, 0) + 200))
   WHEN 'gas_plant' THEN CASE WHEN lower(technology) LIKE '%combined cycle%' OR lower(technology) LIKE '%steam turbine%' THEN greatest(40.0::DOUBLE, least(150.0::DOUBLE, 0.1::DOUBLE * coalesce(mw, 0) + 40)) ELSE greatest(10.0::DOUBLE, least(40.0::DOUBLE, 0.05::DOUBLE * coalesce(mw, 0) + 10)) END END AS template FROM n),
stepped AS (SELECT *, CASE WHEN own_polygon THEN 1 WHEN container_acres <= 5000 THEN 2 WHEN known_acres > 0 THEN 3 WHEN template IS NOT NULL THEN 4 ELSE 5 END AS step FROM flagged),
c AS (SELECT * REPLACE (CASE step WHEN 1 THEN acres WHEN 2 THEN container_acres WHEN 3 THEN known_acres WHEN 4 THEN template ELSE 200 END::DOUBLE AS acres),
  ['OSM_POLYGON', 'OSM_POLYGON_MATCH', 'BUFFER_FROM_ACREAGE', 'BUFFER_FROM_CAPACITY', 'DEFAULT_BUFFER'][step] AS geometry_source, ['HIGH', 'HIGH', 'MEDIUM', 'MEDIUM', 'LOW'][step] AS geometry_confidence FROM stepped)"""


@query(f"WITH n AS ({NODES}), {_NODES_SQL} SELECT site_id, round(acres, 3) AS acres, geometry_source, geometry_confidence, review_required, legacy, decommissioning_known, contaminated FROM c")
def reuse_nodes(spark, d):
    """Footprint ladder and risk flags of reuse nodes."""
    return risk_flags(footprints(nodes(spark, d))).select("site_id", F.round("acres", 3).alias("acres"), "geometry_source", "geometry_confidence", "review_required", "legacy", "decommissioning_known", "contaminated")


@query(f"""
WITH n AS ({NODES}), {_NODES_SQL}, {ANCHOR_STATS}, {_summary_sql("c", 30)}, {_SCORED_SQL},
built AS (SELECT *, 0.35::DOUBLE * 85 + 0.25::DOUBLE * acreage_score + 0.25::DOUBLE * CASE slope_tier WHEN 'ideal' THEN 100 WHEN 'penalized' THEN 50 ELSE 80 END + 0.15::DOUBLE * (100 - CASE WHEN flood_overlap THEN 30 WHEN near_floodway THEN 10 ELSE 0 END) AS build,
  greatest(0, least(100, 100 - CASE WHEN contaminated THEN 45 ELSE 0 END - CASE WHEN legacy THEN 20 ELSE 0 END - CASE WHEN review_required THEN 10 ELSE 0 END + CASE WHEN decommissioning_known THEN 10 ELSE 0 END)) AS environment,
  concat_ws(';', CASE WHEN buildable_ratio < 0.25 THEN 'buildable_ratio_<25pct' END, CASE WHEN geometry_confidence = 'LOW' THEN 'geometry_confidence_LOW' END) AS gate FROM scored),
gated AS (SELECT *, (0.25::DOUBLE * utility + 0.15::DOUBLE * build + 0.15::DOUBLE * infra + 0.15::DOUBLE * risk + 0.20::DOUBLE * environment) / 0.90::DOUBLE AS composite, CASE WHEN gate <> '' THEN 'manual_review' ELSE 'pass' END AS status,
  1 + (primary_anchor IS NULL)::INT + (pga IS NULL)::INT + (d500 IS NULL AND d345 IS NULL AND d230 IS NULL)::INT + (d_pipe IS NULL)::INT + (d_rail IS NULL)::INT + (d_water IS NULL)::INT AS n_missing FROM built),
sure AS (SELECT *, least(CASE n_missing WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END, CASE anchor_match WHEN 'high' THEN 2 WHEN 'medium' THEN 1 ELSE 0 END,
  CASE WHEN (utility >= 50)::INT + (build >= 50)::INT + (infra >= 50)::INT + (risk >= 50)::INT + (environment >= 50)::INT >= 4 THEN 2 WHEN (utility >= 50)::INT + (build >= 50)::INT + (infra >= 50)::INT + (risk >= 50)::INT + (environment >= 50)::INT = 3 THEN 1 ELSE 0 END) AS sure FROM gated),
{_codes_sql("sure", _PLUS + ", " + _SEISMIC + ", " + _SCALE + ", CASE WHEN geometry_source = 'OSM_POLYGON' THEN {'w': 2, 'c': 'high_confidence_real_footprint'} END, CASE WHEN decommissioning_known THEN {'w': 2, 'c': 'decommissioning_timeline_known'} END, CASE WHEN source LIKE 'EIA-860%' AND anchors >= 3 THEN {'w': 2, 'c': 'reuse_node_with_grid_anchor'} END",
  _RISKS + ", " + _DRY + ", " + _RADAR + ", CASE WHEN contaminated THEN {'w': 3, 'c': 'reuse_high_contamination_risk'} END, CASE WHEN legacy THEN {'w': 2, 'c': 'legacy_asset_decom_risk'} END, CASE WHEN review_required THEN {'w': 1, 'c': 'environmental_review_required'} END",
  _OPEN + ", CASE WHEN geometry_source LIKE 'BUFFER%' THEN {'w': 1, 'c': 'estimated_footprint_buffered'} END, CASE WHEN alias_count >= 5 THEN {'w': 1, 'c': 'multi_parcel_aggregated'} END")}
SELECT site_id, status, CASE WHEN gate <> '' THEN gate END AS reason, round(utility, 3) AS utility, round(build, 3) AS buildability, environment::DOUBLE AS environment, round(composite, 3) AS composite, CASE sure WHEN 2 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS confidence,
 CASE WHEN status = 'manual_review' THEN 'Manual Review' WHEN (contaminated OR legacy) AND composite >= 60 THEN 'Reuse Diligence' WHEN composite >= 90 AND acres >= 500 AND acres < 5000 AND sure > 0 AND anchors >= 3 THEN 'Shortlist' WHEN composite >= 85 AND zone_fallback THEN 'Utility Desk Check'
  WHEN composite >= 75 THEN 'Parcel Pull' WHEN composite >= 65 THEN 'Monitor' ELSE 'Ignore' END AS action, codes FROM coded
""")
def reuse_scores(spark: SparkSession, d: str) -> DataFrame:
    """Gates, sub-scores, composite, confidence, action and reason codes of every reuse node."""
    col = F.col
    c = _scored(anchor_summary(spark, d, risk_flags(footprints(nodes(spark, d))), cap=30))
    c = c.withColumn("build", rules.reuse_buildability(rules.acreage_score(col("acres")), rules.slope_score(col("slope_tier")), col("flood_overlap"), col("near_floodway")))
    c = c.withColumn("environment", rules.reuse_environmental(col("contaminated"), col("legacy"), col("review_required"), col("decommissioning_known")))
    c = c.withColumn("composite", rules.reuse_composite(col("utility"), col("build"), col("infra"), col("risk"), col("environment")))
    gate = rules.reuse_gate_reasons(col("buildable_ratio"), col("geometry_confidence"))
    c = c.withColumn("reason", gate).withColumn("status", F.when(gate.isNull(), "pass").otherwise("manual_review"))
    _, missing = rules.coverage(col("primary_anchor"), col("utility_status"), F.lit("built"), F.lit("deferred"), col("pga"), col("drought"), [col("d500"), col("d345"), col("d230")], col("d_pipe"), col("d_rail"), col("d_water"))
    c = c.withColumn("missing", missing)
    c = c.withColumn("confidence", rules.confidence(col("missing"), col("anchor_match"), [col(x) for x in ("utility", "build", "infra", "risk", "environment")], 4, 3))
    act = rules.reuse_action(col("status"), col("composite"), col("acres"), rules.oversized(col("acres")), col("anchors"), col("confidence"), col("zone_fallback"), col("contaminated"), col("legacy"))
    return c.select("site_id", "status", "reason", *[F.round(a, 3).alias(b) for a, b in (("utility", "utility"), ("build", "buildability"))], col("environment").cast("double").alias("environment"), F.round("composite", 3).alias("composite"), "confidence", act.alias("action"), F.array_join(rules.reason_codes(reasons.reuse()), ",").alias("codes"))


@query(f"""
WITH {ANCHOR_STATS}, q AS (SELECT l_orderkey AS project, l_suppkey % 40 AS zone, l_quantity::BIGINT AS mw, l_linestatus = 'O' AS open, n_name AS region, l_shipdate AS due FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey WHERE l_returnflag = 'N')
SELECT zone, string_agg(DISTINCT region, ',' ORDER BY region) AS regions, sum(mw)::BIGINT AS unmatched_mw, count(*) AS projects, min(due) FILTER (due >= TIMESTAMP '1996-01-01') AS earliest, 0.5::DOUBLE AS score_weight,
 round_even(date_diff('day', TIMESTAMP '1996-01-01', min(due) FILTER (due >= TIMESTAMP '1996-01-01')) / 30.44::DOUBLE, 0)::INT AS months FROM q WHERE open GROUP BY 1
""")
def zone_fallback_stats(spark, d):
    """Projects that no anchor was found for, summed by load zone at half weight; the day is fixed."""
    line, today = sites.table(spark, d, "lineitem").filter("l_returnflag = 'N' AND l_linestatus = 'O'"), F.lit("1996-01-01").cast("timestamp_ntz")
    s = sites.table(spark, d, "supplier").join(sites.table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    q = line.join(s, F.col("l_suppkey") == F.col("s_suppkey")).withColumn("zone", F.col("l_suppkey") % 40)
    g = q.groupBy("zone").agg(F.array_join(F.array_sort(F.collect_set("n_name")), ",").alias("regions"), F.sum("l_quantity").cast("long").alias("unmatched_mw"), F.count(F.lit(1)).alias("projects"), F.min(F.when(F.col("l_shipdate") >= today, F.col("l_shipdate"))).alias("earliest"))
    return g.withColumn("score_weight", F.lit(0.5)).withColumn("months", rules.months_until(today, F.col("earliest")))
