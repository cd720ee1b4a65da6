"""Tiers, scores, gates, actions and reason codes as Column expressions. Nulls behave as each rule says."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .geometry import METRES_PER_MILE


def bands(v: Column, upper: list[tuple[float, object]], last: object, null: object = None, closed: bool = True) -> Column:
    """The value of the first band whose upper bound holds v (closed: <=, else <); `last` beyond; `null` for null."""
    out = F.when(v.isNull(), F.lit(null))
    for bound, value in upper:
        out = out.when(v <= bound if closed else v < bound, F.lit(value))
    return out.otherwise(F.lit(last))


def lookup(v: Column, table: dict, default: object) -> Column:
    """Value of a code; unknown and null codes get the default."""
    out = F.lit(default)
    for key, value in reversed(table.items()):
        out = F.when(v == key, F.lit(value)).otherwise(out)
    return out


def true(cond: Column) -> Column:
    """A condition on null is false."""
    return F.coalesce(cond, F.lit(False))


def first_present(columns: list[Column], table: dict) -> Column:
    """Map the first of several codes that the table knows; null if none is known."""
    return F.coalesce(*[lookup(c, table, None) for c in columns])


# Tiers ---------------------------------------------------------------------------------------------------------------


def slope_tier(mean: Column, most: Column) -> Column:
    return F.when(mean.isNull() | most.isNull(), "unknown").when((mean <= 5) & (most <= 5), "ideal").when((mean <= 8) & (most <= 8), "acceptable").otherwise("penalized")


def slope_score(tier: Column) -> Column:
    return lookup(tier, {"ideal": 100, "acceptable": 80, "penalized": 50}, None)


def acreage_tier(acres: Column) -> Column:
    return bands(acres, [(100, "small"), (250, "moderate"), (500, "large"), (1000, "very_large")], "strategic_scale", closed=False)


def acreage_score(acres: Column) -> Column:
    return bands(acres, [(100, 50), (250, 70), (500, 85), (1000, 95)], 100, closed=False)


def size_class(acres: Column) -> Column:
    return bands(acres, [(500, "site"), (5000, "campus")], "region", closed=False)


def oversized(acres: Column) -> Column:
    return true(acres >= 5000)


def seismic_tier(pga: Column) -> Column:
    return bands(pga, [(0.10, "very_low"), (0.25, "low"), (0.50, "moderate"), (1.0, "high")], "very_high", closed=False)


def near(metres: Column, limit: float = 500.0) -> Column:
    """Closer than the limit; unknown distances are far."""
    return F.coalesce(metres, F.lit(1e9)) < limit


def touches(metres: Column) -> Column:
    return F.coalesce(metres, F.lit(1e9)) <= 0


# Anchors -------------------------------------------------------------------------------------------------------------


def mw_tier(mw: Column) -> Column:
    return bands(mw, [(25, "negligible"), (50, "weak"), (100, "moderate"), (200, "strong")], "very_strong", "negligible", closed=False)


def mw_score(tier: Column) -> Column:
    return lookup(tier, {"negligible": 0, "weak": 25, "moderate": 50, "strong": 75, "very_strong": 100}, 0)


def queue_status_best(agreement: Column, active: Column, suspended: Column) -> Column:
    """Best status of an anchor's projects: a signed agreement, else any under study, else any suspended."""
    return F.when(true(agreement), "executed_ia").when(true(active > 0), "in_study").when(true(suspended > 0), "suspended").otherwise("no_active")


def status_score(status: Column) -> Column:
    return lookup(status, {"executed_ia": 100, "in_study": 67, "suspended": 37}, 0)


def match_confidence(method: Column) -> Column:
    return lookup(method, {"exact": "high", "fuzzy_high": "high", "fuzzy_high_endpoint": "medium", "fuzzy_medium": "medium", "fuzzy_low": "low"}, None)


def method_rank(method: Column) -> Column:
    return lookup(method, {"exact": 4, "fuzzy_high": 3, "fuzzy_high_endpoint": 2, "fuzzy_medium": 1}, 0)


def distance_band(metres: Column) -> Column:
    return bands(metres, [(5_000, "strong"), (10_000, "moderate"), (25_000, "weak"), (50_000, "regional")], "out_of_range", "out_of_range")


def voltage_percent(kv: Column) -> Column:
    """Multiplier times 100."""
    return F.when(kv >= 500, 120).when(kv >= 345, 110).when(kv >= 230, 105).otherwise(100)


def decay_percent(metres: Column) -> Column:
    return bands(metres, [(5_000, 100), (10_000, 67), (25_000, 33), (50_000, 10)], 0, 0)


def confidence_percent(level: Column, line_fraction: Column | None = None) -> Column:
    """Weight of a match times 100; four fifths of it where most of the names behind it are lines."""
    base = lookup(level, {"high": 100, "medium": 70, "low": 50}, 50)
    return base if line_fraction is None else F.when(true(line_fraction > 0.5), (base * 4 / 5).cast("int")).otherwise(base)


def months_until(start: Column, end: Column) -> Column:
    return F.bround(F.datediff(end, start) / 30.44, 0).cast("int")


def activation_band(months: Column) -> Column:
    return bands(months, [(18, "le_18"), (36, "18_36"), (60, "36_60")], "gt_60")


# Gates and sub-scores ------------------------------------------------------------------------------------------------


def gate_reasons(footprint: Column, slope_mean: Column, buildable_ratio: Column) -> Column:
    """Reasons for a manual review, joined by ';', or null. Unknown values pass."""
    reasons = F.concat_ws(";", F.when(footprint > 5, "building_footprint_>5pct"), F.when(slope_mean > 15, "slope_>15pct"), F.when(buildable_ratio < 0.25, "buildable_ratio_<25pct"))
    return F.when(reasons != "", reasons)


def reuse_gate_reasons(buildable_ratio: Column, geometry_confidence: Column) -> Column:
    reasons = F.concat_ws(";", F.when(buildable_ratio < 0.25, "buildable_ratio_<25pct"), F.when(geometry_confidence == "LOW", "geometry_confidence_LOW"))
    return F.when(reasons != "", reasons)


def hard_slope_exclusion(status: Column, reason: Column, slope_max: Column) -> tuple[Column, Column]:
    """Status and reason after the rule that excludes all whose steepest slope is over 15 percent; a prior reason is kept."""
    steep = true(slope_max > 15) & (status != "excluded")
    prior = F.coalesce(reason, F.lit(""))
    said = F.concat(F.lit("slope_max_gt_15_pct_pdf_rule_13"), F.when(prior != "", F.concat(F.lit(" (prior_reason: "), prior, F.lit(")"))).otherwise(""))
    return F.when(steep, "excluded").otherwise(status), F.when(steep, said).otherwise(reason)


LAND_COVER = {"grassland": 90, "shrub_barren": 80, "cropland": 65, "forest": 45}


def constraint_score(floodway: Column, flood_edge: Column, footprint: Column) -> Column:
    """100 less penalties, not below 0. An unknown footprint takes the worst penalty, as the rule's comparison does."""
    cost = F.when(F.isnull(footprint), 120).when(footprint < 0.25, 0).when(footprint < 1, 10).when(footprint < 5, 40).when(footprint < 15, 90).otherwise(120)
    return F.greatest(F.lit(0), 100 - flood_cost(floodway, flood_edge) - cost)


def flood_cost(overlap: Column, adjacent: Column) -> Column:
    """An overlap is always adjacent too, and costs only once."""
    return F.when(true(overlap), 30).when(true(adjacent), 10).otherwise(0)


def reuse_buildability(acreage: Column, slope: Column, overlap: Column, adjacent: Column) -> Column:
    """Built land counts 85, an unknown slope 80, and footprints cost nothing."""
    return buildability(F.lit(85), acreage, F.coalesce(slope, F.lit(80)), F.greatest(F.lit(0), 100 - flood_cost(overlap, adjacent)))


def buildability(land: Column, acreage: Column, slope: Column, constraint: Column) -> Column:
    return 0.35 * land + 0.25 * acreage + 0.25 * slope + 0.15 * constraint


def _miles(d: Column, table: list[tuple[float, int]], last: int, null: int) -> Column:
    return bands(d, [(m * METRES_PER_MILE, s) for m, s in table], last, null)


def transmission_score(d500: Column, d345: Column, d230: Column) -> Column:
    s500 = _miles(d500, [(0, 100), (1, 90), (3, 75), (5, 55), (10, 35), (25, 15)], 0, 0)
    lower = [(0, 90), (1, 80), (3, 65), (5, 45), (10, 25), (25, 10)]
    return F.greatest(s500.cast("double"), _miles(d345, lower, 0, 0).cast("double"), 0.5 * _miles(d230, lower, 0, 0))


def pipeline_tier(operator_tier: Column, inches: Column) -> Column:
    return F.when(operator_tier == "tier_1", "tier_1").when(inches.isNull(), "other").when(inches >= 20, "tier_1_by_diameter").when(inches >= 14, "tier_2").otherwise("other")


def pipeline_score(tier: Column, d: Column) -> Column:
    first = _miles(d, [(5, 100), (10, 70), (25, 40), (50, 15)], 0, 0)
    second = _miles(d, [(5, 75), (10, 50), (25, 25), (50, 10)], 0, 0)
    return F.when(tier.startswith("tier_1"), first).when(tier == "tier_2", second).otherwise(_miles(d, [(5, 50), (10, 30), (25, 15), (50, 5)], 0, 0))


def rail_score(d: Column, strategic: Column, tracks: Column) -> Column:
    base = _miles(d, [(1, 100), (3, 80), (5, 60), (10, 40), (25, 20)], 5, 5)
    extra = F.when(true(strategic), 10).otherwise(0) + F.when(true(tracks >= 2), 5).otherwise(0)
    return F.when(d.isNull(), 5).otherwise(F.least(F.lit(100), base + extra))


def water_score(inside: Column, d: Column, people: Column) -> Column:
    extra = F.when(people > 50_000, 10).when(people > 10_000, 5).otherwise(0)
    near_score = F.when(d.isNull(), 5).otherwise(_miles(d, [(1, 75), (5, 50), (15, 25)], 5, 5))
    return F.least(F.lit(100), F.when(true(inside), 100).otherwise(near_score) + extra)


def infrastructure(transmission: Column, pipeline: Column, rail: Column, water: Column) -> Column:
    return 0.35 * transmission + 0.25 * pipeline + 0.20 * rail + 0.20 * water


def distance_score(d: Column, far: float, scores: tuple[int, int, int]) -> Column:
    """100 beyond `far` or unknown; else by the 500 m and 100 m bands."""
    return F.when(d.isNull() | (d > far), 100).when(d >= 500, scores[0]).when(d >= 100, scores[1]).otherwise(scores[2])


#: Drought labels by level, and their scores: fixed values.
DROUGHT_LABELS = ("abnormally_dry", "moderate_drought", "severe_drought", "extreme_drought", "exceptional_drought")
DROUGHT_SCORE = {"no_drought": 100, "abnormally_dry": 85, "moderate_drought": 70, "severe_drought": 50, "extreme_drought": 30, "exceptional_drought": 10}


def drought_label(level: Column) -> Column:
    return F.when(level.isNull(), "no_drought").otherwise(F.get(F.array(*map(F.lit, DROUGHT_LABELS)), level.cast("int")))


def dev_risk(seismic: Column, drought: Column, radar: Column, protected: Column, wetland: Column, floodway: Column) -> Column:
    s = lookup(seismic, {"very_low": 100, "low": 80, "moderate": 55, "high": 30, "very_high": 10}, 80)
    d = lookup(drought, DROUGHT_SCORE, 100)
    r = F.when(radar.isNull() | (radar > 10), 100).when(radar > 5, 85).when(radar > 3, 60).otherwise(30)
    return 0.25 * s + 0.20 * d + 0.15 * r + 0.15 * distance_score(protected, 8047, (85, 60, 30)) + 0.15 * distance_score(wetland, 8047, (85, 60, 35)) + 0.10 * distance_score(floodway, METRES_PER_MILE, (80, 50, 25))


def composite(utility: Column, build: Column, infra: Column, risk: Column) -> Column:
    """Weights of the modules that exist, made to sum to 1."""
    return (0.40 * utility + 0.20 * build + 0.15 * infra + 0.15 * risk) / 0.90


def reuse_composite(utility: Column, build: Column, infra: Column, risk: Column, environmental: Column) -> Column:
    return (0.25 * utility + 0.15 * build + 0.15 * infra + 0.15 * risk + 0.20 * environmental) / 0.90


def reuse_environmental(contaminated: Column, legacy: Column, review: Column, known: Column) -> Column:
    cost = sum((F.when(true(c), w).otherwise(0) for c, w in ((contaminated, 45), (legacy, 20), (review, 10), (known, -10))), F.lit(0))
    return F.greatest(F.lit(0), F.least(F.lit(100), 100 - cost))


LEVELS = {"low": 1, "medium": 2, "high": 3}


def worst(*levels: Column) -> Column:
    """Least of several levels; unknown ones count as low."""
    least = F.least(*[lookup(c, LEVELS, 1) for c in levels])
    return F.when(least == 3, "high").when(least == 2, "medium").otherwise("low")


def coverage(utility_named: Column, utility_status: Column, cover: Column, slope: Column, pga: Column, drought: Column, lines: list[Column], pipeline: Column, rail: Column, water: Column) -> tuple[Column, Column]:
    """Ten points for each of nine modules that have data, and the names of those that have none, after site_control,
    which never has."""
    present = [
        ("utility", utility_named.isNotNull() & (utility_status != "failed")), ("land_cover", cover.isNotNull()), ("slope", slope.isNotNull()), ("seismic", pga.isNotNull()),
        ("drought", drought.isNotNull()), ("transmission", F.coalesce(*lines).isNotNull()), ("pipeline", pipeline.isNotNull()), ("rail", rail.isNotNull()), ("water", water.isNotNull()),
    ]
    missing = F.filter(F.array(F.lit("site_control"), *[F.when(~c, name) for name, c in present]), lambda x: x.isNotNull())
    return (10 * (10 - F.size(missing))).cast("double"), missing


def confidence(missing: Column, anchor: Column, scores: list[Column], high: int = 3, medium: int = 2) -> Column:
    """The worst of three: missing modules (none, one, more), the primary anchor's match, and how many scores reach 50."""
    above = sum((F.when(true(c >= 50), 1).otherwise(0) for c in scores), F.lit(0))
    covered = F.when(F.size(missing) == 0, "high").when(F.size(missing) == 1, "medium").otherwise("low")
    agreed = F.when(above >= high, "high").when(above >= medium, "medium").otherwise("low")
    return worst(covered, anchor, agreed)


def shortlisted(score: Column, acres: Column, oversize: Column, confident: Column, anchors: Column) -> Column:
    return (score >= 90) & true(acres.between(500, 5000)) & ~true(oversize) & true(confident.isin("medium", "high")) & true(anchors >= 3)


def action(status: Column, score: Column, acres: Column, slope_review: Column, oversize: Column, anchors: Column, confident: Column, fallback: Column, parcels: Column) -> Column:
    shortlist = shortlisted(score, acres, oversize, confident, anchors) & ~true(slope_review)
    out = F.when(status == "manual_review", "Manual Review").when(status == "excluded", "Ignore").when(shortlist, "Shortlist")
    return out.when((score >= 85) & true(fallback), "Utility Desk Check").when((score >= 75) & parcels.isNull(), "Parcel Pull").when(score >= 65, "Monitor").otherwise("Ignore")


def reuse_action(status: Column, score: Column, acres: Column, oversize: Column, anchors: Column, confident: Column, fallback: Column, contaminated: Column, legacy: Column) -> Column:
    """As for new sites, but known contamination or a legacy asset asks for diligence first, and parcels are always pulled."""
    diligence = (true(contaminated) | true(legacy)) & (score >= 60)
    out = F.when(status == "manual_review", "Manual Review").when(status == "excluded", "Ignore").when(diligence, "Reuse Diligence").when(shortlisted(score, acres, oversize, confident, anchors), "Shortlist")
    return out.when((score >= 85) & true(fallback), "Utility Desk Check").when(score >= 75, "Parcel Pull").when(score >= 65, "Monitor").otherwise("Ignore")


def actionability(status: Column) -> Column:
    return F.when(status == "manual_review", "internal_diligence_only").when(status == "excluded", "do_not_pitch").otherwise("apn_owner_pull_required")


def reason_codes(rules: list[tuple[str, str, Column, int]]) -> Column:
    """Up to five codes out of (code, sign, condition, weight): the three heaviest '+', the two heaviest '-', ties in the
    order of the rules; then one '?', in place of the fifth if there are five; fewer than three are filled up from the
    rest."""
    by = {}
    for sign in "+-?":
        held = F.array(*[F.when(true(c), F.struct(F.lit(-w).alias("w"), F.lit(i).alias("i"), F.lit(code).alias("code"))) for i, (code, s, c, w) in enumerate(rules) if s == sign])
        by[sign] = F.transform(F.array_sort(F.filter(held, lambda x: x.isNotNull())), lambda x: x["code"])
    plus, minus, query = by["+"], by["-"], by["?"]
    codes = F.concat(F.slice(plus, 1, 3), F.slice(minus, 1, 2))
    codes = F.when(F.size(query) == 0, codes).otherwise(F.concat(F.slice(codes, 1, 4), F.slice(query, 1, 1)))
    rest = F.concat(F.slice(plus, 4, len(rules)), F.slice(minus, 3, len(rules)), F.slice(query, 2, len(rules)))
    return F.when(F.size(codes) >= 3, codes).otherwise(F.slice(F.concat(codes, rest), 1, 3))


# Normalisers ---------------------------------------------------------------------------------------------------------

#: Prefixes of a queue status, in order: fixed values.
STATUS_PREFIXES = (
    ("active", "active"), ("pending", "active"), ("in process", "active"), ("executed", "active"), ("on hold", "active"),
    ("energized", "energized"), ("in service", "energized"), ("operational", "energized"), ("complete", "energized"),
    ("withdrawn", "withdrawn"), ("cancelled", "withdrawn"), ("suspended", "suspended"),
)


def queue_status(text: Column) -> Column:
    low = F.lower(F.trim(text))
    out = F.when(F.lit(False), F.lit(""))
    for prefix, status in STATUS_PREFIXES:
        out = out.when(low.startswith(prefix), status)
    return out.otherwise("unknown")


def voltage_kv(text: Column) -> Column:
    """Greatest of ';'-separated voltages in kV; values of 1,000 and more are volts. Null if none is a number."""
    values = F.transform(F.split(text, ";"), lambda v: F.try_to_number(F.regexp_replace(F.lower(v), "[kv ]", ""), F.lit("999999999.999")).cast("double"))
    return F.array_max(F.transform(values, lambda v: F.when(v >= 1000, v / 1000).otherwise(v)))


def station_class(kv: Column) -> Column:
    return F.when(kv >= 345, "class_1").when(kv >= 230, "class_2").when(kv >= 69, "class_3").when(kv.isNotNull(), "sub_class")


#: Classes of line voltages, their ratings and least voltages: fixed values. They differ from those of stations.
LINE_RATING = {"100-161": "sub_class", "220-287": "class_3", "345": "class_2", "500": "class_1", "735 AND ABOVE": "class_1", "DC": "class_1"}
LINE_LEAST_KV = {"100-161": 100, "220-287": 220, "345": 345, "500": 500, "DC": 500, "735 AND ABOVE": 735}


def line_rating(volt_class: Column) -> Column:
    return lookup(volt_class, LINE_RATING, None)


def line_kv(kv: Column, volt_class: Column) -> Column:
    """A line's voltage; the least of its class where it is unknown (null, or not above 0)."""
    return F.when(kv > 0, kv).otherwise(lookup(volt_class, LINE_LEAST_KV, None))


def sentinel_null(v: Column, *sentinels: object) -> Column:
    return F.when(~v.isin(*sentinels), v)


def excel_date(serial: Column) -> Column:
    return F.date_add(F.lit("1899-12-30").cast("date"), serial.cast("int"))


def clamp(v: Column, low: float, high: float) -> Column:
    return F.least(F.lit(high), F.greatest(F.lit(low), v))


def template_acres(kind: Column, mw: Column) -> Column:
    """Acres of a plant by its kind and capacity."""
    return F.when(kind == "nuclear", clamp(0.5 * mw + 600, 800, 3000)).when(kind == "coal", clamp(0.5 * mw + 200, 300, 2000)).when(kind == "gas_cc", clamp(0.1 * mw + 40, 40, 150)).when(kind == "gas", clamp(0.05 * mw + 10, 10, 40)).otherwise(200.0)
