"""Classifications of parcels, assets, operators and names as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .rules import true

# Flood, wetland, soil, seismic and slope bands -------------------------------------------------------------------------

#: Flood zones that disqualify a parcel: fixed values.
FLOOD_ZONES = ("A", "AE", "AO", "AH", "V", "VE")
#: Prefixes of wetland codes, and the coverage in percent that needs a permit: fixed values.
FORESTED, JURISDICTIONAL, COVERAGE_LIMIT = ("PFO",), ("PFO", "PEM", "PSS", "PAB", "E"), 10.0
#: Soil thresholds (linear extensibility, organic matter) and drainage classes: fixed values.
LEP_LOW, LEP_EXPANSIVE, PEAT_PERCENT = 3.0, 6.0, 20.0
POOR_DRAINAGE = ("Poorly drained", "Very poorly drained")
GOOD_DRAINAGE = ("Well drained", "Excessively drained", "Somewhat excessively drained")


def flood_source(zones: Column, disqualifying: tuple[str, ...] = FLOOD_ZONES) -> tuple[Column, Column]:
    """Whether a parcel is disqualified, and how sure that is: its zones may be others, or none may have been returned."""
    known = F.array_compact(zones)
    bad = F.exists(known, lambda z: z.isin(*disqualifying))
    return bad, F.when(bad, "sfha_confirmed").when(F.size(known) > 0, "zone_x_confirmed").otherwise("no_data_returned")


def wetland_band(codes: Column, percent: Column) -> Column:
    def any_of(prefixes):
        return F.exists(codes, lambda c: _starts(c, prefixes))

    forested, regulated = any_of(FORESTED), any_of(JURISDICTIONAL)
    return F.when(F.size(codes) == 0, "none").when(forested | (regulated & (percent > COVERAGE_LIMIT)), "jurisdictional_permit_required").when(regulated, "non_jurisdictional").otherwise("hydric_only")


def _starts(c: Column, prefixes: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for p in prefixes:
        out = out | F.startswith(c, F.lit(p))
    return out


def soil_flags(lep: Column, organic: Column, drainage: Column) -> tuple[Column, Column, Column]:
    """Of a soil component: poor, good, and expansive or peat."""
    bad = true(lep >= LEP_EXPANSIVE) | true(organic >= PEAT_PERCENT)
    good = true(drainage.isin(*GOOD_DRAINAGE)) & ~true(lep >= LEP_LOW) & ~true(organic >= PEAT_PERCENT)
    return bad | true(drainage.isin(*POOR_DRAINAGE)), good, bad


def bearing_band(total: Column, poor: Column, good: Column) -> Column:
    """Of a parcel, by the shares its components cover; unknown soil counts as good."""
    return F.when(F.coalesce(total, F.lit(0.0)) == 0, "Good").when(poor >= 0.5 * total, "Poor").when(good >= 0.7 * total, "Good").otherwise("Moderate")


def shrink_swell(lep: Column) -> Column:
    return F.when(lep < LEP_LOW, "Low").when(lep < LEP_EXPANSIVE, "Moderate").when(lep < 9, "High").when(lep.isNotNull(), "Very High")


def seismic_band(pga: Column) -> Column:
    return F.when(pga.isNull() | (pga < 0.10), "Low").when(pga < 0.25, "Moderate").when(pga < 0.50, "High").otherwise("Very_High")


def slope_band(percent: Column) -> Column:
    return F.when(percent.isNull() | (percent < 2), "Flat").when(percent < 5, "Gentle").when(percent < 8, "Hilly").otherwise("Very_Hilly")


def hazard_value(curve: Column, probability: float = 0.000404) -> Column:
    """Acceleration at an annual probability, interpolated between the logarithms of a hazard curve, an array of structs
    (x, y) with falling y; ends are kept beyond the curve, points with y <= 0 left out; null with fewer than two."""
    points = F.transform(F.filter(curve, lambda p: p["y"] > 0), lambda p: F.struct(F.ln(p["y"]).alias("y"), F.ln(p["x"]).alias("x")))
    up = F.array_sort(points)
    target = F.ln(F.lit(probability))
    below, above = F.filter(up, lambda p: p["y"] <= target), F.filter(up, lambda p: p["y"] > target)
    a, b = F.element_at(below, -1), F.element_at(above, 1)
    between = a["x"] + (target - a["y"]) / (b["y"] - a["y"]) * (b["x"] - a["x"])
    out = F.when(F.size(below) == 0, F.get(up, 0)["x"]).when(F.size(above) == 0, F.element_at(up, -1)["x"]).otherwise(between)
    return F.when(F.size(up) >= 2, F.exp(out))


# Places, roads, assets --------------------------------------------------------------------------------------------------


def incorporated(lsad: Column, function_status: Column) -> Column:
    """Cities, towns and villages by their legal description, or places with an active government: fixed values."""
    return true(lsad.isin("25", "43", "47")) | true(function_status.isin("A", "B", "C"))


def osm_asset(power: Column, landuse: Column, man_made: Column) -> Column:
    """First match wins."""
    out = F.when(power == "plant", "power_plant").when(landuse == "quarry", "quarry_mine").when(landuse == "landfill", "landfill").when(landuse == "brownfield", "brownfield_land")
    return out.when(man_made == "works", "industrial_works").otherwise("industrial_land")


#: Patterns of names: fixed values.
RENEWABLE = r"(?i)solar farm|solar facility|solar plant|solar project|solar generating|wind farm|wind energy|wind project|photovoltaic"
ACTIVE = (
    r"(?i)\bproving ground|\btest track\b|aircraft boneyard|\bammunition plant\b|\barsenal\b|\bprison\b|correctional (complex|facility|institution)"
    r"|\bnaval (base|station|shipyard)\b|\bair force base\b|\bafb\b"
)
DECOMMISSIONED = r"(?i)\b(old|former|closed|decommission(ed)?|abandoned|disused|disposal)\b"


def still_active(name: Column) -> Column:
    """Names of active sites, unless they say that the site has closed; no name is not active."""
    return true(name.rlike(ACTIVE)) & ~true(name.rlike(DECOMMISSIONED))


def renewable(name: Column) -> Column:
    return true(name.rlike(RENEWABLE))


# Pipelines --------------------------------------------------------------------------------------------------------------

#: Operators of the first tier by words of their names: fixed values.
TIER_1_WORDS = (
    "ENTERPRISE", "WILLIAMS", "KINDER MORGAN", "EL PASO", "ENBRIDGE", "ENERGY TRANSFER", "TARGA", "BOARDWALK", "SOUTHERN NATURAL", "TRANSCONTINENTAL", "TRANSWESTERN",
    "TENNESSEE GAS", "COLUMBIA GAS", "COLUMBIA GULF", "TEXAS EASTERN", "PANHANDLE EASTERN", "NORTHWEST PIPELINE", "QUESTAR", "ANR", "TRUNKLINE", "ALGONQUIN",
    "NORTHERN NATURAL", "FLORIDA GAS", "ROCKIES EXPRESS", "KERN RIVER", "RUBY PIPELINE", "MIDCONTINENT EXPRESS", "COMANCHE TRAIL", "TRANS PECOS", "SIERRITA", "FLORIDA SOUTHEAST",
)


def operator_tier(name: Column) -> Column:
    return F.when(F.exists(F.array(*map(F.lit, TIER_1_WORDS)), lambda w: F.contains(F.upper(name), w)), "tier_1").otherwise("other")


#: Operators of trunk lines of 30 inches and more, and of middling interstate lines: fixed values.
TRUNK_OPERATORS = (
    "Transcontinental Gas PL", "Tennessee Gas Pipeline", "Columbia Gas Trans Co", "Texas Eastern Trans Co", "Algonquin Gas Trans Co", "Rockies Express Pipeline", "Northern Natural Gas Co",
    "El Paso Natural Gas Co", "El Paso Texas Pipeline Co", "Southern Natural Gas Co", "ANR Pipeline Co", "Panhandle Eastern PL Co", "Trunkline Gas Co", "Northwest Pipeline",
    "Kern River Gas Trans Co", "Ruby Pipeline LLC", "Midcontinent Express Pipeline", "Kinder Morgan Texas Pipeline Co", "Columbia Gulf Pipeline", "Permian Highway Pipeline",
    "Whistler Pipeline", "Gulf Coast Express", "Trans Pecos Pipeline", "Comanche Trail Pipeline", "Sierrita Gas Pipeline", "Florida Gas Trans Co", "Florida Southeast Connection",
)
MIDDLING_OPERATORS = (
    "Equitrans Inc", "Dominion Transmission Co", "Southern Star Central Gas PL Co", "Questar Pipeline Co", "Wyoming Interstate PL Co", "Great Lakes Gas Trans Co", "Iroquois Gas Trans Co", "Empire Pipeline",
)


def estimated_inches(name: Column, kind: Column, tier: Column, thirty: tuple[str, ...] = TRUNK_OPERATORS, twenty: tuple[str, ...] = MIDDLING_OPERATORS) -> Column:
    """Inches by lists of operators (either name may contain the other), else by kind and tier."""
    upper = F.upper(name)

    def listed(names):
        return true(F.exists(F.array(*[F.lit(n.upper()) for n in names]), lambda n: F.contains(upper, n) | F.contains(n, upper))) & (name != "")

    out = F.when(listed(thirty), 30).when(listed(twenty), 20).when((kind == "Interstate") & (tier == "tier_1"), 24)
    return out.when(kind == "Interstate", 14).when(tier == "tier_1", 12).otherwise(8)


# Capacity ---------------------------------------------------------------------------------------------------------------


def headroom_band(ratio: Column) -> Column:
    return F.when(ratio > 1.2, "abundant").when(ratio >= 0.9, "moderate").when(ratio.isNotNull(), "constrained")


#: Control areas and their short codes: fixed values. The long name of one is cut in its source.
CONTROL_AREAS = {
    "ARIZONA PUBLIC SERVICE COMPANY": "AZPS", "BALANCING AUTHORITY OF NORTHERN CALIFORNIA": "BANC", "CALIFORNIA INDEPENDENT SYSTEM OPERATOR": "CISO", "EL PASO ELECTRIC COMPANY": "EPE",
    "ELECTRIC RELIABILITY COUNCIL OF TEXAS, INC.": "ERCO", "IMPERIAL IRRIGATION DISTRICT": "IID", "LOS ANGELES DEPARTMENT OF WATER AND POWER": "LDWP",
    "MIDCONTINENT INDEPENDENT TRANSMISSION SYSTEM OPERATOR, ...": "MISO", "NEVADA POWER COMPANY": "NEVP", "PACIFICORP - EAST": "PACE", "PACIFICORP - WEST": "PACW", "PJM INTERCONNECTION, LLC": "PJM",
    "PUBLIC SERVICE COMPANY OF NEW MEXICO": "PNM", "SALT RIVER PROJECT": "SRTP", "SOUTHWEST POWER POOL": "SWPP", "TENNESSEE VALLEY AUTHORITY": "TVA", "TUCSON ELECTRIC POWER COMPANY": "AZPS",
    "TURLOCK IRRIGATION DISTRICT": "TIDC", "WESTERN AREA POWER ADMIN - DESERT SOUTHWEST REGION": "WALC",
}
