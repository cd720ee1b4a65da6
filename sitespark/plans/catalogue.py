"""Queries for the rows of the survey that need no geometry, each with equivalent DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry, parcels, rules
from ..operators import covers, nodes, raster, relational, spatial
from . import sites
from .scoring import ANCHOR_STATS, anchor_stats
from .sites import ANCHORS, SITES, query, table


def _pick(key: str, *names: str | None) -> str:
    """An expression of both engines: one of several strings by a number."""
    return f"CASE {key} % {len(names)} " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(names) if n is not None) + " END"


# Filters and columns ----------------------------------------------------------------------------------------------------


@query(f"WITH {ANCHOR_STATS} SELECT a.anchor_id FROM anchored a LEFT JOIN stats s ON s.anchor_id = a.anchor_id WHERE mw >= 25 OR (nation = 5 AND coalesce(active, 0) > 0) OR (kv >= 345 AND coalesce(active, 0) > 0)")
def active_stations(spark: SparkSession, d: str) -> DataFrame:
    """Anchors by a mask of three alternatives; unknown counts as no."""
    some = rules.true(F.col("active") > 0)
    return anchor_stats(spark, d).filter((F.col("mw") >= 25) | ((F.col("nation") == 5) & some) | ((F.col("kv") >= 345) & some)).select("anchor_id")


_OSM = [("power", _pick("k", "plant", None, "line", None, None)), ("landuse", _pick("k", "quarry", "landfill", None, "brownfield", "industrial", "quarry", None)), ("man_made", _pick("k", "works", None, None))]


@query(f"""
WITH x AS (SELECT k AS site_id, {", ".join(f"{e} AS {n}" for n, e in _OSM)} FROM (SELECT p_partkey AS k FROM part))
SELECT site_id, CASE WHEN power = 'plant' THEN 'power_plant' WHEN landuse = 'quarry' THEN 'quarry_mine' WHEN landuse = 'landfill' THEN 'landfill' WHEN landuse = 'brownfield' THEN 'brownfield_land' WHEN man_made = 'works' THEN 'industrial_works' ELSE 'industrial_land' END AS asset FROM x
""")
def asset_classes(spark, d):
    x = table(spark, d, "part").select(F.col("p_partkey").alias("k")).selectExpr("k AS site_id", *[f"{e} AS {n}" for n, e in _OSM])
    return x.select("site_id", parcels.osm_asset(F.col("power"), F.col("landuse"), F.col("man_made")).alias("asset"))


_NAME = _pick("k", "Old Redstone Arsenal", "Pine State Prison", "Mesa Solar Farm", "Former Naval Base Annex", "Air Force Base 7", None, "Desert Proving Ground", "Lakeside Works", "Closed correctional facility", "Twin AFB", "Ridge Wind Energy", "Naval Stationery Shop", "Disposal Site Test Track")


@query(f"""
WITH x AS (SELECT k AS site_id, k % 3 = 0 AS osm, {_NAME} AS name FROM (SELECT p_partkey AS k FROM part))
SELECT site_id, name FROM x WHERE NOT (osm AND coalesce(regexp_matches(name, 'solar farm|solar facility|solar plant|solar project|solar generating|wind farm|wind energy|wind project|photovoltaic', 'i'), false))
 AND NOT (osm AND coalesce(regexp_matches(name, '\\bproving ground|\\btest track\\b|aircraft boneyard|\\bammunition plant\\b|\\barsenal\\b|\\bprison\\b|correctional (complex|facility|institution)|\\bnaval (base|station|shipyard)\\b|\\bair force base\\b|\\bafb\\b', 'i'), false)
 AND NOT coalesce(regexp_matches(name, '\\b(old|former|closed|decommission(ed)?|abandoned|disused|disposal)\\b', 'i'), false))
""")
def inactive_names(spark, d):
    """Names of one source that mean an active site go, unless they say that it has closed."""
    x = table(spark, d, "part").select(F.col("p_partkey").alias("k")).selectExpr("k AS site_id", "k % 3 = 0 AS osm", f"{_NAME} AS name")
    return x.filter(~(F.col("osm") & (parcels.renewable(F.col("name")) | parcels.still_active(F.col("name"))))).select("site_id", "name")


_VOLT = _pick("k", "100-161", "220-287", "345", "500", "735 AND ABOVE", "DC", "UNDER 100")


@query(f"""
WITH x AS (SELECT k AS line_id, {_VOLT} AS volt_class, CASE WHEN k % 3 = 0 THEN -999999 WHEN k % 3 = 1 THEN k % 800 END AS kv FROM (SELECT p_partkey AS k FROM part))
SELECT line_id, CASE WHEN kv > 0 THEN kv ELSE CASE volt_class WHEN '100-161' THEN 100 WHEN '220-287' THEN 220 WHEN '345' THEN 345 WHEN '500' THEN 500 WHEN 'DC' THEN 500 WHEN '735 AND ABOVE' THEN 735 END END AS kv,
 CASE volt_class WHEN '100-161' THEN 'sub_class' WHEN '220-287' THEN 'class_3' WHEN '345' THEN 'class_2' WHEN '500' THEN 'class_1' WHEN '735 AND ABOVE' THEN 'class_1' WHEN 'DC' THEN 'class_1' END AS rating,
 CASE WHEN kv >= 345 THEN 'class_1' WHEN kv >= 230 THEN 'class_2' WHEN kv >= 69 THEN 'class_3' WHEN kv IS NOT NULL THEN 'sub_class' END AS station FROM x
""")
def line_classes(spark, d):
    """Sentinels and unknown voltages take the least of their class; lines and stations have different ratings."""
    x = table(spark, d, "part").select(F.col("p_partkey").alias("k")).selectExpr("k AS line_id", f"{_VOLT} AS volt_class", "CASE WHEN k % 3 = 0 THEN -999999 WHEN k % 3 = 1 THEN k % 800 END AS kv")
    return x.select("line_id", rules.line_kv(F.col("kv"), F.col("volt_class")).alias("kv"), rules.line_rating(F.col("volt_class")).alias("rating"), rules.station_class(F.col("kv")).alias("station"))


_STATUS = _pick("k", " Active - study", "Pending", "In Process", "Executed IA", "On Hold", "energized 2020", "In Service", "Operational", "Complete", "Withdrawn by owner", "cancelled", "Suspended", "unclear", None)


@query(f"""
WITH x AS (SELECT k AS project, lower(trim({_STATUS})) AS s FROM (SELECT o_orderkey AS k FROM orders))
SELECT project, CASE WHEN s ^@ 'active' OR s ^@ 'pending' OR s ^@ 'in process' OR s ^@ 'executed' OR s ^@ 'on hold' THEN 'active' WHEN s ^@ 'energized' OR s ^@ 'in service' OR s ^@ 'operational' OR s ^@ 'complete' THEN 'energized'
 WHEN s ^@ 'withdrawn' OR s ^@ 'cancelled' THEN 'withdrawn' WHEN s ^@ 'suspended' THEN 'suspended' ELSE 'unknown' END AS status FROM x
""")
def project_status(spark, d):
    x = table(spark, d, "orders").select(F.col("o_orderkey").alias("k")).selectExpr("k AS project", f"{_STATUS} AS s")
    return x.select("project", rules.queue_status(F.col("s")).alias("status"))


@query("""
SELECT p_partkey, 'v1.0' AS score_version, NULL::VARCHAR AS parcel_count, substr(sha256(p_name), 1, 16) AS source_sha, to_json([p_brand, p_type]) AS tags,
 p_retailprice BETWEEN 1000 AND 1500 AS in_range, p_type NOT IN ('x') AND p_brand IN ('Brand#11', 'Brand#12') AS wanted, round_even(p_partkey * 37.5, -2)::BIGINT AS snapped,
 upper(p_name) LIKE '%A%' AS has_a, DATE '1899-12-30' + (40000 + p_partkey % 3000)::INT AS day, try_cast(CASE WHEN p_partkey % 3 = 0 THEN p_partkey::VARCHAR ELSE 'n/a' END AS DOUBLE) AS number FROM part
""")
def stamped_parts(spark, d):
    """Constants, typed nulls, provenance hashes, lists as JSON, ranges, sets, grid snap, serial days and lenient numbers."""
    p = table(spark, d, "part")
    text = F.when(F.col("p_partkey") % 3 == 0, F.col("p_partkey").cast("string")).otherwise("n/a")
    return p.select(
        "p_partkey", F.lit("v1.0").alias("score_version"), F.lit(None).cast("string").alias("parcel_count"), F.substring(F.sha2(F.col("p_name").cast("binary"), 256), 1, 16).alias("source_sha"), F.to_json(F.array("p_brand", "p_type")).alias("tags"),
        F.col("p_retailprice").between(1000, 1500).alias("in_range"), (~F.col("p_type").isin("x") & F.col("p_brand").isin("Brand#11", "Brand#12")).alias("wanted"), F.bround(F.col("p_partkey") * 37.5, -2).cast("long").alias("snapped"),
        F.contains(F.upper("p_name"), F.lit("A")).alias("has_a"), rules.excel_date(40000 + F.col("p_partkey") % 3000).alias("day"), text.try_cast("double").alias("number"),
    )


# Joins, groups, order ---------------------------------------------------------------------------------------------------


@query("WITH s AS (SELECT s_name, row_number() OVER (ORDER BY s_suppkey) - 1 AS place, count(*) OVER () AS n FROM supplier) SELECT p_partkey, s_name FROM part LEFT JOIN s ON p_partkey % n = place")
def positional_names(spark, d):
    """A column joined to positions of another table, made explicit."""
    s = relational.numbered(table(spark, d, "supplier").select("s_suppkey", "s_name"), [F.col("s_suppkey")])
    n = F.lit(s.count())
    return table(spark, d, "part").join(s, F.col("p_partkey") % n == F.col("place"), "left").select("p_partkey", "s_name")


@query("SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def mapped_nations(spark, d):
    return relational.map_join(table(spark, d, "customer"), table(spark, d, "nation"), "c_nationkey", "n_nationkey", "n_name").select("c_custkey", "n_name")


@query("""
WITH m AS (SELECT o_custkey, CASE o_orderkey % 5 WHEN 0 THEN 'exact' WHEN 1 THEN 'fuzzy_high' WHEN 2 THEN 'fuzzy_high_endpoint' WHEN 3 THEN 'fuzzy_medium' ELSE 'fuzzy_low' END AS method, o_orderkey % 5 AS r FROM orders)
SELECT o_custkey, first(method ORDER BY r) AS best FROM m GROUP BY 1
""")
def best_methods(spark, d):
    names = F.array(*map(F.lit, ("exact", "fuzzy_high", "fuzzy_high_endpoint", "fuzzy_medium", "fuzzy_low")))
    m = table(spark, d, "orders").withColumn("method", F.get(names, (F.col("o_orderkey") % 5).cast("int")))
    return relational.best_by_rank(m, ["o_custkey"], F.col("method"), rules.method_rank(F.col("method")))


@query("""
SELECT l_returnflag, round(corr(l_quantity, l_extendedprice), 6) AS corr, round(quantile_cont(l_quantity, 0.7), 4) AS p70, round(stddev_samp(l_quantity), 6) AS sd FROM lineitem GROUP BY 1
""")
def flag_statistics(spark, d):
    """Correlation, 70th percentile and deviation by group; the percentile from counts by value, which any group size leaves small."""
    line = table(spark, d, "lineitem")
    counts = line.groupBy("l_returnflag", F.col("l_quantity").alias("q")).agg(F.count(F.lit(1)).alias("k"))
    p70 = counts.groupBy("l_returnflag").agg(F.round(F.expr("percentile(q, 0.7, k)"), 4).alias("p70"))
    rest = line.groupBy("l_returnflag").agg(F.round(F.corr("l_quantity", "l_extendedprice"), 6).alias("corr"), F.round(F.stddev_samp("l_quantity"), 6).alias("sd"))
    return rest.join(p70, "l_returnflag").select("l_returnflag", "corr", "p70", "sd")


@query("SELECT c, count(*) AS n FROM (SELECT CASE WHEN c_nationkey % 7 > 0 THEN c_mktsegment END AS c FROM customer) GROUP BY 1")
def segment_counts(spark, d):
    return relational.value_counts(table(spark, d, "customer").select(F.when(F.col("c_nationkey") % 7 > 0, F.col("c_mktsegment")).alias("c")), "c")


@query(f"WITH {SITES}, {sites.BOXES} SELECT min(xmin) AS xmin, min(ymin) AS ymin, max(xmax) AS xmax, max(ymax) AS ymax FROM boxes")
def parcel_bounds(spark, d):
    return relational.total_bounds(sites.boxes(spark, d))


@query("""
WITH r AS (SELECT p_partkey, (p_partkey * 37 % 101)::DOUBLE AS v, row_number() OVER (ORDER BY p_partkey) AS place FROM part), b AS (SELECT *, lag(v) OVER (ORDER BY place) AS before FROM r)
SELECT p_partkey, v, before FROM b WHERE v - before > 0.5
""")
def price_rises(spark, d):
    """Rows that break a falling order."""
    r = table(spark, d, "part").select("p_partkey", (F.col("p_partkey") * 37 % 101).cast("double").alias("v"))
    return relational.rises(r, [F.col("p_partkey")], "v", 0.5, 500).select("p_partkey", "v", "before")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice IS NOT NULL ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def largest_orders(spark, d):
    return relational.n_largest(table(spark, d, "orders"), "o_totalprice", 25, "o_orderkey").select("o_orderkey", "o_totalprice")


@query("""
WITH l AS (SELECT l_orderkey, list({'w': -l_quantity::BIGINT, 'i': l_linenumber} ORDER BY l_quantity DESC, l_linenumber) AS x FROM lineitem GROUP BY 1)
SELECT l_orderkey, array_to_string(list_transform(x[1:3], lambda y: y.i::VARCHAR), ',') AS top FROM l
""")
def top_lines(spark, d):
    """The three heaviest entries of each list, ties in the list's order."""
    l = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct((-F.col("l_quantity")).cast("long").alias("w"), F.col("l_linenumber").alias("i")))).alias("x"))  # at most seven lines an order
    return l.select("l_orderkey", F.array_join(F.transform(F.slice("x", 1, 3), lambda y: y["i"].cast("string")), ",").alias("top"))


@query("SELECT c_custkey FROM customer ORDER BY md5('7:' || c_custkey), c_custkey LIMIT 30")
def sampled_customers(spark, d):
    return relational.seeded_sample(table(spark, d, "customer"), "c_custkey", 30, 7).select("c_custkey")


@query("SELECT min(c_custkey) AS c_custkey, c_nationkey, c_mktsegment FROM customer GROUP BY 2, 3")
def distinct_by_keys(spark, d):
    return relational.first_per_key(table(spark, d, "customer"), ["c_nationkey", "c_mktsegment"], [F.col("c_custkey")]).select("c_custkey", "c_nationkey", "c_mktsegment")


@query("""
WITH a AS (SELECT DISTINCT l_suppkey AS id FROM lineitem), b AS (SELECT s_suppkey AS id FROM supplier WHERE s_acctbal > 0)
SELECT (SELECT count(*) FROM (FROM a EXCEPT FROM b)) AS only_left, (SELECT count(*) FROM (FROM b EXCEPT FROM a)) AS only_right, (SELECT count(*) FROM (FROM a EXCEPT FROM b)) + (SELECT count(*) FROM (FROM b EXCEPT FROM a)) = 0 AS equal
""")
def same_suppliers(spark, d):
    return relational.same_ids(table(spark, d, "lineitem").select(F.col("l_suppkey").alias("id")), table(spark, d, "supplier").filter("s_acctbal > 0").select(F.col("s_suppkey").alias("id")), "id")


@query("""
WITH g AS (SELECT s_suppkey::VARCHAR AS id, s_name AS name, s_acctbal AS score FROM supplier), r AS (SELECT c_custkey::VARCHAR AS id, c_name AS name, c_mktsegment AS asset, c_nationkey AS known FROM customer)
SELECT id, name, NULL AS asset, score, NULL AS known FROM g UNION ALL SELECT CASE WHEN (SELECT count(*) FROM g JOIN r USING (id)) > 0 THEN 'REUSE-' || id ELSE id END, name, asset, NULL, known FROM r
""")
def merged_tables(spark, d):
    """Final merge: column order with insertions, ids of the second table prefixed as some clash."""
    g = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("score"))
    r = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("asset"), F.col("c_nationkey").alias("known"))
    return relational.merge_tables(g, r, "id", {"name": ["asset"]})


# Sources and nodes ------------------------------------------------------------------------------------------------------


_COUNTIES = "c AS (SELECT s_suppkey AS county_id, 'County ' || s_suppkey AS county, (s_suppkey * 15485863 + 271828) % 1000000 - 60000 AS xmin, (s_suppkey * 32452843 + 314159) % 1000000 - 60000 AS ymin FROM supplier)"


@query(f"""
WITH p AS (SELECT *, p_partkey * 7919 % 1000000 AS x, p_partkey * 104729 % 1000000 AS y, CASE WHEN p_size % 2 = 0 THEN 'retired' ELSE 'retiring' END AS st FROM part), {_COUNTIES},
e AS (SELECT 'EIA-' || p_partkey || '-' || st AS site_id, p_name AS site_name, 'S' || p_size % 5 AS state_abbr, NULL::VARCHAR AS county_name, 'EIA-860' AS source, p_type AS reuse_asset_type, st AS reuse_status, p_size::DOUBLE AS capacity_mw, NULL::DOUBLE AS acreage, 1990 + p_size % 40 AS retirement_year, p_type AS dominant_technology, NULL::VARCHAR AS epa_program, x, y FROM p WHERE p_partkey % 4 = 0),
n AS (SELECT 'NRC-' || trim(regexp_replace(p_name, '\\W+', '-', 'g'), '-'), p_name, 'S' || p_size % 5, NULL, 'EIA-860-nuclear', 'nuclear', 'operating', p_size::DOUBLE, NULL, NULL, NULL, NULL, x, y FROM p WHERE p_partkey % 4 = 1),
q AS (SELECT 'EPA-' || p_partkey, p_name, 'S' || p_size % 5, CASE WHEN p_size % 4 > 0 THEN p_brand END, 'EPA-RE-Powering', p_type, 'active_industrial', NULL, try_cast(CASE WHEN p_size % 3 = 0 THEN 'unknown' ELSE p_size::VARCHAR END AS DOUBLE), NULL, NULL, p_brand, x, y FROM p WHERE p_partkey % 4 = 2),
o AS (SELECT 'OSM-' || p_partkey, p_name, 'S' || p_size % 5, NULL, 'OpenStreetMap', p_type, 'active_industrial', NULL, p_size::DOUBLE, NULL, NULL, NULL, x, y FROM p WHERE p_partkey % 4 = 3),
a AS (FROM e UNION ALL FROM n UNION ALL FROM q UNION ALL FROM o), h AS (SELECT DISTINCT x, y, first(county ORDER BY county_id) AS found FROM a JOIN c ON x > xmin AND x < xmin + 120000 AND y > ymin AND y < ymin + 120000 GROUP BY x, y)
SELECT a.* REPLACE (coalesce(county_name, found) AS county_name, a.x::DOUBLE AS x, a.y::DOUBLE AS y) FROM a LEFT JOIN h ON h.x = a.x AND h.y = a.y
""")
def normalised_nodes(spark, d):
    """Four sources as one table of reuse nodes with prefixed ids; missing counties by the county that holds the place."""
    p, k, size = table(spark, d, "part"), F.col("p_partkey"), F.col("p_size")
    p = p.withColumn("x", k * 7919 % 1000000).withColumn("y", k * 104729 % 1000000).withColumn("state", F.concat(F.lit("S"), size % 5))
    own = {"name": "p_name", "state": "state", "asset_type": "p_type", "x": "x", "y": "y"}
    of = lambda rest: p.filter(k % 4 == rest)
    acres = F.when(size % 3 == 0, "unknown").otherwise(size.cast("string"))
    all_ = nodes.normalised(
        nodes.Source(of(0), own | {"id": k, "status": F.when(size % 2 == 0, "retired").otherwise("retiring"), "mw": size, "year": 1990 + size % 40, "technology": "p_type"}), nodes.Source(of(1), own | {"status": F.lit("operating"), "mw": size}),
        nodes.Source(of(2), own | {"id": k, "county": F.when(size % 4 > 0, F.col("p_brand")), "acreage": acres, "program": "p_brand"}), nodes.Source(of(3), own | {"id": k, "acreage": size}))
    s = F.col("s_suppkey")
    west, south = (s * 15485863 + 271828) % 1000000 - 60000, (s * 32452843 + 314159) % 1000000 - 60000
    counties = table(spark, d, "supplier").select(s.alias("county_id"), F.concat(F.lit("County "), s).alias("county"), F.array(geometry.box_ring(west, south, west + 120000, south + 120000)).alias("rings"))
    return nodes.with_counties(all_, counties, "county_id", "county", "rings", 60000)


@query(f"""
WITH {SITES}, {sites.BOXES}, m AS (SELECT site_id AS id, xmin, ymin, xmax, ymax, ((xmax - xmin) * (ymax - ymin))::DOUBLE AS area FROM boxes),
n AS (SELECT c_custkey AS site_id, CASE WHEN c_custkey % 11 > 0 THEN c_custkey * 7919 % 1000000 + c_custkey % 90 - 45 END AS x, c_custkey * 104729 % 1000000 + c_custkey % 70 AS y, c_custkey % 6 = 5 AS own, CASE WHEN c_custkey % 4 = 1 THEN c_custkey * 37 % 9000 END::DOUBLE AS acreage,
 ['nuclear', 'coal_plant', 'gas_plant', 'landfill'][c_custkey % 4 + 1] AS asset, CASE WHEN c_custkey % 3 = 0 THEN 'Natural Gas Steam Turbine' WHEN c_custkey % 3 = 1 THEN 'Gas Combustion' END AS tech, (c_custkey * 13 % 3000)::DOUBLE AS mw FROM customer),
h AS (SELECT site_id, first(id ORDER BY area, id) AS id, min(area) AS area FROM n JOIN m ON x > xmin AND x < xmax AND y > ymin AND y < ymax WHERE NOT own GROUP BY 1),
t AS (SELECT n.*, h.id, h.area, CASE asset WHEN 'nuclear' THEN greatest(800, least(3000, 0.5::DOUBLE * mw + 600)) WHEN 'coal_plant' THEN greatest(300, least(2000, 0.5::DOUBLE * mw + 200))
  WHEN 'gas_plant' THEN CASE WHEN tech LIKE '%Steam Turbine%' THEN greatest(40, least(150, 0.1::DOUBLE * mw + 40)) ELSE greatest(10, least(40, 0.05::DOUBLE * mw + 10)) END END AS plant FROM n LEFT JOIN h ON h.site_id = n.site_id),
s AS (SELECT *, CASE WHEN own THEN 1 WHEN area * 0.000247105::DOUBLE <= 5000 THEN 2 WHEN acreage > 0 THEN 3 WHEN plant IS NOT NULL THEN 4 ELSE 5 END AS step FROM t)
SELECT site_id, ['OSM_POLYGON', 'OSM_POLYGON_MATCH', 'BUFFER_FROM_ACREAGE', 'BUFFER_FROM_CAPACITY', 'DEFAULT_BUFFER'][step] AS geometry_source, ['HIGH', 'HIGH', 'MEDIUM', 'MEDIUM', 'LOW'][step] AS geometry_confidence, CASE WHEN step = 2 THEN id END AS matched_id,
 round(CASE WHEN step = 1 THEN 250000 WHEN step = 2 THEN area WHEN x IS NULL THEN NULL ELSE least(5000, CASE step WHEN 3 THEN acreage WHEN 4 THEN plant ELSE 200 END) * 4046.856::DOUBLE END * 0.000247105::DOUBLE, 4) AS footprint_acres FROM s
""")
def node_footprints(spark, d):
    """The ladder of footprints as shapes: own, smallest container, squares of acreages, of capacities, of nothing known."""
    k = F.col("c_custkey")
    n = table(spark, d, "customer").select(k.alias("site_id"), F.when(k % 11 > 0, k * 7919 % 1000000 + k % 90 - 45).cast("double").alias("x"), (k * 104729 % 1000000 + k % 70).cast("double").alias("y"), F.when(k % 4 == 1, k * 37 % 9000).cast("double").alias("acreage"),
        F.get(F.array(*map(F.lit, ("nuclear", "coal_plant", "gas_plant", "landfill"))), (k % 4).cast("int")).alias("reuse_asset_type"), F.when(k % 3 == 0, "Natural Gas Steam Turbine").when(k % 3 == 1, "Gas Combustion").alias("dominant_technology"), (k * 13 % 3000).cast("double").alias("capacity_mw"))
    zero = F.lit(0)
    n = n.withColumn("rings", F.when(F.col("site_id") % 6 == 5, F.array(geometry.box_ring(zero, zero, F.lit(500), F.lit(500)))))
    b = sites.boxes(spark, d).select("site_id", F.array(geometry.box_ring(F.col("xmin"), F.col("ymin"), F.col("xmax"), F.col("ymax"))).alias("shape"))
    out = nodes.footprints(n, b.withColumnRenamed("site_id", "shape_id"), "shape_id", "shape", 4000)
    return out.select("site_id", "geometry_source", "geometry_confidence", "matched_id", F.round("footprint_acres", 4).alias("footprint_acres"))


_CLEAN = [("source", "CASE k % 4 WHEN 0 THEN 'EIA-860' WHEN 1 THEN 'EIA-860-nuclear' WHEN 2 THEN 'EPA-RE-Powering' ELSE 'OpenStreetMap' END"), ("name", _NAME), ("x", "k * 7919 % 1000000"), ("y", "k * 104729 % 1000000"), ("asset", _pick("k", "power_plant", "landfill", "coal_plant")), ("trust", _pick("k", "HIGH", "MEDIUM", "LOW", "HIGH", "MEDIUM")), ("acres", "k % 120")]


@query(f"""
WITH x AS (SELECT k AS site_id, {", ".join(f"{e} AS {n}" for n, e in _CLEAN)} FROM (SELECT p_partkey AS k FROM part)),
c AS (SELECT *, row_number() OVER w AS place, count(*) OVER (PARTITION BY x // 20000, y // 20000) AS alias_count FROM x WINDOW w AS (PARTITION BY x // 20000, y // 20000 ORDER BY CASE source WHEN 'EIA-860' THEN 4 WHEN 'EIA-860-nuclear' THEN 3 WHEN 'EPA-RE-Powering' THEN 2 ELSE 1 END DESC, length(coalesce(name, '')) DESC, site_id))
SELECT site_id, source, alias_count FROM c WHERE place = 1 AND trust <> 'LOW' AND NOT (source = 'OpenStreetMap' AND asset = 'power_plant') AND NOT (source = 'EPA-RE-Powering' AND acres < 50)
 AND NOT (source = 'OpenStreetMap' AND coalesce(regexp_matches(name, 'solar farm|solar facility|solar plant|solar project|solar generating|wind farm|wind energy|wind project|photovoltaic', 'i'), false))
 AND NOT (source = 'OpenStreetMap' AND coalesce(regexp_matches(name, '\\bproving ground|\\btest track\\b|aircraft boneyard|\\bammunition plant\\b|\\barsenal\\b|\\bprison\\b|correctional (complex|facility|institution)|\\bnaval (base|station|shipyard)\\b|\\bair force base\\b|\\bafb\\b', 'i'), false)
  AND NOT coalesce(regexp_matches(name, '\\b(old|former|closed|decommission(ed)?|abandoned|disused|disposal)\\b', 'i'), false))
""")
def cleaned_nodes(spark, d):
    """All six steps of the reuse cleanup, in their order: one survivor of each cluster, then five kinds of rows go."""
    x = table(spark, d, "part").select(F.col("p_partkey").alias("k")).selectExpr("k AS site_id", *[f"{e} AS {n}" for n, e in _CLEAN])
    rank = rules.lookup(F.col("source"), {"EIA-860": 4, "EIA-860-nuclear": 3, "EPA-RE-Powering": 2}, 1)
    best = F.min(F.struct((-rank).alias("r"), (-F.length(F.coalesce("name", F.lit("")))).alias("l"), "site_id", "source", "name", "asset", "trust", "acres")).alias("b")
    c = x.groupBy(F.expr("x div 20000"), F.expr("y div 20000")).agg(best, F.count(F.lit(1)).alias("alias_count")).select("b.*", "alias_count")
    osm = F.col("source") == "OpenStreetMap"
    gone = (F.col("trust") == "LOW") | (osm & (F.col("asset") == "power_plant")) | ((F.col("source") == "EPA-RE-Powering") & (F.col("acres") < 50)) | (osm & (parcels.renewable(F.col("name")) | parcels.still_active(F.col("name"))))
    return c.filter(~gone).select("site_id", "source", "alias_count")


_GENERATORS = """g AS (SELECT l_suppkey AS plant, CASE WHEN l_returnflag = 'R' THEN 'retired' WHEN l_returnflag = 'A' THEN 'retiring' ELSE 'existing' END AS status, CASE WHEN l_orderkey % 6 > 0 THEN 'fuel ' || l_linenumber END AS fuel, CASE WHEN l_partkey % 5 > 0 THEN 'tech ' || l_partkey % 4 END AS tech,
 l_quantity::BIGINT AS mw, CASE WHEN l_orderkey % 3 > 0 THEN year(l_shipdate) END AS year, l_orderkey * 10 + l_linenumber AS unit, l_linestatus AS name, l_orderkey % 97 AS lon, CASE WHEN l_suppkey % 13 > 0 THEN l_partkey % 89 END AS lat FROM lineitem)"""


def _generators(spark, d):
    k = F.col
    return table(spark, d, "lineitem").select(
        k("l_suppkey").alias("plant"), F.when(k("l_returnflag") == "R", "retired").when(k("l_returnflag") == "A", "retiring").otherwise("existing").alias("status"), F.when(k("l_orderkey") % 6 > 0, F.concat(F.lit("fuel "), k("l_linenumber"))).alias("fuel"),
        F.when(k("l_partkey") % 5 > 0, F.concat(F.lit("tech "), k("l_partkey") % 4)).alias("tech"), k("l_quantity").cast("long").alias("mw"), F.when(k("l_orderkey") % 3 > 0, F.year("l_shipdate")).alias("year"), (k("l_orderkey") * 10 + k("l_linenumber")).alias("unit"),
        k("l_linestatus").alias("name"), (k("l_orderkey") % 97).alias("lon"), F.when(k("l_suppkey") % 13 > 0, k("l_partkey") % 89).alias("lat"))


@query(f"""
WITH {_GENERATORS}, p AS (SELECT plant, status, sum(mw)::BIGINT AS mw, max(year)::INT AS year, count(*) AS n_generators, first(name ORDER BY unit, mw) AS name, first(lon ORDER BY unit, mw) AS lon, first(lat ORDER BY unit, mw) AS lat FROM g WHERE status <> 'existing' AND fuel IS NOT NULL GROUP BY ALL),
f AS (SELECT plant, status, first(fuel ORDER BY m DESC, fuel) AS fuel FROM (SELECT plant, status, fuel, sum(mw) AS m FROM g WHERE fuel IS NOT NULL GROUP BY ALL) GROUP BY ALL), t AS (SELECT plant, status, first(tech ORDER BY m DESC, tech) AS tech FROM (SELECT plant, status, tech, sum(mw) AS m FROM g WHERE tech IS NOT NULL AND fuel IS NOT NULL GROUP BY ALL) GROUP BY ALL)
SELECT p.*, f.fuel, t.tech FROM p JOIN f USING (plant, status) LEFT JOIN t USING (plant, status) WHERE mw >= 10 AND lat IS NOT NULL
""")
def plant_rollup(spark, d):
    """Retired and retiring generators as plants of 10 MW and more: dominant fuel and technology by capacity, latest retirement, and
    name and place of the first unit; plants without a place go."""
    return nodes.plants(_generators(spark, d).filter("status <> 'existing' AND fuel IS NOT NULL"), ["plant", "status"], 10)


@query(f"""
WITH {_GENERATORS}, p AS (SELECT plant, first(name ORDER BY unit, mw) AS name, bool_and(status = 'retired') AS gone, sum(mw)::BIGINT AS mw, max(year) AS year, first(lon ORDER BY unit, mw) AS lon, first(lat ORDER BY unit, mw) AS lat FROM g WHERE fuel IN ('fuel 1', 'fuel 2') AND unit % 4 > 0 GROUP BY 1)
SELECT plant, name, CASE WHEN gone THEN 'retired' ELSE 'operating' END AS status, mw, CASE WHEN gone THEN year END::INT AS year, lon, lat FROM p WHERE lat IS NOT NULL
""")
def nuclear_sites(spark, d):
    """Reactors as sites: retired only where every unit is."""
    return nodes.nuclear_plants(_generators(spark, d).filter("fuel IN ('fuel 1', 'fuel 2') AND unit % 4 > 0"), ["plant"])


# Parcels ----------------------------------------------------------------------------------------------------------------


@query("""
WITH x AS (SELECT p_partkey AS k, [CASE WHEN p_partkey % 7 = 0 THEN 'AE' END, CASE WHEN p_partkey % 3 = 0 THEN 'X' END, CASE WHEN p_partkey % 11 = 0 THEN 'VE' END] AS zones,
 list_filter([CASE WHEN p_partkey % 13 = 0 THEN 'PFO1A' END, CASE WHEN p_partkey % 4 = 0 THEN 'PEM1C' END, CASE WHEN p_partkey % 5 = 0 THEN 'R2UBH' END], lambda c: c IS NOT NULL) AS codes, (p_partkey % 25)::DOUBLE AS percent, CASE WHEN p_partkey % 6 > 0 THEN (p_partkey % 70)::DOUBLE / 100 END AS pga, CASE WHEN p_partkey % 5 > 0 THEN (p_partkey % 120)::DOUBLE / 10 END AS slope FROM part)
SELECT k AS parcel, len(list_filter(zones, lambda z: z IN ('A', 'AE', 'AH', 'AO', 'V', 'VE'))) > 0 AS flooded,
 CASE WHEN len(list_filter(zones, lambda z: z IN ('A', 'AE', 'AH', 'AO', 'V', 'VE'))) > 0 THEN 'sfha_confirmed' WHEN len(list_filter(zones, lambda z: z IS NOT NULL)) > 0 THEN 'zone_x_confirmed' ELSE 'no_data_returned' END AS flood_source,
 CASE WHEN len(codes) = 0 THEN 'none' WHEN len(list_filter(codes, lambda c: c ^@ 'PFO')) > 0 OR (len(list_filter(codes, lambda c: c ^@ 'PEM')) > 0 AND percent > 10) THEN 'jurisdictional_permit_required' WHEN len(list_filter(codes, lambda c: c ^@ 'PEM')) > 0 THEN 'non_jurisdictional' ELSE 'hydric_only' END AS wetland,
 CASE WHEN pga IS NULL OR pga < 0.1 THEN 'Low' WHEN pga < 0.25 THEN 'Moderate' WHEN pga < 0.5 THEN 'High' ELSE 'Very_High' END AS seismic, CASE WHEN slope IS NULL OR slope < 2 THEN 'Flat' WHEN slope < 5 THEN 'Gentle' WHEN slope < 8 THEN 'Hilly' ELSE 'Very_Hilly' END AS slope FROM x
""")
def parcel_bands(spark, d):
    k = F.col("p_partkey")
    zones = F.array(F.when(k % 7 == 0, "AE"), F.when(k % 3 == 0, "X"), F.when(k % 11 == 0, "VE"))
    codes = F.array_compact(F.array(F.when(k % 13 == 0, "PFO1A"), F.when(k % 4 == 0, "PEM1C"), F.when(k % 5 == 0, "R2UBH")))
    p = table(spark, d, "part").withColumn("zones", zones).withColumn("codes", codes)
    bad, source = parcels.flood_source(F.col("zones"))
    pga, slope = F.when(k % 6 > 0, (k % 70).cast("double") / 100), F.when(k % 5 > 0, (k % 120).cast("double") / 10)
    return p.select(k.alias("parcel"), F.coalesce(bad, F.lit(False)).alias("flooded"), source.alias("flood_source"), parcels.wetland_band(F.col("codes"), (k % 25).cast("double")).alias("wetland"), parcels.seismic_band(pga).alias("seismic"), parcels.slope_band(slope).alias("slope"))


_HORIZON = "SELECT l_orderkey AS cokey, l_linenumber AS layer, l_linenumber * 30 AS top, CASE WHEN l_linenumber % 3 > 0 THEN l_quantity % 12 END AS lep, CASE WHEN l_linenumber % 4 > 0 THEN l_quantity % 30 END AS om FROM lineitem"


@query(f"""
WITH horizon AS ({_HORIZON}), component AS (SELECT o_orderkey AS cokey, o_custkey AS mukey, 20 + o_orderkey % 80 AS percent, o_orderstatus <> 'P' AS major, CASE o_orderkey % 4 WHEN 0 THEN 'Well drained' WHEN 1 THEN 'Poorly drained' WHEN 2 THEN 'Moderately well drained' END AS drainage FROM orders),
area AS (SELECT c_custkey AS mukey, c_nationkey AS parcel, 1 + c_custkey % 9 AS overlap FROM customer), whole AS (SELECT parcel, sum(overlap) AS total FROM area GROUP BY 1),
x AS (SELECT a.parcel, c.cokey, c.drainage, a.overlap * 100.0::DOUBLE / w.total * c.percent / 100.0::DOUBLE AS share, (SELECT max(lep) FROM horizon h WHERE h.cokey = c.cokey AND h.top < 152)::DOUBLE AS lep, (SELECT max(om) FROM horizon h WHERE h.cokey = c.cokey AND h.top < 60)::DOUBLE AS om
 FROM area a JOIN whole w USING (parcel) JOIN component c ON c.mukey = a.mukey AND c.major),
f AS (SELECT *, coalesce(lep >= 6, false) OR coalesce(om >= 20, false) AS bad, coalesce(drainage = 'Poorly drained', false) AS wet, coalesce(drainage = 'Well drained', false) AND NOT coalesce(lep >= 3, false) AND NOT coalesce(om >= 20, false) AS good FROM x),
g AS (SELECT parcel, sum(share) AS total, coalesce(sum(share) FILTER (bad OR wet), 0) AS poor, coalesce(sum(share) FILTER (good), 0) AS good, coalesce(sum(share) FILTER (bad), 0) AS bad, first(lep ORDER BY share DESC, cokey) AS lep, first(drainage ORDER BY share DESC, cokey) AS drainage FROM f GROUP BY 1)
SELECT parcel, bad > 50 AS disqualified, CASE WHEN total = 0 THEN 'Good' WHEN poor >= 0.5 * total THEN 'Poor' WHEN good >= 0.7 * total THEN 'Good' ELSE 'Moderate' END AS band, drainage, CASE WHEN lep < 3 THEN 'Low' WHEN lep < 6 THEN 'Moderate' WHEN lep < 9 THEN 'High' WHEN lep IS NOT NULL THEN 'Very High' END AS shrink_swell FROM g
""")
def soil_bands(spark, d):
    """The soil service's query and what follows it: deepest values of each component's horizons within depth limits, shares
    of the parcel, bearing band, disqualification and the dominant component."""
    line = table(spark, d, "lineitem")
    top = F.col("l_linenumber") * 30
    layers = line.groupBy(F.col("l_orderkey").alias("cokey")).agg(F.max(F.when((top < 152) & (F.col("l_linenumber") % 3 > 0), F.col("l_quantity") % 12)).cast("double").alias("lep"), F.max(F.when((top < 60) & (F.col("l_linenumber") % 4 > 0), F.col("l_quantity") % 30)).cast("double").alias("om"))
    key = F.col("o_orderkey")
    drainage = F.get(F.array(F.lit("Well drained"), F.lit("Poorly drained"), F.lit("Moderately well drained"), F.lit(None).cast("string")), (key % 4).cast("int"))
    component = table(spark, d, "orders").filter("o_orderstatus <> 'P'").select(key.alias("cokey"), F.col("o_custkey").alias("mukey"), (20 + key % 80).alias("percent"), drainage.alias("drainage"))
    area = table(spark, d, "customer").select(F.col("c_custkey").alias("mukey"), F.col("c_nationkey").alias("parcel"), (1 + F.col("c_custkey") % 9).alias("overlap"))
    whole = area.groupBy("parcel").agg(F.sum("overlap").alias("total"))
    x = area.join(whole, "parcel").join(component, "mukey").join(layers, "cokey", "left").withColumn("share", F.col("overlap") * 100.0 / F.col("total") * F.col("percent") / 100.0)
    poor, good, bad = parcels.soil_flags(F.col("lep"), F.col("om"), F.col("drainage"))
    s = lambda cond: F.sum(F.when(cond, F.col("share")).otherwise(0.0))
    g = x.groupBy("parcel").agg(F.sum("share").alias("total"), s(poor).alias("poor"), s(good).alias("good"), s(bad).alias("bad"), F.min(F.struct((-F.col("share")).alias("s"), "cokey", "lep", "drainage")).alias("first"))
    return g.select("parcel", (F.col("bad") > 50).alias("disqualified"), parcels.bearing_band(F.col("total"), F.col("poor"), F.col("good")).alias("band"), F.col("first.drainage").alias("drainage"), parcels.shrink_swell(F.col("first.lep")).alias("shrink_swell"))


@query("""
WITH x AS (SELECT s_suppkey AS k, unnest(range(0, 6)) AS i FROM supplier), c AS (SELECT k, (i + 1)::DOUBLE * (1 + k % 5) / 20 AS x, CASE WHEN k % 9 = 0 AND i > 0 THEN 0 ELSE exp(-2.0::DOUBLE * i - (k % 7)) END AS y FROM x),
v AS (SELECT k, ln(x) AS lx, ln(y) AS ly FROM c WHERE y > 0), n AS (SELECT k, count(*) AS n FROM v GROUP BY 1), t AS (SELECT ln(0.000404::DOUBLE) AS t),
b AS (SELECT k, max(ly) AS ya, first(lx ORDER BY ly DESC) AS xa FROM v, t WHERE ly <= t GROUP BY 1), a AS (SELECT k, min(ly) AS yb, first(lx ORDER BY ly) AS xb FROM v, t WHERE ly > t GROUP BY 1)
SELECT s_suppkey AS k, CASE WHEN coalesce(n, 0) >= 2 THEN round(exp(CASE WHEN ya IS NULL THEN xb WHEN yb IS NULL THEN xa ELSE xa + (t - ya) / (yb - ya) * (xb - xa) END), 8) END AS pga
 FROM supplier CROSS JOIN t LEFT JOIN n ON n.k = s_suppkey LEFT JOIN a ON a.k = s_suppkey LEFT JOIN b ON b.k = s_suppkey
""")
def hazard_values(spark, d):
    k = F.col("s_suppkey")
    curve = F.transform(F.sequence(F.lit(0), F.lit(5)), lambda i: F.struct(((i + 1).cast("double") * (1 + k % 5) / 20).alias("x"), F.when((k % 9 == 0) & (i > 0), F.lit(0.0)).otherwise(F.exp(-2.0 * i - (k % 7))).alias("y")))
    return table(spark, d, "supplier").select(k.alias("k"), F.round(parcels.hazard_value(curve), 8).alias("pga"))


@query(f"""
WITH x AS (SELECT k, {_pick("k", "25", "43", "47", "57", None)} AS lsad, {_pick("k", "A", "S", "F")} AS status, {_pick("k", "I", "U", "S", "M")} AS route FROM (SELECT c_custkey AS k FROM customer))
SELECT k, coalesce(lsad IN ('25', '43', '47'), false) OR status IN ('A', 'B', 'C') AS incorporated, route = 'I' AS interstate, route = 'U' AS us_highway FROM x WHERE route IN ('I', 'U')
""")
def place_flags(spark, d):
    x = table(spark, d, "customer").select(F.col("c_custkey").alias("k")).selectExpr("k", f"{_pick('k', '25', '43', '47', '57', None)} AS lsad", f"{_pick('k', 'A', 'S', 'F')} AS status", f"{_pick('k', 'I', 'U', 'S', 'M')} AS route")
    return x.filter(F.col("route").isin("I", "U")).select("k", parcels.incorporated(F.col("lsad"), F.col("status")).alias("incorporated"), (F.col("route") == "I").alias("interstate"), (F.col("route") == "U").alias("us_highway"))


_OPERATOR = _pick("k", "Kinder Morgan Inc", "Texas Eastern Trans Co", "Iroquois Gas Trans Co", "Small Local Gas", "ANR", "", None, "Great Lakes", "Questar Pipeline Co")
_KIND = _pick("k", "Interstate", "Intrastate", "Gathering", "Interstate")


#: Names to try the lists on: their own, some of the first tier only, and strangers; cut, in capitals, or with more behind.
_NAMES = (*parcels.TRUNK_OPERATORS, *parcels.MIDDLING_OPERATORS, *(w.title() + " Midstream" for w in parcels.TIER_1_WORDS), "Gas", "Hill Country Gathering", "")
_ARRAY = lambda names: "[" + ", ".join(f"'{n}'" for n in names) + "]"
_SHOWN = "CASE k // {n} % 4 WHEN 0 THEN {at} WHEN 1 THEN upper({at}) WHEN 2 THEN {at} || ' of Texas' ELSE substr({at}, 1, 9) END"


@query(f"""
WITH n AS (SELECT s_suppkey AS k, 0 AS source FROM supplier UNION ALL SELECT p_partkey, 1 FROM part), x AS (SELECT k, source, {_SHOWN.format(n=len(_NAMES), at=f"{_ARRAY(_NAMES)}[k % {len(_NAMES)} + 1]")} AS operator, {_KIND} AS kind FROM n), u AS (SELECT *, upper(operator) AS u FROM x),
t AS (SELECT *, CASE WHEN len(list_filter({_ARRAY(parcels.TIER_1_WORDS)}, lambda w: contains(u, w))) > 0 THEN 'tier_1' ELSE 'other' END AS tier FROM u)
SELECT k, source, operator, tier, CASE WHEN u <> '' AND len(list_filter({_ARRAY(parcels.TRUNK_OPERATORS)}, lambda w: contains(u, upper(w)) OR contains(upper(w), u))) > 0 THEN 30
 WHEN u <> '' AND len(list_filter({_ARRAY(parcels.MIDDLING_OPERATORS)}, lambda w: contains(u, upper(w)) OR contains(upper(w), u))) > 0 THEN 20
 WHEN kind = 'Interstate' AND tier = 'tier_1' THEN 24 WHEN kind = 'Interstate' THEN 14 WHEN tier = 'tier_1' THEN 12 ELSE 8 END AS inches FROM t
""")
def pipeline_operators(spark, d):
    """Operators' tiers and the estimated width of their lines, over all names of the lists."""
    n = table(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.lit(0).alias("source")).union(table(spark, d, "part").select("p_partkey", F.lit(1)))
    at = F.get(F.array(*map(F.lit, _NAMES)), (F.col("k") % len(_NAMES)).cast("int"))
    way = F.expr(f"k div {len(_NAMES)} % 4")
    shown = F.when(way == 0, at).when(way == 1, F.upper(at)).when(way == 2, F.concat(at, F.lit(" of Texas"))).otherwise(F.substring(at, 1, 9))
    x = n.withColumn("operator", shown).withColumn("kind", F.expr(_KIND)).withColumn("tier", parcels.operator_tier(F.col("operator")))
    return x.select("k", "source", "operator", "tier", parcels.estimated_inches(F.col("operator"), F.col("kind"), F.col("tier")).alias("inches"))


# Capacity ---------------------------------------------------------------------------------------------------------------


@query("""
WITH t AS (SELECT s_suppkey AS id, CASE s_suppkey % 4 WHEN 0 THEN 'PJM INTERCONNECTION, LLC' WHEN 1 THEN 'SALT RIVER PROJECT' WHEN 2 THEN 'TUCSON ELECTRIC POWER COMPANY' ELSE 'UNKNOWN' END AS area FROM supplier),
f AS (SELECT c_custkey AS code, CASE WHEN c_custkey = 1 THEN 'PJM' WHEN c_custkey = 2 THEN 'AZPS' END AS ba, 100 + c_custkey % 900 AS peak, c_nationkey AS mean FROM customer WHERE c_acctbal > 0),
d AS (SELECT t.id, f.peak, f.mean, 'utility' AS level FROM t JOIN f ON f.code = t.id),
b AS (SELECT t.id, f.peak, f.mean, 'ba' AS level FROM t JOIN f ON f.ba = CASE t.area WHEN 'PJM INTERCONNECTION, LLC' THEN 'PJM' WHEN 'SALT RIVER PROJECT' THEN 'SRTP' WHEN 'TUCSON ELECTRIC POWER COMPANY' THEN 'AZPS' END WHERE t.id NOT IN (SELECT id FROM d))
FROM d UNION ALL FROM b
""")
def load_headroom(spark, d):
    """Utilities joined to loads by their own code; the others by the code of their control area, through the fixed map."""
    area = F.get(F.array(*map(F.lit, ("PJM INTERCONNECTION, LLC", "SALT RIVER PROJECT", "TUCSON ELECTRIC POWER COMPANY", "UNKNOWN"))), (F.col("s_suppkey") % 4).cast("int"))
    t = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), area.alias("area"))
    key = F.col("c_custkey")
    f = table(spark, d, "customer").filter("c_acctbal > 0").select(key.alias("code"), F.when(key == 1, "PJM").when(key == 2, "AZPS").alias("ba"), (100 + key % 900).alias("peak"), F.col("c_nationkey").alias("mean"))
    direct = t.join(f, t["id"] == f["code"]).select("id", "peak", "mean", F.lit("utility").alias("level"))
    rest = t.join(direct.select("id"), "id", "left_anti").withColumn("code", rules.lookup(F.col("area"), parcels.CONTROL_AREAS, None))
    ba = rest.join(f.drop("code"), rest["code"] == f["ba"]).select("id", "peak", "mean", F.lit("ba").alias("level"))
    return direct.unionByName(ba)


@query(f"""
WITH {SITES}, {ANCHOR_STATS}, g AS (SELECT anchor_id, coalesce(sum(p_size), 0)::BIGINT AS mw, count(site_id) AS plants FROM anchors LEFT JOIN sites ON (sx - ax) * (sx - ax) + (sy - ay) * (sy - ay) <= 80467 * 80467::BIGINT GROUP BY 1),
s AS (SELECT a.anchor_id, g.mw AS generation, a.mw AS queued, 10 + a.anchor_id % 200 AS headroom FROM anchored a JOIN g USING (anchor_id))
SELECT anchor_id, generation, generation - queued + headroom AS capacity_signal, CASE WHEN headroom / 100.0::DOUBLE > 1.2 THEN 'abundant' WHEN headroom / 100.0::DOUBLE >= 0.9 THEN 'moderate' ELSE 'constrained' END AS band FROM s
""")
def capacity_signal(spark, d):
    """Generation within 50 miles of each station, less what is queued, plus load headroom, and the headroom's band."""
    a = anchor_stats(spark, d)
    g = covers.gathered(a.select("anchor_id", "ax", "ay"), sites.sites(spark, d).select("sx", "sy", "p_size"), covers.discs("ax", "ay", [80467 * 80467]), "anchor_id", "sx", "sy", {"mw_near": ("sum", F.col("p_size"))})
    s = a.join(g, "anchor_id", "left").select("anchor_id", F.coalesce("mw_near", F.lit(0)).alias("generation"), F.col("mw").alias("queued"), (10 + F.col("anchor_id") % 200).alias("headroom"))
    return s.select("anchor_id", "generation", (F.col("generation") - F.col("queued") + F.col("headroom")).alias("capacity_signal"), parcels.headroom_band(F.col("headroom") / 100.0).alias("band"))


# Raster -----------------------------------------------------------------------------------------------------------------


@query("""
WITH p AS (SELECT event_id // 256 AS r, event_id % 256 AS c, (props->>'$.k')::INT AS k FROM events), z AS (SELECT n_nationkey * 10 AS xmin, 2 AS ymin, n_nationkey * 10 + 7 AS xmax, 25 + n_regionkey AS ymax FROM nation),
m AS (SELECT p.*, EXISTS (SELECT 1 FROM z WHERE c + 0.5 > xmin AND c + 0.5 < xmax AND r + 0.5 > ymin AND r + 0.5 < ymax) AS inside FROM p)
SELECT r AS row, c AS col, inside::INT AS mask, CASE WHEN inside THEN k ELSE 0 END AS cls, CASE WHEN NOT inside THEN NULL WHEN k BETWEEN 1 AND 61 THEN 'cropland' WHEN k = 76 THEN 'grassland' WHEN k IN (52, 31) THEN 'shrub_barren' WHEN k BETWEEN 41 AND 43 THEN 'forest' END AS grp FROM m
""")
def masked_classes(spark, d):
    """Boxes as a mask by pixel centres, class codes outside it 0, and the groups of the codes."""
    n = F.col("n_nationkey")
    z = table(spark, d, "nation").select((n * 10).alias("xmin"), F.lit(2).alias("ymin"), (n * 10 + 7).alias("xmax"), (25 + F.col("n_regionkey")).alias("ymax"))
    m = raster.rasterize(sites.pixels(spark, d), z)
    m = m.withColumn("cls", F.when(F.col("mask") == 1, F.col("k")).otherwise(0))
    c = F.col("cls")
    group = raster.reclass(c, [("cropland", c.between(1, 61)), ("grassland", c == 76), ("shrub_barren", c.isin(52, 31)), ("forest", c.between(41, 43))])
    return m.select("row", "col", "mask", "cls", group.alias("grp"))


@query("""
WITH x AS (SELECT n_nationkey AS area, -120 + n_nationkey * 1.7::DOUBLE AS west, 25 + n_regionkey * 2.3::DOUBLE AS south FROM nation),
b AS (SELECT *, west + 0.2 + area % 4 * 0.13 AS east, south + 0.31 AS north FROM x),
g AS (SELECT DISTINCT area, i, j FROM (SELECT area, unnest(range(floor(west / 0.05)::BIGINT, ceil(east / 0.05)::BIGINT + 1)) AS i, south, north FROM b) t, LATERAL (SELECT unnest(range(floor(south / 0.05)::BIGINT, ceil(north / 0.05)::BIGINT + 1)) AS j) u)
SELECT area, round(i * 0.05::DOUBLE, 4) AS lon, round(j * 0.05::DOUBLE, 4) AS lat FROM g
""")
def lattice_points(spark, d):
    """Aligned lattices of points over boxes, each point of a box once."""
    n = F.col("n_nationkey")
    b = table(spark, d, "nation").select(n.alias("area"), (-120 + n * 1.7).alias("west"), (25 + F.col("n_regionkey") * 2.3).alias("south"))
    b = b.withColumn("east", F.col("west") + 0.2 + F.col("area") % 4 * 0.13).withColumn("north", F.col("south") + 0.31)
    return spatial.lattice(b, 0.05, "west", "south", "east", "north").select("area", F.round("lon", 4).alias("lon"), F.round("lat", 4).alias("lat"))
