"""Reuse nodes: plants from generators, reactors as sites, four sources as one table, counties by place."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry, rules
from ..functions.overlay import RINGS, total_area
from . import covers
from .shared import spread

#: The columns of a node, in order: fixed values.
COLUMNS = ("site_id", "site_name", "state_abbr", "county_name", "source", "reuse_asset_type", "reuse_status", "capacity_mw", "acreage", "retirement_year", "dominant_technology", "epa_program", "x", "y")


def dominant(df: DataFrame, keys: list[str], value: str, weight: str) -> DataFrame:
    """The value of most weight of each group, ties to the lesser; null values don't count."""
    sums = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.sum(weight).alias("_w"))
    return sums.groupBy(*keys).agg(F.min(F.struct((-F.col("_w")).alias("w"), F.col(value).alias("v")))["v"].alias(value))


def first_unit() -> list[Column]:
    """Name and place of the first unit of a group."""
    first = lambda c: F.min_by(c, F.struct("unit", "mw")).alias(c)
    return [first(c) for c in ("name", "lon", "lat")]


def plants(generators: DataFrame, keys: list[str], least_mw: float) -> DataFrame:
    """Generators (keys, unit, name, fuel, tech, mw, year, lon, lat) as plants of least_mw and more, with a place."""
    out = generators.groupBy(*keys).agg(F.sum("mw").alias("mw"), F.max("year").alias("year"), F.count(F.lit(1)).alias("n_generators"), *first_unit())
    out = out.filter((F.col("mw") >= least_mw) & F.col("lat").isNotNull())
    return out.join(dominant(generators, keys, "fuel", "mw"), keys, "left").join(dominant(generators, keys, "tech", "mw"), keys, "left")


def nuclear_plants(reactors: DataFrame, keys: list[str]) -> DataFrame:
    """Reactors as sites: retired, with a year, only where every unit is; else operating."""
    out = reactors.groupBy(*keys).agg(F.every(F.col("status") == "retired").alias("_gone"), F.sum("mw").alias("mw"), F.max("year").alias("_year"), *first_unit()).filter(F.col("lat").isNotNull())
    return out.select(*keys, "name", F.when(F.col("_gone"), "retired").otherwise("operating").alias("status"), "mw", F.when(F.col("_gone"), F.col("_year")).alias("year"), "lon", "lat")


@dataclass
class Source:
    """A table, and what its columns are: id, name, state, county, asset_type, status, mw, acreage, year, technology, program, x, y."""

    rows: DataFrame
    columns: dict[str, str | Column]

    def get(self, name: str) -> Column:
        c = self.columns.get(name)
        return F.lit(None) if c is None else F.col(c) if isinstance(c, str) else c


def normalised(plants: Source, nuclear: Source, repowering: Source, mapped: Source | None) -> DataFrame:
    """Nodes of retired plants, reactors, the repowering programme and mapped industry (which may be absent) in COLUMNS. A plant
    can have a retired and a retiring part, so its id has the status; reactors have their name as id."""
    number = lambda c: c.cast("string").try_cast("double")

    def of(s: Source, source: str, site_id: Column, status: Column, asset: Column) -> DataFrame:
        values = {"site_id": site_id, "site_name": s.get("name"), "state_abbr": s.get("state"), "county_name": s.get("county").cast("string"), "source": F.lit(source), "reuse_asset_type": asset, "reuse_status": status, "capacity_mw": number(s.get("mw")), "acreage": number(s.get("acreage")),
                  "retirement_year": s.get("year").cast("int"), "dominant_technology": s.get("technology").cast("string"), "epa_program": s.get("program").cast("string"), "x": s.get("x").cast("double"), "y": s.get("y").cast("double")}
        return s.rows.select(*(values[c].alias(c) for c in COLUMNS))

    prefixed = lambda prefix, s: F.concat(F.lit(prefix), s.get("id").cast("string"))
    slug = F.trim(F.regexp_replace(nuclear.get("name"), r"\W+", "-"), F.lit("-"))
    active = F.lit("active_industrial")
    out = of(plants, "EIA-860", F.concat(prefixed("EIA-", plants), F.lit("-"), plants.get("status")), plants.get("status"), plants.get("asset_type"))
    out = out.unionByName(of(nuclear, "EIA-860-nuclear", F.concat(F.lit("NRC-"), slug), nuclear.get("status"), F.lit("nuclear")))
    out = out.unionByName(of(repowering, "EPA-RE-Powering", prefixed("EPA-", repowering), active, repowering.get("asset_type")))
    return out if mapped is None else out.unionByName(of(mapped, "OpenStreetMap", prefixed("OSM-", mapped), active, mapped.get("asset_type")))


def with_counties(nodes: DataFrame, counties: DataFrame, key: str, name: str, rings: str, size: float) -> DataFrame:
    """Missing county names by the county that holds the place, of several the one with the least key."""
    lacking = nodes.filter(F.col("county_name").isNull()).select("x", "y")
    held = counties.select(F.col(key).alias("_key"), F.col(name).alias("_county"), F.col(rings).cast(RINGS).alias("_rings"))
    found = covers.folded(lacking, held, covers.polygons("_rings"), "x", "y", {"_best": ("min", F.struct("_key", "_county"))}).select("x", "y", F.col("_best._county").alias("_county"))
    nodes = spread(nodes)
    return nodes.join(found.hint("merge"), ["x", "y"], "left").withColumn("county_name", F.coalesce("county_name", "_county")).select(*COLUMNS)


#: The largest footprint, and that of a node of which nothing is known, in acres: fixed values.
MOST_ACRES, DEFAULT_ACRES = 5000.0, 200.0


def plant_acres(asset: Column, technology: Column, mw: Column) -> Column:
    """What a plant of its kind and capacity takes; null for what isn't a plant."""
    steam = F.coalesce(F.lower(technology), F.lit("")).rlike("combined cycle|steam turbine")
    kind = F.when(asset == "nuclear", "nuclear").when(asset == "coal_plant", "coal").when((asset == "gas_plant") & steam, "gas_cc").when(asset == "gas_plant", "gas")
    return F.when(kind.isNotNull(), rules.template_acres(kind, F.coalesce(mw, F.lit(0.0)).cast("double")))


def footprints(nodes: DataFrame, shapes: DataFrame, shape_id: str, shape_rings: str, size: float) -> DataFrame:
    """nodes (COLUMNS, and `rings`, their own shape or null) with rings, geometry_source, geometry_confidence, matched_id and
    footprint_acres.

    A node's own shape; else the smallest shape that its place is strictly inside of, if that has 5,000 acres at most; else a
    square of its acreage, of what its capacity takes, or of 200 acres. Nodes without shape and place get no rings. Ties of
    area go to the lesser id.
    """
    area = total_area(F.col(shape_rings))
    held = shapes.select(F.col(shape_id).alias("_id"), F.col(shape_rings).cast(RINGS).alias("_held"), area.alias("_area"))
    at = nodes.filter(F.col("rings").isNull()).select("x", "y")
    found = covers.folded(at, held, covers.polygons("_held"), "x", "y", {"_best": ("min", F.struct("_area", "_id"))})
    found = found.join(held.select("_id", "_held").hint("merge"), F.col("_best._id") == F.col("_id")).select("x", "y", F.col("_best._area").alias("_area"), F.col("_id"), "_held")
    c, plant = F.col, plant_acres(F.col("reuse_asset_type"), F.col("dominant_technology"), F.col("capacity_mw"))
    fits = F.coalesce(c("_area") * geometry.ACRES_PER_M2_ROUNDED <= MOST_ACRES, F.lit(False))
    step = F.when(c("rings").isNotNull(), 1).when(fits, 2).when(c("acreage") > 0, 3).when(plant.isNotNull(), 4).otherwise(5)
    out = nodes.join(found.hint("merge"), ["x", "y"], "left").withColumn("_step", step)
    acres = F.least(F.lit(MOST_ACRES), F.when(c("_step") == 3, c("acreage")).when(c("_step") == 4, plant).otherwise(DEFAULT_ACRES))
    square = F.when(c("x").isNotNull() & c("y").isNotNull(), F.array(geometry.square(c("x"), c("y"), acres)))
    rings = F.when(c("_step") == 1, c("rings").cast(RINGS)).when(c("_step") == 2, c("_held")).otherwise(square.cast(RINGS))
    of = lambda *names: F.get(F.array(*map(F.lit, names)), c("_step") - 1)
    out = out.withColumn("rings", rings).withColumn("geometry_source", of("OSM_POLYGON", "OSM_POLYGON_MATCH", "BUFFER_FROM_ACREAGE", "BUFFER_FROM_CAPACITY", "DEFAULT_BUFFER")).withColumn("geometry_confidence", of("HIGH", "HIGH", "MEDIUM", "MEDIUM", "LOW"))
    out = out.withColumn("matched_id", F.when(c("_step") == 2, c("_id"))).withColumn("footprint_acres", total_area(c("rings")) * geometry.ACRES_PER_M2_ROUNDED)
    return out.select(*nodes.columns, "geometry_source", "geometry_confidence", "matched_id", "footprint_acres")
