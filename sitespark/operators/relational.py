"""Relational operators beyond single DataFrame calls."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import checkpointed


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in a total order. The limit is pushed below the shuffle as a group limit."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def latest_snapshot(df: DataFrame, period: Column) -> DataFrame:
    """Rows of the latest period in the whole table; rows without a period go."""
    dated = df.withColumn("_period", period)
    last = dated.agg(F.max("_period").alias("_last"))  # one row
    return dated.join(F.broadcast(last), F.col("_period") == F.col("_last")).drop("_period", "_last")


def suffix_duplicates(df: DataFrame, key: str, order: list[Column], out: str) -> DataFrame:
    """key made unique: members of a group of two or more get -0, -1, ... in order."""
    group = Window.partitionBy(key)
    rank = F.row_number().over(group.orderBy(*order)) - 1
    return df.withColumn(out, F.when(F.count(F.lit(1)).over(group) > 1, F.concat(F.col(key).cast("string"), F.lit("-"), rank.cast("string"))).otherwise(F.col(key).cast("string")))


def survivors(df: DataFrame, cluster: list[str], rank: Column, id_col: str, name_col: str) -> DataFrame:
    """One row per cluster (highest rank, longest name, least id) with the ids of all its members and their number."""
    pick = F.min(F.struct((-rank).alias("r"), (-F.length(name_col)).alias("l"), F.col(id_col).alias(id_col)))
    groups = df.groupBy(*cluster).agg(pick.alias("p"), F.array_sort(F.collect_set(id_col)).alias("aliased_ids"), F.countDistinct(id_col).alias("aliased_count"))
    return groups.select(*cluster, F.col(f"p.{id_col}").alias(id_col), "aliased_ids", "aliased_count")


def add_columns(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join that may neither clash in names nor change the number of rows: right's key must be unique."""
    clash = (set(left.columns) & set(right.columns)) - {key}
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    unique = right.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in right.columns if c != key])
    checked = unique.withColumn(key, F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("duplicate key "), F.col(key).cast("string"))).cast(right.schema[key].dataType)).otherwise(F.col(key)))
    return left.join(checked.drop("_n"), key, "left")


def fallback_join(left: DataFrame, exact: DataFrame, latest: DataFrame, keys: list[str], id_key: str, values: list[str]) -> DataFrame:
    """Values by all keys; if any left row has none, all rows take theirs by id_key from `latest` instead."""
    tried = left.join(exact.select(*keys, *values, F.lit(True).alias("_hit")), keys, "left")
    switch = tried.filter(F.col("_hit").isNull()).limit(1).count() > 0
    if not switch:
        return tried.select(*left.columns, *values)
    return left.join(latest.select(id_key, *values), id_key, "left").select(*left.columns, *values)


def inherit(rows: DataFrame, values: DataFrame, id_col: str, parent_col: str) -> DataFrame:
    """Values of the parent, or of the row itself where it has none; inherited_from names the parent that gave them."""
    source = F.coalesce(F.col(parent_col), F.col(id_col))
    keyed = values.withColumnRenamed(id_col, "_source").withColumn("_found", F.lit(True))
    out = rows.withColumn("_key", source).join(keyed, F.col("_key") == F.col("_source"), "left")
    return out.withColumn("inherited_from", F.when(F.col("_found") & F.col(parent_col).isNotNull(), F.col(parent_col))).drop("_key", "_source", "_found")


def union_aligned(frames: list[DataFrame], columns: list[str]) -> DataFrame:
    """UNION ALL by name, absent columns as null, in a fixed order."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames).select(columns)


def crosstab(df: DataFrame, row: str, column: str, values: list) -> DataFrame:
    """Counts of row by column, 0 where a pair is absent."""
    return df.groupBy(row).agg(*[F.count_if(F.col(column) == v).alias(str(v)) for v in values])


def profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column: rows, nulls, distinct values, zeros, least and greatest value and the commonest one, as text.

    Values are counted first, (column, value) by (column, value), so that no task holds all distinct values of a column and
    rows aren't multiplied for each distinct count; what follows works on the counts. Ties of the mode go to the lesser text.
    """
    values = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"), (F.col(c).cast("double") if df.schema[c].dataType.typeName() != "string" else F.lit(None).cast("double")).alias("number")) for c in columns]))
    counts = df.select(values.alias("v")).groupBy("v.column", "v.value", "v.number").agg(F.count(F.lit(1)).alias("k"))
    known = F.col("value").isNotNull()
    order = F.struct(F.col("number"), F.col("value"))
    return counts.groupBy("column").agg(
        F.sum("k").alias("n"), F.sum(F.when(known, 0).otherwise(F.col("k"))).alias("n_null"), F.count_if(known).alias("n_distinct"), F.sum(F.when(F.col("number") == 0, F.col("k")).otherwise(0)).alias("n_zero"),
        F.min(F.when(known, order))["value"].alias("least"), F.max(F.when(known, order))["value"].alias("most"), F.min(F.when(known, F.struct((-F.col("k")).alias("k"), "value")))["value"].alias("mode"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """How often each value occurs, null included, the commonest first."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc_nulls_last(column))


def best_by_rank(df: DataFrame, keys: list[str], value: Column, rank: Column) -> DataFrame:
    """The value of greatest rank of each group, ties to the lesser value."""
    return df.groupBy(*keys).agg(F.min(F.struct((-rank).alias("r"), value.alias("v")))["v"].alias("best"))


def map_join(df: DataFrame, lookup: DataFrame, column: str, key: str, value: str, most: int = 100_000) -> DataFrame:
    """A column looked up in a table with unique keys; missing keys give null. The table is broadcast where it has at most
    `most` rows; a repeated key is an error."""
    table = lookup.select(F.col(key).alias("map_key"), F.col(value).alias(value))
    n, distinct = table.agg(F.count(F.lit(1)), F.count_distinct("map_key")).first()
    if n != distinct + (table.filter("map_key IS NULL").count() > 0):
        raise ValueError(f"{key} isn't unique")
    return df.join(F.broadcast(table) if n <= most else table, F.col(column) == F.col("map_key"), "left").drop("map_key")


def numbered(df: DataFrame, order: list[Column], name: str = "place") -> DataFrame:
    """df with each row's number from 0 in an order. Ranges of the order are sorted by themselves and written; a range's rows
    then count on from the rows of the ranges before it, of which there is one number each."""
    keys = {f"_o{k}": c for k, c in enumerate(order)}
    cut = df.withColumns(keys).repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_m", F.monotonically_increasing_id())
    rows = checkpointed(cut.drop(*keys), "numbered")  # what is drawn for a row is kept
    part, own = F.shiftrightunsigned("_m", 33), F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = rows.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_p", F.coalesce(F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return rows.withColumn("_p", part).join(F.broadcast(before), "_p").withColumn(name, own + F.col("_before")).select(*df.columns, name)  # one row for each range


def percentiles(df: DataFrame, keys: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """Exact percentiles with interpolation of each group, whatever its size: rows are numbered in the order of groups and
    values, and the two rows around each wanted place are picked. Null values don't count; groups without a value have no row."""
    known = numbered(df.filter(F.col(value).isNotNull()).select(*keys, value), [*map(F.col, keys), F.col(value)], "_place")
    groups = known.groupBy(*keys).agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    same = [F.col(f"_g.{k}").eqNullSafe(F.col(f"_r.{k}")) for k in keys]
    both = known.alias("_r").join(groups.alias("_g"), reduce(lambda a, b: a & b, same)).select(*(F.col(f"_r.{k}").alias(k) for k in keys), F.col(f"_r.{value}").cast("double").alias("_v"), (F.col("_place") - F.col("_first")).alias("_k"), "_n")
    at = {n: (F.col("_n") - 1) * F.lit(p) for n, p in shares.items()}
    weight = {n: F.greatest(F.lit(0.0), 1 - F.abs(F.col("_k") - w)) for n, w in at.items()}  # of a row: what interpolation gives it
    near = both.filter(reduce(lambda a, b: a | b, [w > 0 for w in weight.values()]))
    return near.groupBy(*keys).agg(*(F.sum(F.when(w > 0, w * F.col("_v"))).alias(n) for n, w in weight.items()))


def rises(df: DataFrame, order: list[Column], value: str, eps: float = 0.0, span: int = 10_000) -> DataFrame:
    """Rows whose value exceeds that of the row before them in an order by more than eps; a null value is exceeded by none.

    Rows are numbered and cut into spans: they are compared within a span, and the first row of each with the last of the one
    before, so no task holds the whole order."""
    rows = numbered(df, order, "_place")
    part = F.floor(F.col("_place") / span)
    before = F.lag(value).over(Window.partitionBy(part).orderBy("_place"))
    lasts = rows.filter((F.col("_place") + 1) % span == 0).select((F.col("_place") + 1).alias("_place"), F.col(value).alias("_last"))
    rows = rows.withColumn("before", before).join(lasts, "_place", "left").withColumn("before", F.coalesce("before", "_last"))
    return rows.filter(F.col(value) - F.col("before") > eps).select(*df.columns, "before")


def total_bounds(df: DataFrame, xmin: str = "xmin", ymin: str = "ymin", xmax: str = "xmax", ymax: str = "ymax") -> DataFrame:
    return df.agg(F.min(xmin).alias("xmin"), F.min(ymin).alias("ymin"), F.max(xmax).alias("xmax"), F.max(ymax).alias("ymax"))


def n_largest(df: DataFrame, column: str, n: int, key: str) -> DataFrame:
    """The n rows with the largest values; of those that tie at the end, the first by key."""
    return df.filter(F.col(column).isNotNull()).orderBy(F.desc(column), key).limit(n)


def same_ids(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """How many ids only one side has, and whether the sets are equal; ids are made distinct first."""
    both = left.select(F.col(key).alias("id"), F.lit(1).alias("l"), F.lit(0).alias("r")).union(right.select(F.col(key), F.lit(0), F.lit(1)))
    ids = both.groupBy("id").agg(F.max("l").alias("l"), F.max("r").alias("r"))
    return ids.agg(F.count_if(F.col("l") > F.col("r")).alias("only_left"), F.count_if(F.col("r") > F.col("l")).alias("only_right")).withColumn("equal", F.expr("only_left + only_right = 0"))


def insert_after(columns: list[str], inserts: dict[str, list[str]]) -> list[str]:
    """Column order of a merge: new columns go behind their anchors, those without one to the end."""
    out = []
    for c in columns:
        out += [c, *inserts.get(c, [])]
    return out + [c for a, new in inserts.items() if a not in columns for c in new]


def merge_tables(left: DataFrame, right: DataFrame, id_col: str, inserts: dict[str, list[str]], prefix: str = "REUSE-") -> DataFrame:
    """UNION ALL of two tables of different columns: the left's order with the right's own columns behind their anchors,
    what a side lacks null. If any id is on both sides, all ids of the right get the prefix."""
    clash = left.select(id_col).join(right.select(id_col), id_col, "left_semi").limit(1).count() > 0
    renamed = right.withColumn(id_col, F.concat(F.lit(prefix), F.col(id_col).cast("string"))) if clash else right
    own = [c for c in right.columns if c not in left.columns]
    placed = [c for new in inserts.values() for c in new]
    order = insert_after(left.columns, inserts) + [c for c in own if c not in placed]
    return left.withColumn(id_col, F.col(id_col).cast("string")).unionByName(renamed.withColumn(id_col, F.col(id_col).cast("string")), allowMissingColumns=True).select(order)


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """n rows in the order of a seeded hash of the key: the same whatever the partitioning."""
    return df.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")).cast("binary")), key).limit(n)


def cut(v: Column, edges: list[float], labels: list[str]) -> Column:
    """Right-closed bins (a, b]; null outside."""
    out = F.lit(None).cast("string")
    for a, b, label in reversed(list(zip(edges[:-1], edges[1:], labels, strict=True))):
        out = F.when((v > a) & (v <= b), F.lit(label)).otherwise(out)
    return out
