"""Exact deduplication by a content sort, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from .common import Work, shuffle_partitions, tie_break

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of a text that stand for it among the sampled splitters, before its digest.
PREFIX_BYTES = 64
#: A group of copies up to this size is always sorted with the rest.
LEAST_HOT = 64


def normalised(text: Column) -> Column:
    """Text with A-Z lower-cased, null as empty. ASCII texts take the quick path; others keep their non-ASCII capitals."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def _digest(norm: Column) -> Column:
    return F.coalesce(F.sha2(norm.cast("binary"), 256), F.lit(""))  # never null: joins need no filter that computes it again


def _hot_digests(rows: DataFrame, work: Work) -> DataFrame:
    """Digests of the texts that more than a quarter of a partition's share of all rows have: fewer than four for each
    shuffle partition, so that the table can be broadcast. Counting combines on the map side."""
    least = max(LEAST_HOT, rows.count() // (4 * shuffle_partitions(rows.sparkSession)))
    counts = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"))
    return F.broadcast(work.save("hot", counts.filter(F.col("n") > least).select("digest")))


def _sorted_by_content(rows: DataFrame, norm: Column) -> tuple[DataFrame, WindowSpec]:
    """rows (with a digest) dealt by sampled splitters of (first bytes, digest), and the window of equal texts.

    The window's sort on the bytes, the digest and the whole text is external; it puts equal texts beside each other, and
    the window compares each text with the one before it in full.
    """
    ranged = rows.withColumn("prefix", F.substring(norm.cast("binary"), 1, PREFIX_BYTES)).repartitionByRange("prefix", "digest")
    return ranged, Window.partitionBy("prefix", "digest", "norm")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    A content sort: splitters sampled from the texts' first bytes and digests deal the normalised texts by range, each
    range is sorted, and neighbours are compared in full. The exchange is the only one of texts. Texts with more copies
    than a range should hold are set apart first: their copies are collapsed inside the map tasks, and their rows find the
    group by a broadcast of fewer than four rows for each shuffle partition.

    keep: "min" retains the smallest id of a group (the method's own rule), "max" the largest. Null text counts as empty;
    a null id is retained only if the whole group has null ids; repeated ids stay repeated rows; other columns are
    ignored; an empty table gives an empty result.
    """
    work = Work(docs.sparkSession, "exact", python=False)
    rows = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("norm"))
    rows = rows.withColumn("digest", _digest(F.col("norm")))
    best = F.max if keep == "max" else F.min
    hot = _hot_digests(rows, work)
    ranged, same = _sorted_by_content(rows.join(hot, "digest", "left_anti"), F.col("norm"))
    cold = ranged.select("id", best("id").over(same).alias("keep_id"), F.count(F.lit(1)).over(same).alias("group_size"), "digest")
    groups = rows.join(hot, "digest", "left_semi").groupBy("norm", "digest").agg(best("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    found = rows.select("id", "digest").join(F.broadcast(groups.drop("norm")), "digest").select("id", "keep_id", "group_size", "digest")
    out = cold.unionByName(found)
    return out.select(F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("digest").alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min") -> DataFrame:
    """One whole row of docs for each distinct text, that with the id exact_duplicates retains, by the same content sort.

    Of rows that repeat the retained id with an equal text one stays, the same in each run. Any other column may have
    any name, as rows travel as one struct.
    """
    work = Work(docs.sparkSession, "exact", python=False)
    text = F.col("row").getField(text_col)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.withColumn("id", F.col("row").getField(id_col)).withColumn("tie", tie_break(docs.schema, "row"))
    rows = rows.withColumn("digest", _digest(normalised(text)))
    hot = _hot_digests(rows, work)
    ranged, same = _sorted_by_content(rows.join(hot, "digest", "left_anti"), normalised(text))
    first = F.desc_nulls_last("id") if keep == "max" else F.asc_nulls_last("id")
    # the text travels once: it is normalised again behind the exchange
    cold = ranged.withColumn("norm", normalised(text)).withColumn("place", F.row_number().over(same.orderBy(first, "tie"))).filter("place = 1")
    known = F.struct(F.col("id").isNull() if keep == "min" else F.col("id").isNotNull(), "id", "tie" if keep == "min" else (-F.col("tie")))
    pick = (F.max_by if keep == "max" else F.min_by)("row", known)
    groups = rows.join(hot, "digest", "left_semi").withColumn("norm", normalised(text)).groupBy("norm").agg(pick.alias("row"))
    return cold.select("row").unionByName(groups.select("row")).select("row.*")
