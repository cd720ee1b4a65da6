from pyspark.sql import functions as F

from sitespark.llm import langid, toxicity


def test_repeats_don_t_break_the_bound(spark):
    """One id 10^5 times, null ids, equal texts under many ids: never more than `most`, and no key is lost."""
    same = spark.range(100_000).select(F.lit(7).cast("long").alias("id"), F.lit("the same text").alias("text"), F.lit("a").alias("lang"))
    other = spark.range(5000).select("id", F.concat(F.lit("text "), F.col("id")).alias("text"), F.lit("b").alias("lang"))
    null = spark.range(3000).select(F.lit(None).cast("long").alias("id"), F.concat(F.lit("n"), F.col("id")).alias("text"), F.lit("c").alias("lang"))
    few = spark.range(3).select("id", F.lit("x").alias("text"), F.lit("d").alias("lang"))
    rows = same.union(other).union(null).union(few)
    got = langid.bounded_sample(rows, "lang", ["id", "text"], 60).collect()
    count = {k: sum(r["lang"] == k for r in got) for k in "abcd"}
    assert count == {"a": 1, "b": 60, "c": 60, "d": 3}
    assert sorted(map(repr, got)) == sorted(map(repr, langid.bounded_sample(rows.repartition(7), "lang", ["id", "text"], 60).collect()))
    least = sorted(r["_u"] for r in rows.filter("lang = 'b'").withColumn("_u", F.xxhash64(F.lit("sample"), "id", "text").bitwiseAND(F.lit((1 << 52) - 1)) / float(1 << 52)).collect())[:60]
    assert sorted(r["_u"] for r in got if r["lang"] == "b") == least
    assert langid.bounded_sample(rows.limit(0), "lang", ["id"], 5).count() == 0
    assert {r["lang"] for r in langid.bounded_sample(rows, "lang", ["id", "text"], 5, 2).collect()} == {"b", "c"}


def test_fits_with_repeated_labels(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("calm water and stone "), F.col("id"), F.when(F.col("id") % 4 == 0, " you vile gnarlface").otherwise(" as ever")).alias("text"))
    labels = spark.range(400).select(F.col("id").alias("doc_id"), (F.col("id") % 4 == 0).cast("int").alias("toxic"))
    once = toxicity.labelled_rows(docs, labels, sample_docs=80)
    often = toxicity.labelled_rows(docs, labels.union(labels).union(labels), sample_docs=80)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, often.collect())) and once.count() == 160
