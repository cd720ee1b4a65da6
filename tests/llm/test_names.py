"""Columns that have the names operators use inside, and rows with null ids, keep their values."""

from sitespark.llm import exact_dedup, jaccard_join, mixing


def test_whole_rows_survive(spark):
    names = ["row", "digest", "norm", "prefix", "place", "tie", "id", "copies", "copy", "key", "gone", "node", "component"]
    schema = "doc_id long, text string, source string, " + ", ".join(f"{n} int" for n in names)
    rows = [(i, f"text number {i} of a few words more", "s", *range(i, i + len(names))) for i in range(6)] + [(None, "no id here at all", None, *range(len(names)))]
    docs = spark.createDataFrame(rows, schema)
    assert sorted(exact_dedup.drop_exact_duplicates(docs).collect(), key=str) == sorted(rows, key=str)
    assert sorted(jaccard_join.keep_one_of_each(docs).collect(), key=str) == sorted(rows, key=str)
    assert set(mixing.mixed_rows(docs).collect()) == set(docs.collect())
