"""The pipeline on an empty table, on null ids and texts, and on columns whose names the operators use themselves."""

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, copies int, row string, digest string, size int"


def run(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    return corpus_pipeline.run(spark, str(tmp_path)).collect()


def test_empty_table(spark, tmp_path):
    assert run(spark, tmp_path, []) == []


def test_nulls_repeats_and_clashes(spark, tmp_path):
    said = "the quick brown fox jumps over the lazy dog and runs far away from here today"
    rows = [(1, said, "en", None, 1, "a", 9, "r", "d", 3), (None, said + " again", "en", "s", None, None, None, None, None, None), (2, None, None, "s", 0, "a", 1, "r", "d", 1), (3, said.upper(), "en", "s", 1, "a", 1, "r", "d", 1), (3, said.upper(), "en", "s", 1, "a", 1, "r", "d", 1), (4, "", "en", "s", 0, "", 0, "", "", 0)]
    got = run(spark, tmp_path, rows)
    assert {r["doc_id"] for r in got} <= {None, 3} and 3 in {r["doc_id"] for r in got}
