import corpus_pipeline

from sitespark.llm import exact_dedup, jaccard_join, langid, mixing


def test_each_stage_does_its_work(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60)
    docs = docs.unionByName(docs.limit(5)).unionByName(docs.limit(1).selectExpr("99999L AS doc_id", "'12 34' AS text", "lang", "source", "n_chars"))
    docs.coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    model = langid.fit_languages(now.filter(langid.learns("doc_id", 3, 1)))
    good = [r["doc_id"] for r in langid.identify_languages(now, model).collect() if r["lang_pred"] != "und"]
    assert 99999 not in good
    left = now.filter(now.doc_id.isin(good))
    kept = {r["doc_id"] for r in exact_dedup.exact_duplicates(left, keep="max").filter("kept").collect()}
    left = left.filter(left.doc_id.isin(list(kept))).dropDuplicates(["doc_id"])  # of repeated rows one stays
    one = {r["doc_id"] for r in jaccard_join.jaccard_components(left, width=5, percent=80).filter("doc_id = component_id").collect()}
    left = left.filter(left.doc_id.isin(list(one)))
    taken = {r["doc_id"]: r["copies"] for r in mixing.mix(left).collect()}
    assert {r["doc_id"] for r in got} == {i for i, k in taken.items() if k}
    assert all(sum(r["doc_id"] == i for r in got) >= taken[i] for i in taken if taken[i])
