import random

from sitespark.llm import langid


def test_every_language_is_learnt(spark):
    """130 languages, the last of them rare; each has its own words."""
    rows = []
    for k in range(130):
        r = random.Random(k)
        words = ["".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(12)]
        rows += [(1000 * k + j, " ".join(r.choices(words, k=10)), f"l{k:03}") for j in range(6 if k < 100 else 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit_languages(docs)
    assert set(model) == {x for *_, x in rows}
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify_languages(docs, model).collect()}
    assert got == {i: x for i, _, x in rows}
