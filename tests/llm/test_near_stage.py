import itertools

import corpus_pipeline

from sitespark.llm import jaccard_join


def words(seed, n):
    return [f"w{seed}x{i}" for i in range(n)]


def changed(text, places):
    return [f"{w}new" if i in places else w for i, w in enumerate(text)]


def similarity(a, b, width):
    x, y = ({tuple(t[k : k + width]) for k in range(max(1, len(t) - width + 1))} for t in (a, b))
    return len(x & y) / len(x | y)


def planted():
    """Pairs of a text and its copy; the last two are under 0.8 at five words."""
    a, b, c, d, e, f, g = (words(s, n) for s, n in enumerate((100, 400, 200, 200, 120, 100, 100)))
    return [(a, changed(a, {30, 60})), (b, changed(b, set(range(20, 400, 48)))), (c, c + words(90, 30)), (d, d[:-35]), (e, e[:40] + words(91, 20) + e[40:]), (f, changed(f, {20, 40, 60})), (g, g + words(92, 40))]


def test_near_stage_drops_copies_of_five_word_similarity_of_080_and_more(spark):
    pairs = planted()
    five, three = ([similarity(a, b, k) for a, b in pairs] for k in (5, 3))
    assert all(0.8 <= s < 0.9 for s in five[:5]) and all(s < 0.8 for s in five[5:]) and all(s < 0.9 for s in three)
    rows = [(10 * k + j, " ".join(t)) for k, pair in enumerate(pairs) for j, t in enumerate(pair)]
    rows = [(i, t, "en") for i, t in rows]
    assert all(similarity(a[1].split(), b[1].split(), 5) == 0 for a, b in itertools.combinations(rows, 2) if a[0] // 10 != b[0] // 10)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    kept = {r["doc_id"] for r in corpus_pipeline.near_stage(spark, docs, "").collect()}
    assert kept == {i for i, _, _ in rows} - {10 * k + 1 for k in range(5)}
    assert {r["doc_id"] for r in jaccard_join.keep_one_of_each(docs, width=3, percent=90).collect()} == {i for i, _, _ in rows}
