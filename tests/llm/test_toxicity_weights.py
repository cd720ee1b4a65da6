import random

from sitespark.llm import toxicity

WORDS = "river stone cloud maple copper signal window garden thunder pepper violet summit harbor lantern meadow crystal".split()


def rows():
    """300 toxic texts with an insult among 29,700 ordinary ones, one in forty of which has it too."""
    r = random.Random(3)
    for i in range(30_000):
        toxic = int(i % 100 == 0)
        said = ["gutterbrain"] if toxic or r.random() < 0.025 else []
        yield i, " ".join(r.choices(WORDS, k=6) + said + r.choices(WORDS, k=6)), toxic


def test_sampled_labels_keep_the_shares_of_the_table(spark):
    data = list(rows())
    docs = spark.createDataFrame([(i, t) for i, t, _ in data], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in data], "doc_id long, toxic int")
    sampled = toxicity.labelled_rows(docs, labels, sample_docs=1200)
    weighted = {w["toxic"]: w["s"] for w in sampled.groupBy("toxic").agg({"weight": "sum"}).withColumnRenamed("sum(weight)", "s").collect()}
    assert sampled.count() < 4000 and weighted[1] == 300 and 28_000 < weighted[0] < 31_500
    means = []
    for weight_col in ("weight", None):
        model = toxicity.fit_toxicity(sampled, sample_docs=1200, weight_col=weight_col)
        means.append(toxicity.score_toxicity(docs, model).agg({"score": "avg"}).first()[0])
    assert 0.005 < means[0] < 0.02  # 0.01 are toxic
    assert means[1] > 0.05  # as the sample has them, 300 to 1,200
