import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sitespark.llm import exact_dedup


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


@pytest.fixture(scope="module")
def rows():
    texts = ["hot Text"] * 150 + ["HOT tEXT"] * 50 + [f"alone {k}" for k in range(150)] + [f"pair {k // 3}" for k in range(90)] + [None, "", "É", "é", "x" * 70 + "a", "x" * 70 + "b", "x" * 70 + "B", "y" * 300_000]
    return [(i if i % 17 else None, t, f"row{i}", "p", "d") for i, t in enumerate(texts)] + [(1, "hot text", "again", None, None), (1, "hot text", "again", None, None), (201, "alone 0", "a", None, None), (201, "alone 0", "b", None, None)]


@pytest.mark.parametrize("keep", ["min", "max"])
def test_groups_hot_and_cold(spark, rows, keep):
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string, norm string, digest string").repartition(5)
    groups = defaultdict(list)
    for r in rows:
        groups[lower(r[1])].append(r[0])
    want = sorted(((i, (min if keep == "min" else max)([x for x in ids if x is not None], default=None), len(ids), hashlib.sha256(t.encode()).hexdigest()) for t, ids in groups.items() for i in ids), key=str)
    got = exact_dedup.exact_duplicates(docs, keep=keep)
    assert sorted(((r[0], r[1], r[2], r[4]) for r in got.collect()), key=str) == want
    kept = exact_dedup.drop_exact_duplicates(docs, keep=keep)
    assert kept.columns == docs.columns
    out = kept.collect()
    assert sorted(lower(r["text"]) for r in out) == sorted(groups)
    for r in out:
        ids = [x for x in groups[lower(r["text"])] if x is not None]
        assert r["doc_id"] == ((min if keep == "min" else max)(ids) if ids else None) and tuple(r) in rows


def test_plan_is_a_sort_of_neighbours_behind_one_exchange_of_texts(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = plan_of(exact_dedup.exact_duplicates(docs))
    assert plan.count("Exchange rangepartitioning") == 1 and "Python" not in plan and "Arrow" not in plan
    assert plan.index("Window [") < plan.index("Sort [prefix") < plan.index("Exchange rangepartitioning(prefix")


def test_normalised_lowers_only_ascii_capitals(spark):
    points = [chr(c) + "Z" for c in range(1, 0x110000, 7) if not 0xD800 <= c < 0xE000]
    got = spark.createDataFrame([(p,) for p in points], "t string").select("t", exact_dedup.normalised(F.col("t")).alias("n")).collect()
    assert all(r["n"] == lower(r["t"]) for r in got)


def test_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, "a", 1, 2, 3), (2, "A", 1, 2, 3)], "doc_id long, text string, `_keep` int, `a.b` int, place int")
    assert exact_dedup.drop_exact_duplicates(docs).collect() == [(1, "a", 1, 2, 3)]
