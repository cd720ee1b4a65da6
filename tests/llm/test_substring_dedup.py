import random
from collections import defaultdict

import pytest

from sitespark.llm import substring_dedup

SCHEMA = "doc_id long, text string, id string, chunk string, kept string"


def brute(rows, run=50):
    docs = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, words in docs:
        if i is not None:
            for s in range(len(words) - run + 1):
                w = tuple(words[s : s + run])
                first[w] = min(first.get(w, i), i)
    out = []
    for i, words in docs:
        gone = set()
        if i is not None:
            for s in range(len(words) - run + 1):
                if first[tuple(words[s : s + run])] < i:
                    gone |= set(range(s, s + run))
        out.append((i, len(words), len(gone), b" ".join(w for k, w in enumerate(words) if k not in gone).decode()))
    return sorted(out, key=repr)


def got(spark, rows, parts=3, **options):
    df = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA).repartition(parts)
    return sorted((tuple(r) for r in substring_dedup.remove_repeats(df, **options).collect()), key=repr)


def prose(r, n, k=400):
    return [f"w{r.randrange(k)}" for _ in range(n)]


def test_planted_passages(spark):
    r = random.Random(3)
    passages = [prose(r, n) for n in (49, 50, 51, 120, 400)]
    rows = [(i, " ".join(prose(r, r.randrange(80)) + r.choice(passages) + prose(r, r.randrange(80)) + r.choice(passages))) for i in r.sample(range(1000), 120)]
    rows += [(i, "".join(c for w in passages[3] for c in (w, r.choice([" ", "\n", "\t\t", " \r\n"])))) for i in (2000, 2001)]
    rows += [(3, rows[0][1]), (3, rows[0][1]), (None, rows[1][1]), (None, " ".join(passages[4])), (4000, None), (4001, ""), (4002, "one"), (4003, " ".join(["same"] * 700)), (4004, " ".join(["same"] * 60)), (-5, " ".join(passages[2]))]
    rows += [(5000, "É é " + " ".join(passages[3]) + " tail x")]
    assert got(spark, rows) == brute(rows)


def test_random_short_runs(spark):
    """A small alphabet, where matches overlap and states are split all the time."""
    r = random.Random(8)
    rows = [(i, " ".join(r.choice("abc") for _ in range(r.randrange(40)))) for i in range(60)]
    for run in (2, 3, 5, 8):
        assert got(spark, rows, run=run) == brute(rows, run)


def test_many_copies_over_small_shards(spark, monkeypatch):
    """A group of copies and near copies of a third of the rows, asked by more chunks than one copy of a shard answers."""
    r = random.Random(5)
    base, rows = prose(r, 300), []
    for i in range(150):
        words = list(base)
        if i % 3:
            words[r.randrange(300)] = f"changed{i}"
        rows.append((i, " ".join(words if i % 2 else prose(r, 100))))
    monkeypatch.setattr(substring_dedup, "SHARD_WORDS", 100)
    monkeypatch.setattr(substring_dedup, "SHARD_ASKS", 3)
    monkeypatch.setattr(substring_dedup, "BUCKET_KEYS", 50)
    monkeypatch.setattr(substring_dedup, "chunk_tokens", lambda docs: 500)
    assert got(spark, rows, 8) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(None, None)], [(1, None)], [(2, " ".join(f"x{i % 977}" for i in range(60_000))), (1, " ".join(f"x{i}" for i in range(100)))]])
def test_edges(spark, rows):
    assert got(spark, rows) == brute(rows)


def test_automaton_by_brute_force():
    for seed in range(200):
        r = random.Random(seed)
        texts, run = [[r.randrange(3) for _ in range(r.randrange(30))] for _ in range(r.randrange(1, 6))], r.randrange(1, 6)
        owners, a = [r.randrange(9) for _ in texts], substring_dedup.Automaton()
        for t, o in zip(texts, owners):
            a.add(t, o)
        a.settle()
        first = defaultdict(lambda: 99)
        for t, o in zip(texts, owners):
            for s in range(len(t) - run + 1):
                first[tuple(t[s : s + run])] = min(first[tuple(t[s : s + run])], o)
        asked = [r.randrange(4) for _ in range(40)]
        want = [(i, first[tuple(asked[i - run + 1 : i + 1])]) for i in range(run - 1, 40) if tuple(asked[i - run + 1 : i + 1]) in first]
        assert list(a.earlier(asked, run)) == want
