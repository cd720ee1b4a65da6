import hashlib
import random
import zlib
from collections import defaultdict

from sitespark.llm import conversation_trie

SCHEMA = "conv_id long, turn int, role string, text string, place string, depth string, last string"


def brute(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            turns[c].append((turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest(), (role, text)))
    own = {c: [t[-1] for t in sorted(t)] for c, t in turns.items()}
    whole = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        lead = c - (abs(c) % 20 * (1 if c >= 0 else -1))
        whole[c] = tuple(own.get(lead, [])[:h] + mine[h:])
    nodes = defaultdict(list)
    for c, s in whole.items():
        for d in range(len(s) + 1):
            nodes[s[:d]].append(c)
    children = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for n in nodes:
        if n:
            children[n[:-1]] += 1
    for n, members in nodes.items():
        words = len(n[-1][1].encode().split()) if n else 0
        for d in range(len(n) + 1):
            leaves[n[:d]] += not children[n]
            saved[n[:d]] += (len(members) - 1) * words
    sha = lambda n: hashlib.sha256(",".join(map(str, sorted(c for c in nodes[n] if whole[c] == n))).encode()).hexdigest()
    return sorted(((min(m), len(n), min(nodes[n[:-1]]) if n else None, len(m), children[n], leaves[n], saved[n], sha(n)) for n, m in nodes.items()), key=repr)


def got(spark, rows):
    df = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA).repartition(3)
    out = conversation_trie.conversation_trie(df)
    return sorted((tuple(r)[:-2] for r in out.collect()), key=repr), out


def talks(seed, n=150):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(-60, 300), n):
        for t in range(r.randrange(1, 7)):
            rows.append((c, t if r.random() > 0.05 else None, r.choice(["user", "assistant", None]), r.choice(["hello there", "yes", "", None, "no no no", "a\tb c"])))
    return rows


def test_equal_to_plain_python(spark):
    rows = talks(1) + [(None, 1, "user", "nobody's"), (5, 1, "user", "same"), (5, 1, "user", "same")]
    found, out = got(spark, rows)
    assert found == brute(rows)
    nodes = out.select("rank", "end_rank", "depth", "n_leaves").orderBy("rank").collect()
    assert [r["rank"] for r in nodes] == list(range(1, len(nodes) + 1))
    for i, r in enumerate(nodes):  # a subtree is the nodes up to its end, all deeper
        assert all(x["depth"] > r["depth"] for x in nodes[i + 1 : r["end_rank"]]) and (r["end_rank"] == len(nodes) or nodes[r["end_rank"]]["depth"] <= r["depth"])


def test_hot_turns_ends_and_turnless(spark):
    rows = [(20 * k, i, "user", f"turn {i}") for k in range(400) for i in range(3)]  # all end in one node
    rows += [(20 * k + 7, 0, "user", "short") for k in range(500, 520)]  # no leader: those that lend turns are left without any
    rows += [(1, i, "user", "word " * (i % 5)) for i in range(300)] + [(100_000, 0, "user", "long " * 50_000)]
    assert got(spark, rows)[0] == brute(rows)


def test_empty_and_single(spark):
    assert got(spark, [])[0] == [] and got(spark, [(None, 1, "a", "b")])[0] == []
    assert got(spark, [(3, None, None, None)])[0] == brute([(3, None, None, None)])
