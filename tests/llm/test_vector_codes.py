import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest

from sitespark.llm import vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, id string, code string, error string"


def brute(rows, parts=16, entries=64, rounds=2, scale=256):
    """Plain loops over Python integers, every distance computed."""
    kept = [(i, [max(-(1 << 24), min(1 << 24, math.floor(x * scale))) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return {}
    width = -(-max(len(v) for _, v, _ in kept) // parts)
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    cut = lambda v: [tuple((v + [0] * (width * parts))[p * width : (p + 1) * width]) for p in range(parts)]
    books = [[cut(v)[p] for _, v, _ in order] for p in range(parts)]
    split = [cut(v) for _, v, _ in kept]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def assign():
        return [[min((far(v[p], c), k) for k, c in enumerate(books[p])) for p in range(parts)] for v in split]

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            of = defaultdict(list)
            for v, f in zip(split, found):
                of[f[p][1]].append(v[p])
            for k, members in of.items():
                books[p][k] = tuple(sum(m[c] for m in members) // len(members) for c in range(width))
    found = assign()
    sums = defaultdict(int)
    for (_, _, label), f in zip(kept, found):
        sums[label] += sum(d for d, _ in f)
    sha = hashlib.sha256(",".join(str(x) for p in books for c in p for x in c).encode()).hexdigest()
    return sorted(((i, label, "".join(f"{k:02x}" for _, k in f), sum(d for d, _ in f), sums[label], sha) for (i, _, label), f in zip(kept, found)), key=repr)


def got(spark, rows, **options):
    df = spark.createDataFrame([(i, v, label, "a", "b", "c") for i, v, label in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in vector_codes.compress_vectors(df, **options).collect()), key=repr)


def test_equal_to_plain_loops(spark):
    r = random.Random(4)
    near = lambda c: [c + r.gauss(0, 0.05) for _ in range(32)]
    rows = [(i, [float(np.float32(x)) for x in near(r.choice([-1, 0, 0.5]))], r.choice([None, 0, 1, 2])) for i in range(300)]
    rows += [(7, rows[0][1], 0), (300, None, 1), (301, [0.1, None] * 16, 1), (302, [float("nan")] * 32, 1), (303, [float("inf")] + [0.0] * 31, 2), (None, rows[5][1], None)]
    rows += [(i, [(i % 2) / 256.0, (i // 2 % 2) / 256.0] * 16, 5) for i in range(-40, 0)]  # many ties
    assert got(spark, rows) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(1, [1.0] * 16, None)], [(1, [0.5, 0.25], 1), (2, [], 2), (3, [1.0] * 20, 1), (4, [1e30] * 3, 1)]])
def test_few_rows_and_odd_lengths(spark, rows):
    assert got(spark, rows) == (brute(rows) or [])


@pytest.mark.parametrize("rounds", [0, 1, 3])
def test_other_parameters(spark, rounds):
    r = random.Random(9)
    rows = [(i, [float(np.float32(r.uniform(-1, 1))) for _ in range(12)], i % 3) for i in range(60)]
    assert got(spark, rows, parts=4, entries=5, rounds=rounds, scale=10) == brute(rows, 4, 5, rounds, 10)


def test_bounds_spare_distances():
    """After a small movement most distances are passed over, and none that matters."""
    r = np.random.default_rng(2)
    x = r.integers(-300, 300, (500, 4))
    before = r.integers(-300, 300, (1, 64, 4))
    books = vector_codes.Codebooks(before + r.integers(-3, 4, before.shape), before)
    packed = vector_codes.first_bounds(x, before[0]).packed()
    found, checked = vector_codes.elkan(x, books, 0, vector_codes.Bounds.unpacked(*packed, 64))
    assert (found.code == vector_codes.first_bounds(x, books.entries[0]).code).all() and checked < 500 * 64 / 4
