import random

import pytest

from sitespark.llm import bpe


@pytest.mark.parametrize("seed", range(4))
def test_short_and_long_queues_agree(seed):
    """Over random merge tables: the queue with bitmaps of positions, the one with heaps, and merging by definition."""
    r = random.Random(seed)
    ranks = {bytes([b]): b for b in range(256)}
    pool = [bytes([b]) for b in b"abcde"]
    while len(ranks) < 256 + 300:
        token = r.choice(pool) + r.choice(pool)
        if token not in ranks and len(token) < 12:
            ranks[token] = len(ranks)
            pool.append(token)
    pairs, longest = bpe.first_pairs(ranks), max(map(len, ranks))

    def plain(piece):
        parts = [bytes([b]) for b in piece]
        while True:
            found = min(((ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks), default=None)
            if found is None:
                return [ranks[p] for p in parts]
            i = found[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    for _ in range(1500):
        piece = bytes(r.choice(b"abcdeaabbx") for _ in range(r.randrange(1, 65)))
        want = [ranks[piece]] if piece in ranks else plain(piece)
        assert bpe.encode_short(piece, ranks, pairs) == want == bpe.encode_piece(piece, ranks, longest, pairs)
