import base64
import hashlib
import random
import struct
from collections import Counter

import corpus_pipeline

from sitespark.llm import queries

WORDS = "river stone cloud maple copper signal window garden thunder pepper violet summit harbor lantern meadow crystal".split()


def table():
    """Twenty texts, exact copies in other case, copies of five-word similarity 0.80 to 0.90, and two texts without a letter."""
    r = random.Random(8)
    texts = [[r.choice(WORDS) + str(r.randrange(90)) for _ in range(r.randrange(100, 140))] for _ in range(20)]
    copies = [[f"{w}new" if i in (30, 60) else w for i, w in enumerate(texts[k])] for k in range(3)]
    rows = [" ".join(t) for t in texts] + [" ".join(t).upper() for t in texts[5:9]] + [" ".join(t) for t in copies] + ["12 34", ""]
    return list(enumerate(rows, 1))


def expected(rows):
    """Copies of each document, in plain Python."""
    rows = [(i, t) for i, t in rows if any(c.isalpha() for c in t)]
    last = {t.lower(): i for i, t in rows}
    rows = [(i, t) for i, t in rows if last[t.lower()] == i]
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, w in ((i, t.lower().split()) for i, t in rows)}
    group = {i: i for i in sets}
    for i in sets:
        for j in sets:
            if i < j and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                group = {k: min(group[i], group[j]) if g in (group[i], group[j]) else g for k, g in group.items()}
    rows = [(i, t) for i, t in rows if group[i] == i]
    # one source: its target is 1.5 times its words; each document once, then again in order of hash up to half its words
    ranked = sorted((int((h := hashlib.md5(f"0:{i}".encode()).hexdigest())[:8], 16) % 1024, h, i, len(t.split())) for i, t in rows)
    rest, upto, copies = round(1.5 * sum(x[-1] for x in ranked)) - sum(x[-1] for x in ranked), 0, {}
    for *_, i, size in ranked:
        upto += size
        copies[i] = 2 if upto - size // 2 <= rest else 1
    return copies


def test_pipeline_equals_plain_python(spark, tmp_path):
    import tiktoken

    rows = table()
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    got = Counter(tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect())
    path, pattern = queries.tokenizer()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    enc = tiktoken.Encoding("test", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    want, text = Counter(), dict(rows)
    for i, n in expected(rows).items():
        ids = enc.encode_ordinary(text[i])
        want[i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(text[i].encode()).hexdigest()] = n
    assert {k[0] for k in want} == {1, 2, 3, 4, 5, *range(10, 25)}
    assert got == want
