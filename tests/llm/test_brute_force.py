"""Secret spans and toxicity scores recomputed by other means than the operators'."""

import math
import random
import re

import numpy as np
import zstandard

from sitespark.llm import secret_scan, toxicity

WORDS = "river stone cloud maple copper signal window garden thunder pepper violet summit harbor lantern meadow crystal".split()


def brute_spans(text):
    """Base spans by trying every start, character by character."""
    out = []
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    at = 0
    while at < len(text):
        found = None
        for word in ("password", "passwd", "secret", "token", "api_key", "apikey"):
            i = at + len(word)
            if not lower.startswith(word, at):
                continue
            for quote in ((1, 0) if text[i : i + 1] in ("'", '"') and i < len(text) else (0,)):
                j = i + quote
                while text[j : j + 1] == " ":
                    j += 1
                if text[j : j + 1] in (":", "=") and j < len(text):
                    j += 1
                    while text[j : j + 1] == " ":
                        j += 1
                    j += text[j : j + 1] in ("'", '"') and j < len(text)
                    k = j
                    while k < len(text) and (text[k].isascii() and text[k].isalnum() or text[k] in "+/_.=-"):
                        k += 1
                    if k > j:
                        found = found or (k, k - j)
        if found:
            if found[1] >= 8:
                out.append(("assign", at, found[0]))
            at = found[0]
        else:
            at += 1
    for kind, first, allowed, least in (("access", "AKIA", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 16), ("hex", "", "0123456789abcdef", 32)):
        at = 0
        while at < len(text):
            k = at + len(first)
            while text.startswith(first, at) and k < len(text) and text[k] in allowed:
                k += 1
            if text.startswith(first, at) and k > at + len(first):
                if k - at >= least:
                    out.append((kind, at, k))
                at = k
            else:
                at += 1
    return out


def test_base_spans(spark):
    r = random.Random(11)
    pieces = ["password", "PassWD", "secret", "token", "api_key", "APIKEY", '"', "'", " ", "=", ":", "  ", "abcd1234", "x.y-z/+", "AKIA", "ABCDEF0123456789", "0123456789abcdef" * 2, "é", "İ", "K", "\n", "deadbeef", "G", "_"]
    texts = ["".join(r.choices(pieces, k=r.randrange(1, 40))) for _ in range(1500)]
    got = {x["doc_id"]: x for x in secret_scan.scan_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, t in enumerate(texts):
        want = brute_spans(t)
        assert got[i]["base"] == secret_scan.joined(want), t
        assert [got[i][f"n_{k}"] for k in secret_scan.KINDS[:3]] == [sum(x == k for x, _, _ in want) for k in secret_scan.KINDS[:3]]
        assert set(filter(None, got[i]["base"].split(","))) <= set(got[i]["spans"].split(","))


def test_toxicity_scores(spark):
    r = random.Random(12)
    rows = [(i, " ".join(r.choices(WORDS, k=r.randrange(20, 300))) + (" you gutterbrain slime " if i % 4 == 0 else ""), int(i % 4 == 0)) for i in range(300)] + [(900, "", 0), (901, None, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit_toxicity(df)
    how = zstandard.ZstdCompressionParameters.from_level(3, min_match=6, hash_log=16, chain_log=16, search_log=4, write_content_size=False, write_checksum=False, write_dict_id=False)
    size = [lambda w, d=zstandard.ZstdCompressionDict(model[k]): len(zstandard.ZstdCompressor(dict_data=d, compression_params=how).compress(w)) for k in ("ordinary", "toxic")]
    got = {x["doc_id"]: x for x in toxicity.score_toxicity(df, model).collect()}
    for i, t, _ in rows[::7] + rows[-2:]:
        raw, cut = b" " + b" ".join(w.encode() for w in (t or "").lower().split()) + b" ", []
        while raw:
            end = len(raw) if len(raw) <= toxicity.WINDOW_BYTES else (raw.rfind(b" ", 1, toxicity.WINDOW_BYTES) if raw.rfind(b" ", 1, toxicity.WINDOW_BYTES) > 0 else toxicity.WINDOW_BYTES)
            cut, raw = [*cut, raw[:end]], raw[end:]
        gains = [size[0](w) - size[1](w) for w in cut]
        top = sorted(gains, reverse=True) + [-5, -5, -5]
        x = [min(top[0], 12), min(top[1] + top[2], 24), math.log1p(len(gains)), sum(gains) / len(gains), *(sum(g >= s for g in gains) / len(gains) for s in (2, 3, 5)), math.log1p(sum(max(g - 2, 0) for g in gains))]
        z = model["weights"][0] + float(np.dot(x, model["weights"][1:]))
        assert abs(got[i]["score"] - 1 / (1 + math.exp(-z))) < 1e-6 and got[i]["predicted"] == (got[i]["score"] >= 0.5)
    assert sum(got[i]["predicted"] == y for i, _, y in rows) > 0.95 * len(rows)
    assert re.fullmatch(r"[01]+", "".join(str(got[i]["predicted"]) for i, *_ in rows))
