import re

import pytest

from sitespark.operators import resolve

PLACES = [(10, "OAK HILL", "TX"), (11, "HELM", "CA"), (12, "KERMAN", "CA"), (13, "SOUTH LEBANON", "PA"), (14, "GRANITE REEF", "AZ"), (15, "WOONSOCKET", "RI"), (16, "LAKE CITY", "CA"), (17, "UNKNOWN123", "CA"), (18, "BIRDS LANDING", "CA"), (19, "NELSON", "TX"), (20, "BEARKAT", "TX"), (21, "OAK HILL", "TX"), (22, "MEADOWLARK", "TX"), (23, None, "TX")]
QUERIES = [("Helm-Kerman 70 kV Line", "CA"), ("Kerman to Helm 70kV", "CA"), ("Lebanon 230 kV", "PA"), ("Granite Creek", "AZ"), ("RIE feeder 26W7, Woonsocket Substation", "RI"), ("PG&E Birds Landing Switchyard", "CA"), ("138kV 11273 NELSON", "TX"), ("tap 345kV 59903 Bearkat", "TX"), ("#79501 Bearkat 345kV", "TX"), ("Lake City East", "CA"), ("Old Lake", "CA"), ("Meadowlerk", "TX"), ("Meadowlakke Rd", "TX"), ("Medowlrk", "TX"), ("Oak Hill", "ZZ"), ("Oak Hill", ""), ("Oak Hill", None), (None, "TX"), ("(x)", "TX"), ("Oak Hill Substation", "TX"), ("Oakk Hill, Travis County", "TX"), ("Elsewhere", "TX"), ("UNKNOWN123", "CA"), ("Bearkat - Zzyzx", "TX")]


@pytest.mark.parametrize(("name", "want"), [("Helm-Kerman 70 kV Line", "HELM-KERMAN"), ("PG&E New Oak Hill (north) 500/230kV", "OAK HILL"), ("138kV 11273 NELSON", "NELSON"), ("RIE feeder 26W7, Woonsocket Substation", "WOONSOCKET"), ("Possum Point II Power Plant Unit 3", "POSSUM POINT"), ("Meadow Street 552, Hartford", "MEADOW"), ("O'Neal_x0020_", "O NEAL")])
def test_normal_names(spark, name, want):
    df = spark.createDataFrame([(name,)], "name string")
    assert df.select(resolve.normalise(df.name)).first()[0] == want


def subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        row, old = [0], row
        for j, y in enumerate(b):
            row.append(old[j] + 1 if x == y else max(row[j], old[j + 1]))
    return row[-1]


def similarity(a, b):
    x, y = set(a.split()), set(b.split())
    both = " ".join(sorted(x & y))
    if both and (x <= y or y <= x):
        return 100.0
    s, t = (f"{both} {' '.join(sorted(z))}".strip() for z in (x - y, y - x))
    pairs = [(s, t)] + ([(both, s), (both, t)] if both else [])
    return max(200 * subsequence(u, v) / (len(u) + len(v)) for u, v in pairs)


def brute(norm, state, line, places):
    """The cascade row by row; norm and places have normal names."""
    near = sorted((i, n) for i, n, s in places if s == state and n)
    if not state or not near:
        return None, "no_state_filter"
    if not norm:
        return None, "empty_after_norm"
    for i, n in near:
        if n == norm:
            return i, "exact"

    def best(text):
        return max(((similarity(text, n), -i, n) for i, n in near))

    def fine(text, place):
        stop = {"THE", "AND", "FOR", "NEW", "OLD", "EAST", "WEST", "NORTH", "SOUTH", "UNIT", "LINE", "AREA", "ROAD", "PARK", "LAKE", "CITY"}
        wrong = ("LEBANON" in text and "SOUTH LEBANON" in place) or ("GRANITE CREEK" in text and "GRANITE REEF" in place)
        return not wrong and any(len(w) >= 4 and w not in stop for w in set(text.split()) & set(place.split()))

    score, i, n = best(norm)
    if not line and score >= 90 and fine(norm, n):
        return -i, "fuzzy_high"
    ends = [h.strip() for sep in ("-", " TO ") if sep in norm for h in norm.split(sep) if len(h.strip()) >= 3]
    if ends:
        s, j, m, h = max(((*best(h), h) for h in ends), key=lambda x: x[0])
        if s >= 90 and fine(h, m):
            return -j, "fuzzy_high_endpoint"
    if not line and score >= 85 and fine(norm, n):
        return -i, "fuzzy_medium"
    return None, "fuzzy_low" if not line and score >= 70 else "unmatched"


def test_cascade_equals_brute_force(spark):
    q = spark.createDataFrame([(k, *r) for k, r in enumerate(QUERIES)], "query_id long, name string, state string")
    p = spark.createDataFrame(PLACES, "place_id long, name string, state string")
    got = {r["query_id"]: r for r in resolve.match(q, p).collect()}
    norms = {r[0]: r[1] or "" for r in q.select("query_id", resolve.normalise(q.name)).collect()}
    places = [(i, n, s) for i, n, s in PLACES if n and not re.match("UNKNOWN", n)]
    want = {k: brute(norms[k], s, got[k]["line"], places) for k, (_, s) in enumerate(QUERIES)}
    assert {k: (r["place_id"], r["method"]) for k, r in got.items()} == want
    assert len(got) == len(QUERIES) and {m for _, m in want.values()} >= {"exact", "fuzzy_high", "fuzzy_high_endpoint", "fuzzy_low", "unmatched", "no_state_filter", "empty_after_norm"}
    assert want[0] == (11, "fuzzy_high_endpoint") and got[0]["line"] and got[0]["query_kv"] == 70.0
    assert want[2][0] is None and want[3][0] is None and got[2]["method"] == "fuzzy_low" and got[2]["place_name"] == "SOUTH LEBANON"
