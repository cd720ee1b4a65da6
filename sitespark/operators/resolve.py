"""Entity resolution: noisy asset names to known places, blocked by state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: What is cut off or out of a name, in this order. (?U) reads \w, \s and \b as Unicode.
PREFIXES = (
    r"^NYISO\s+", r"^NGRID\s+", r"^RIE\s+FEEDER\s+\S+,?\s*", r"^NSP\s+", r"^CONED\s+", r"^PSEG\s+", r"^PG&?E\s+", r"^SCE\s+", r"^SDGE\s+", r"^APS\s+", r"^AEP\s+\d*\s*", r"^AEP\s+",
    r"^PROPOSED\s+", r"^NEW\s+", r"^#?\d{4,6}\s+", r"^TAP\s+\d+\s*K?V\s+\d+\s+", r"^TAP\s+\d+\s*K?V\s+", r"^TAP\s+", r"^BUS\s*#?\s*\d+\s*,?\s*", r"\bSHECO\s+", r"\bLCRA\s+", r"\b\(AEP\)", r"\bNWP\b", r"_X[0-9A-F]{4}_",
)
VOLTAGES = (r"\b\d+/\d+(\.\d+)?\s*K?V?\b", r"\b\d+(\.\d+)?\s*-\s*K?V\b", r"\b\d+(\.\d+)?\s*K?V\b", r"\b\d{3,4}\b(?=\s*(?:LINE|BUS|$))", r"\b\d+(\.\d+)?KV\b")
SUFFIXES = (
    r"\bPOWER\s+PLANT\b", r"\bGENERATING\s+STATION\b", r"\bGEN\s+STATION\b", r"\bSWITCHING\s+STATION\b", r"\bSUBSTATION\b", r"\bSWITCHYARD\b", r"\bSTATION\b", r"\bSUB\b", r"\bYARD\b", r"\bPLANT\b", r"\bLINE\b",
    r"\bTAP\b", r"\bBUS\s+\w+\b", r"\bT[123]\b", r"\bUNIT\s+\d+\b", r"\b#\d+\b", r"\bSS\b", r"\bDP\b", r"\bSTREET\b", r"\bAVENUE\b", r"\bROAD\b", r"\b\d{2,4}\b", r"\bSWITCH\b", r"\bII\b", r"\bNO\s*\.\s*\d+\b",
)
#: Words that are no evidence of the same name, and pairs of (part of the query, part of the place) that are known to be wrong.
STOP_WORDS = ("THE", "AND", "FOR", "NEW", "OLD", "EAST", "WEST", "NORTH", "SOUTH", "UNIT", "LINE", "AREA", "ROAD", "PARK", "LAKE", "CITY")
WRONG_PAIRS = (("LEBANON", "SOUTH LEBANON"), ("GRANITE CREEK", "GRANITE REEF"))


def _without(text: Column, patterns) -> Column:
    for pattern in patterns:
        text = F.regexp_replace(text, "(?U)" + pattern, "")
    return text


def _collapsed(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def normalise(name: Column) -> Column:
    """Upper case without parentheses, prefixes, what follows a comma, voltages, kind words and punctuation but hyphens.

    Prefixes go twice: before the comma, as a name can follow one, and after the voltage, which can hide a bus number."""
    out = _without(_without(F.upper(name), [r"\([^)]*\)"]), PREFIXES)
    out = _without(_without(out, [r",.*$"]), VOLTAGES)
    out = _without(_without(_collapsed(out), PREFIXES), SUFFIXES)
    return _collapsed(F.regexp_replace(out, r"(?U)[^\w\s\-]", " "))


def is_line(name: Column) -> Column:
    """Whether a point of interconnection names a line rather than a station."""
    bare = F.regexp_replace(name, r"\([^)]*\)", "")
    # voltages are upper case only here, as in the reference, which strips them from the name as it is written
    short = _without(bare, VOLTAGES)
    line = bare.rlike(r"(?iU)\bLINE\b") | short.rlike(r"(?U)\b([A-Za-z]{4,})\s*[-\u2013]\s*([A-Za-z]{4,})\b") | short.rlike(r"(?iU)\b([A-Z]{4,})\s+TO\s+([A-Z]{4,})\b")
    return F.coalesce(~F.upper(name).rlike(r"(?U)\b(SUBSTATION|SWITCHYARD)\b") & line, F.lit(False))


def line_kv(name: Column) -> Column:
    found = F.regexp_extract(F.upper(name), r"(?U)\b(\d+(?:\.\d+)?)\s*KV\b", 1)
    return F.when(found != "", found.cast("double"))


def common_tokens(a: Column, b: Column, least: int = 4) -> Column:
    """At least one shared token of `least` letters or more that is no stop word."""
    def long_tokens(c):
        return F.filter(F.split(c, " "), lambda t: (F.length(t) >= least) & ~t.isin(*STOP_WORDS))

    return F.arrays_overlap(long_tokens(a), long_tokens(b))


def wrong_pair(query: Column, place: Column) -> Column:
    out = F.lit(False)
    for x, y in WRONG_PAIRS:
        out = out | (query.contains(x) & place.contains(y))
    return out


def _lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, with one bit per character of a."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    s = full
    for c in b:
        u = s & places.get(c, 0)
        s = (s + u | s - u) & full
    return len(a) - s.bit_count()


def _ratio(a: str, b: str) -> float:
    return 200.0 * _lcs(a, b) / (len(a) + len(b)) if a or b else 0.0


def token_set_ratio(a: str, b: str) -> float:
    """Similarity of two names as token sets, 0 to 100."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, only_x, only_y = " ".join(sorted(x & y)), " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if both and (not only_x or not only_y):
        return 100.0
    with_x, with_y = f"{both} {only_x}".strip(), f"{both} {only_y}".strip()
    best = _ratio(with_x, with_y)
    return max(best, _ratio(both, with_x), _ratio(both, with_y)) if both else best


def _best(texts: DataFrame, places: DataFrame) -> DataFrame:
    """state, text, place (score, place_id, norm, name): of all places of the state the most similar, ties to the lesser id."""
    pairs = texts.join(places, "state").select("state", "text", "place_id", "place_norm", "place_name")

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(score=[token_set_ratio(x, y) for x, y in zip(b.text, b.place_norm, strict=True)])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pairs.schema) + ", score double"
    best = F.min(F.struct((-F.col("score")).alias("s"), "place_id", "place_norm", "place_name"))
    return pairs.mapInPandas(score, schema).groupBy("state", "text").agg(best.alias("b"))


def match(queries: DataFrame, places: DataFrame, high: float = 90.0, medium: float = 85.0, low: float = 70.0) -> DataFrame:
    """queries (query_id, name, state) with place_id, method, score, line, place_name, query_kv; places have place_id, name,
    state.

    The cascade of SURVEY A.14: exact normal names; the most similar place of the state from `high` on; for names of two
    endpoints ('A-B', 'A TO B') the more similar endpoint from `high` on; from `medium` on; from `low` on the name alone,
    for review, without place_id. All but the last need a shared word that is no stop word and no known wrong pair. Names
    of lines are compared by endpoint only. Distinct names are compared with all places of their state, as the best place
    is chosen before it is tested. Ties go to the first endpoint and the lesser id. Places named UNKNOWN... are left out.
    """
    q = queries.withColumn("norm", F.coalesce(normalise(F.col("name")), F.lit(""))).withColumn("line", is_line(F.col("name")))
    p = places.filter("name IS NOT NULL AND state IS NOT NULL AND NOT startswith(name, 'UNKNOWN')")
    p = p.select("state", normalise(F.col("name")).alias("place_norm"), F.struct("place_id", F.col("name").alias("place_name")).alias("x")).filter("place_norm != ''")
    p = p.groupBy("state", "place_norm").agg(F.min("x").alias("x")).select("state", "place_norm", "x.*")
    exact = p.select("state", F.col("place_norm").alias("norm"), F.struct("place_id", "place_name").alias("exact"))
    asked = q.filter("norm != '' AND state != ''").select("state", "norm", "line").distinct().join(exact, ["state", "norm"], "left_anti")

    norm = F.col("norm")
    halves = F.concat(*(F.when(norm.contains(sep), F.split(norm, sep)).otherwise(F.array().cast("array<string>")) for sep in ("-", " TO ")))
    ends = asked.select("state", "norm").distinct().select("state", "norm", F.posexplode(halves).alias("at", "half")).withColumn("text", F.trim("half")).filter(F.length("text") >= 3)
    best = _best(asked.filter("NOT line").select("state", norm.alias("text")).union(ends.select("state", "text")).distinct(), p)
    end = ends.join(best, ["state", "text"]).groupBy("state", "norm").agg(F.min(F.struct(F.col("b.s").alias("s"), "at", "text", "b")).alias("end"))
    full = best.select("state", F.col("text").alias("norm"), F.col("b").alias("full"))

    def passes(text, found):
        return common_tokens(text, found["place_norm"]) & ~wrong_pair(text, found["place_norm"])

    known = p.select("state").distinct().withColumn("known", F.lit(True))
    out = q.join(known, "state", "left").join(exact, ["state", "norm"], "left").join(full, ["state", "norm"], "left").join(end, ["state", "norm"], "left")
    whole = F.when(~F.col("line"), -F.col("full.s"))
    good, half = passes(norm, F.col("full")), F.col("end.b")
    method = (
        F.when(F.col("known").isNull() | (F.col("state") == ""), "no_state_filter").when(norm == "", "empty_after_norm").when(F.col("exact").isNotNull(), "exact").when((whole >= high) & good, "fuzzy_high")
        .when((-half["s"] >= high) & passes(F.col("end.text"), half), "fuzzy_high_endpoint").when((whole >= medium) & good, "fuzzy_medium").when(whole >= low, "fuzzy_low").otherwise("unmatched")
    )
    out = out.withColumn("method", method)
    method, by_end = F.col("method"), F.col("method") == "fuzzy_high_endpoint"

    def of(column):
        return F.when(method == "exact", F.col(f"exact.{column}")).when(by_end, F.col(f"end.b.{column}")).when(method.startswith("fuzzy"), F.col(f"full.{column}"))

    score = F.when(method == "exact", 100.0).when(by_end, -F.col("end.b.s")).when(method.isin("no_state_filter", "empty_after_norm"), 0.0).otherwise(F.coalesce(whole, F.lit(0.0)))
    return out.select("query_id", F.when(method != "fuzzy_low", of("place_id")).alias("place_id"), "method", score.alias("score"), "line", of("place_name").alias("place_name"), line_kv(F.col("name")).alias("query_kv"))
