"""Secret scans: fixed formats, and strings that stay incompressible beside their surroundings."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, small_batches, texts

KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
#: A regular expression that starts with one of several words is slow; these tell whether it can match at all.
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: What makes the context of a string sensitive, in any case.
CONTEXT = re.compile(r"pass(?:word|wd|phrase)?|secret|token|api[_-]?key|credential|auth|bearer|private[_ -]key|access[_ -]key|session|signature|jwt|salt", re.IGNORECASE | re.ASCII)
CONTEXT_WORDS = ("pass", "secret", "token", "api", "credential", "auth", "bearer", "private", "access", "session", "signature", "jwt", "salt")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
#: Names and values that code and configuration are full of: what they explain is not novel.
IDENTIFIERS = (
    "abstract access account action address admin algorithm amazonaws api application argument array assert async attribute authorization aws background base64 "
    "bearer boolean buffer bucket cache callback certificate class client cloud column command commit component config connection const constructor content context "
    "controller cookie copyright count create credential database dataframe datetime debug default delete description development directory document domain double "
    "element email encoding endpoint environment error event exception execute export extends false field file filename finally float format framework function "
    "generate github global google group handler hash header height hostname html http https identifier image implements import index initialize input instance "
    "integer interface internal iterator javascript json key kubernetes label lambda language length library license list local location logger login master message "
    "metadata method microsoft model module namespace network nullable number object operation option output package parameter parent password path pattern payload "
    "permission platform plugin pointer port prefix private process production profile project property protected protocol provider public python query random "
    "receive record reference region register release repository request resource response result return role route runtime schema script secret security select "
    "server service session setting signature source static status storage string struct subscription super syntax system table target template test text thread "
    "timeout timestamp token true type undefined update upload user username uuid validate value variable version virtual window"
)


class Novelty:
    """Marginal bytes of a string: how much longer its surroundings compress with it, primed with IDENTIFIERS."""

    def __init__(self, around: int = 256, level: int = 3):
        words = IDENTIFIERS.split()
        camel = [w.title() for w in words]
        raw = " ".join([*camel, *(f"_{w}" for w in words), *words]).encode()
        primed = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        primed.precompute_compress(level=level)
        self.around, self.compress = around, zstandard.ZstdCompressor(dict_data=primed, write_checksum=False, write_content_size=False).compress

    def bits(self, text: str, start: int, end: int) -> float:
        """Bits that each character of text[start:end] adds to what stands around it. The rest of a text can't show the
        string itself, so a repeated secret is as novel as one that occurs once."""
        own = text[start:end]
        near = (text[max(0, start - self.around) : start] + text[end : end + self.around]).replace(own, "").encode()
        return 8 * (len(self.compress(near + own.encode())) - len(self.compress(near))) / len(own)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """assign, access and hex spans, leftmost and non-overlapping within a kind."""
    out = []
    low = text.lower()
    if any(w in low for w in WORDS):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    return out + [("hex", m.start(), m.end()) for m in HEX.finditer(text)]


def novel_spans(text: str, base: list[tuple[str, int, int]], novelty: Novelty, least_bits: float = 5.0) -> list[tuple[str, int, int]]:
    """Strings of 16 or more characters with letters and digits that have a sensitive word on either side, as near as
    novelty looks, that add least_bits or more for each character, and that no base span overlaps. A string that is not
    such itself but has a sensitive word in it ('auth=...') is also tried from that word on, and in parts between words."""
    out: list[tuple[str, int, int]] = []
    low = text.lower()
    if not any(w in low for w in CONTEXT_WORDS):
        return out
    taken: list[list[int]] = []  # the base spans, joined where they overlap
    for _, s, e in sorted(base, key=lambda x: x[1:]):
        if taken and s < taken[-1][1]:
            taken[-1][1] = max(e, taken[-1][1])
        else:
            taken.append([s, e])
    taken_ends = [e for _, e in taken]
    said = [m.span() for m in CONTEXT.finditer(text)]
    starts, ends = [s for s, _ in said], [e for _, e in said]

    def novel(start: int, end: int) -> bool:
        own = text[start:end]
        after = bisect_right(taken_ends, start)
        clear = after == len(taken) or taken[after][0] >= end
        return end - start >= 16 and clear and bool(re.search("[0-9]", own) and re.search("[A-Za-z]", own)) and novelty.bits(text, start, end) >= least_bits

    for m in CANDIDATE.finditer(text) if said else ():
        start, end = m.span()
        first, last = bisect_right(ends, start), bisect_left(starts, end)  # the words from first to before last are in it
        near = (first and starts[first - 1] >= start - novelty.around) or (last < len(said) and ends[last] <= end + novelty.around)
        if near and novel(start, end):
            out.append(("novel", start, end))
        elif first < last:
            if novel(ends[first], end):
                out.append(("novel", ends[first], end))
                end = starts[first]
                last = first
            edges = [start, *(x for span in said[first:last] for x in span), end]
            out += [("novel", s, e) for s, e in zip(edges[::2], edges[1::2]) if novel(s, e)]
    return sorted(out, key=lambda x: x[1])


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2])))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_bits: float = 5.0) -> DataFrame:
    """id, n_assign, n_access, n_hex, n_novel, base (the fixed formats' spans), spans (all): kind:start:end by start, then
    kind, in code points, ends exclusive.

    No shuffle and no state: a text is scanned whole by the task that reads it, in time linear in its length. Null text
    is empty and has no spans; repeated rows and null ids are kept; other columns are ignored.
    """

    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty()
        for batch in blocks(batches, 500):
            rows = []
            for text in texts(batch, 1):
                base = base_spans(text)
                more = novel_spans(text, base, novelty, least_bits=least_bits)
                rows.append([*(sum(k == kind for k, _, _ in base) for kind in KINDS[:3]), len(more), joined(base), joined(base + more)])
            columns = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:4]), *(pa.array(c, pa.string()) for c in columns[4:])], ["id", "n_assign", "n_access", "n_hex", "n_novel", "base", "spans"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    out = rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n_assign long, n_access long, n_hex long, n_novel long, base string, spans string")
    return out.withColumnRenamed("id", id_col)
