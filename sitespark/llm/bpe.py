"""Byte-level BPE: encoding with a hierarchical-bitmap rank queue, and decoding."""

from __future__ import annotations

import base64
import re
import uuid
from collections.abc import Iterator
from heapq import heappop, heappush
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, small_batches, texts


def load_ranks(path: str) -> dict[bytes, int]:
    """Merge ranks of a tiktoken vocabulary file: a base64 token and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, f))}


BIT = [1 << k for k in range(256)]


def first_pairs(ranks: dict[bytes, int]) -> list[int]:
    """The rank of each pair of bytes, -1 where it has none."""
    return [ranks.get(bytes((a, b)), -1) for a in range(256) for b in range(256)]


def encode_piece(piece: bytes, ranks: dict[bytes, int], longest: int, pairs: list[int]) -> list[int]:
    """Ids of one pre-token: repeatedly merge the leftmost pair of least rank. Time n log n, so that long pieces are fine.

    Positions wait in a bucket for each merge rank. A bitmap in two levels of 256-bit words marks the occupied buckets,
    and the least set bit of the upper word, then of the lower one, is the next rank. Tokens are a linked list
    (after, before); an entry whose pair has changed since it was queued is stale and is skipped. All in one function, as
    calls would take most of the time.
    """
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    n, rank_of = len(piece), ranks.get
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    pair = [pairs[a << 8 | b] for a, b in zip(piece, piece[1:])]
    pair.append(-1)
    buckets: dict[int, list[int]] = {}
    low: dict[int, int] = {}
    top = 0
    for i, r in enumerate(pair):
        if r >= 0:
            if r in buckets:
                buckets[r].append(i)  # ascending: a heap
            else:
                buckets[r] = [i]
                high = r >> 8
                if high in low:
                    low[high] |= BIT[r & 255]
                else:
                    low[high] = BIT[r & 255]
                    top |= BIT[high] if high < 256 else 1 << high
    while top:
        high = (top & -top).bit_length() - 1
        word = low[high]
        r = high << 8 | (word & -word).bit_length() - 1
        bucket = buckets[r]
        if len(bucket) == 1:
            i = bucket[0]
            del buckets[r]
            word &= word - 1
            if word:
                low[high] = word
            else:
                del low[high]
                top &= top - 1
        else:
            i = heappop(bucket)
        if pair[i] != r:
            continue
        j = after[i]
        end = after[i] = after[j]
        pair[j] = pair[i] = -1
        changed = []
        if end < n:
            before[end] = i
            changed.append((i, after[end]))
        if (p := before[i]) >= 0:
            changed.append((p, end))
        for at, stop in changed:
            new = rank_of(piece[at:stop]) if stop - at <= longest else None
            if new is None:
                pair[at] = -1
            else:
                pair[at] = new
                if new in buckets:
                    heappush(buckets[new], at)
                else:
                    buckets[new] = [at]
                    high = new >> 8
                    if high in low:
                        low[high] |= BIT[new & 255]
                    else:
                        low[high] = BIT[new & 255]
                        top |= BIT[high] if high < 256 else 1 << high
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : after[i]]])
        i = after[i]
    return ids


def encode_short(piece: bytes, ranks: dict[bytes, int], pairs: list[int]) -> list[int]:
    """encode_piece for up to 64 bytes: a bucket is a bitmap of positions too, whose least set bit is the leftmost one."""
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    n, rank_of, bits = len(piece), ranks.get, BIT
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    pair = [pairs[a << 8 | b] for a, b in zip(piece, piece[1:])]
    pair.append(-1)
    buckets: dict[int, int] = {}
    low: dict[int, int] = {}
    top, bucket_of, low_of, place = 0, buckets.get, low.get, 1
    for r in pair:
        if r >= 0:
            held = bucket_of(r)
            if held:
                buckets[r] = held | place
            else:
                buckets[r] = place
                high = r >> 8
                low[high] = low_of(high, 0) | bits[r & 255]
                top |= bits[high]
        place += place
    while top:
        high = (top & -top).bit_length() - 1
        word = low[high]
        least = word & -word
        r = high << 8 | least.bit_length() - 1
        held = buckets[r]
        place = held & -held
        i = place.bit_length() - 1
        if held != place:
            buckets[r] = held ^ place
        else:
            del buckets[r]
            if word != least:
                low[high] = word ^ least
            else:
                del low[high]
                top &= top - 1
        if pair[i] != r:
            continue
        j = after[i]
        end = after[i] = after[j]
        pair[j] = pair[i] = -1
        if end < n:
            before[end] = i
            new = rank_of(piece[i : after[end]])
            if new is not None:
                pair[i] = new
                held = bucket_of(new)
                if held:
                    buckets[new] = held | place
                else:
                    buckets[new] = place
                    high = new >> 8
                    low[high] = low_of(high, 0) | bits[new & 255]
                    top |= bits[high]
        p = before[i]
        if p >= 0:
            new = rank_of(piece[p:end])
            if new is None:
                pair[p] = -1
            else:
                pair[p] = new
                held = bucket_of(new)
                if held:
                    buckets[new] = held | bits[p]
                else:
                    buckets[new] = bits[p]
                    high = new >> 8
                    low[high] = low_of(high, 0) | bits[new & 255]
                    top |= bits[high]
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : after[i]]])
        i = after[i]
    return ids


class _Known(dict):
    """Results of `make` for the keys met lately: at most `most` new ones and the `most` before them, the others are made anew."""

    def __init__(self, make, most: int):
        self.make, self.most, self.before = make, most, {}

    def __missing__(self, key: str) -> bytes:
        got = self.before.get(key)
        if got is None:
            got = self.make(key)
            if len(key) >= 64:
                return got
        self[key] = got
        return got

    def trim(self) -> None:
        if len(self) > self.most:
            self.before = dict(self)
            self.clear()


#: Texts of which a pre-token pattern is tried before single spaces are taken for borders.
_TRIED = ("a b", "a1 2b", "it's 'x y", "a, b. c", "1 2 3", "x\u00e9 \u00fcy", "a-b -c", "\u65e5 \u672c", "a_ _b", "A Bc D", "12345 67", "? !a")


def spaces_are_borders(pattern: str) -> bool:
    """Whether the pattern splits at a single space between two other characters, leaving the space to what follows, and
    takes each stretch from such a space on as if it stood alone; tried on a few texts and their pairs."""
    import regex

    find = regex.compile(pattern).findall
    for text in [*_TRIED, *(f"{a} {b}" for a in _TRIED for b in _TRIED)]:
        first, *rest = text.split(" ")
        if find(text) != [*find(first), *(x for word in rest for x in find(" " + word))]:
            return False
    return True


class Encoder:
    """Encodes whole texts; texts are pre-tokenised by `pattern`, and each pre-token is merged by itself.

    Where spaces_are_borders holds, stretches between single spaces are looked up as a whole; texts with other runs of
    white space, and all texts under another pattern, go through the pattern in full.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, most: int = 250_000):
        import regex

        self.ranks, self.longest = ranks, max(map(len, ranks), default=0)
        self.pairs, self.few = first_pairs(ranks), max(ranks.values(), default=0) < 1 << 16  # an upper word has 256 bits
        self.find = regex.compile(pattern).findall
        self.uneven = re.compile(r"\s(?= )| (?=\s)|^ |[ ]\Z").search if spaces_are_borders(pattern) else lambda text: True
        self.pieces = _Known(self._piece, most)
        self.after_space = _Known(lambda word: self.by_pattern(" " + word), most)

    def _piece(self, piece: str) -> bytes:
        data = piece.encode()
        ids = encode_short(data, self.ranks, self.pairs) if len(data) <= 64 and self.few else encode_piece(data, self.ranks, self.longest, self.pairs)
        return pack(f"<{len(ids)}I", *ids)

    def by_pattern(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.find(text)))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self.uneven(text):
            return self.by_pattern(text)
        first, *rest = text.split(" ")
        return self.by_pattern(first) + b"".join(map(self.after_space.__getitem__, rest))

    def trim(self) -> None:
        self.pieces.trim()
        self.after_space.trim()


#: The encoder that this Python worker used last: a worker's tasks share what has been looked up, at most four times
#: the `known` texts of bpe_encode.
_LAST: dict[tuple, Encoder] = {}


def worker_encoder(key: tuple, ranks: dict[bytes, int], pattern: str, known: int) -> Encoder:
    if key not in _LAST:
        _LAST.clear()
        _LAST[key] = Encoder(ranks, pattern, known)
    return _LAST[key]


def bpe_encode(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", decode: bool = False, known: int = 250_000) -> DataFrame:
    """Encode every whole text: id, n_tokens, ids (packed little-endian unsigned 32-bit), and decoded bytes if asked for.

    vocabulary is a path on the driver; the ranks travel in one broadcast of the size of that file (about 1 MB). No
    shuffle: each task encodes its own rows. Null text is empty and gives no ids; repeated rows and null ids are kept as
    they are; special tokens are ordinary text; other columns are ignored, so no name can clash. Ids decode to the
    text's UTF-8 exactly. known: how many texts a worker remembers the ids of, in each of two tables (some 600 MB at the default
    of 250,000, half of that at 120,000, where about a third more are worked out again); ids don't depend on it.
    """
    small_batches(docs.sparkSession)
    ranks = docs.sparkSession.sparkContext.broadcast(load_ranks(vocabulary))
    key = (uuid.uuid4().hex, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(key, ranks.value, pattern, known)
        tokens = {rank: token for token, rank in ranks.value.items()}
        for batch in blocks(batches, 500):
            ids = [encoder.encode(t) for t in texts(batch, 1)]
            columns = [batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
            if decode:
                columns.append(pa.array([decode_ids(x, tokens) for x in ids], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_tokens", "ids", "decoded"][: len(columns)])
            encoder.trim()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    out = rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n_tokens long, ids binary" + ", decoded binary" * decode)
    return out.withColumnRenamed("id", id_col)


def decode_ids(ids: bytes, tokens: dict[int, bytes]) -> bytes:
    """The bytes that packed ids stand for."""
    return b"".join(map(tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def bpe_decode(encoded: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Decode packed ids: id, decoded. Null ids decode to nothing; an id outside the vocabulary is an error."""
    ranks = encoded.sparkSession.sparkContext.broadcast(load_ranks(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = {rank: token for token, rank in ranks.value.items()}
        for batch in blocks(batches, 500):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([decode_ids(x or b"", tokens) for x in batch.column(1).to_pylist()], pa.binary())], ["id", "decoded"])

    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, decoded binary").withColumnRenamed("id", id_col)
