"""Removal of passages that an earlier document has: suffix automata of reference shards, matching statistics of documents.

Which passages meet which shard is found by hashes; what is removed is decided by the automata, word by word.

1. Documents are written as chunks. Each run of 50 words has an anchor, the least of its 25-word hashes, so that equal runs
   have equal anchors; about one word in thirteen starts one. Anchors in one document only are ruled out (`exchange`).
2. Of the runs whose anchor is left, hashes are exchanged: each chunk learns the least and the greatest document of each.
   Runs that are in a later document too make up the reference passages of the least one; the same runs in later documents
   make up the passages to be looked up.
3. Passages are dealt by their reference document to shards of bounded size. A shard's suffix automaton has at each state the least
   document with that state's strings. Passages to be looked up are streamed through it: where at least 50 words match
   and the state of the last 50 has a smaller document, these words go. Shards asked by many chunks are copied to several tasks.
4. Each chunk gets back the spans that go.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import chunk_tokens, cuts_of, equal_ranges, exchange, joined, with_answers
from .common import Work, batches_of, mix, pack, pack_sorted, raw_texts, release, unpack, unpack_sorted

#: An odd multiplier of the hashes of word sequences, and its inverse modulo 2^64: fixed, so that reruns agree.
STEP = 0x9E3779B97F4A7C15
BACK = pow(STEP, -1, 1 << 64)
#: Words of reference passages in one automaton, about; passages looked up in one copy of it.
SHARD_WORDS, SHARD_ASKS = 10_000, 256
#: Anchors or runs for each bucket of an exchange, about.
BUCKET_KEYS = 500_000


class Automaton:
    """The suffix automaton of several texts of word numbers, with the least owner of each state's strings."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.owner = [-1], [0], [None]

    def add(self, words: list[int], owner: int) -> None:
        nxt, link, length, own = self.next, self.link, self.length, self.owner
        last = 0
        for w in words:
            q = nxt[last].get(w)
            if q is not None and length[q] == length[last] + 1:  # known from an earlier text
                last = q
                if own[q] is None or owner < own[q]:
                    own[q] = owner
                continue
            cur = None
            if q is None:
                cur = len(nxt)
                nxt.append({})
                length.append(length[last] + 1)
                link.append(0)
                own.append(owner)
                p = last
                while p >= 0 and w not in nxt[p]:
                    nxt[p][w] = cur
                    p = link[p]
                if p < 0:
                    last = cur
                    continue
                q = nxt[p][w]
            else:
                p = last
            if length[q] == length[p] + 1:
                link[cur] = q
                last = cur
                continue
            new = len(nxt)
            nxt.append(dict(nxt[q]))
            length.append(length[p] + 1)
            link.append(link[q])
            own.append(None)
            while p >= 0 and nxt[p].get(w) == q:
                nxt[p][w] = new
                p = link[p]
            link[q] = new
            if cur is None:
                cur = new
                own[new] = owner
            else:
                link[cur] = new
            last = cur

    def settle(self) -> None:
        """Give each state the least owner of all states whose strings end with its own. Call it once, when all texts are in."""
        own, link = self.owner, self.link
        for s in sorted(range(1, len(own)), key=self.length.__getitem__, reverse=True):
            p = link[s]
            if p > 0 and own[s] is not None and (own[p] is None or own[s] < own[p]):
                own[p] = own[s]

    def earlier(self, words: list[int], run: int) -> Iterator[tuple[int, int]]:
        """The matching statistics of words: for each place where the last `run` words match, the place and their least owner."""
        nxt, link, length, own = self.next, self.link, self.length, self.owner
        state = match = 0
        for i, w in enumerate(words):
            to = nxt[state].get(w)
            while to is None and state:
                state = link[state]
                match = length[state]
                to = nxt[state].get(w)
            if to is None:
                continue
            state, match = to, match + 1
            while state and length[link[state]] >= run:  # what counts are the last `run` words: the state whose strings they are among
                state = link[state]
                match = length[state]
            if match >= run:
                yield i, own[state]


class Chunk:
    """ids and texts of a chunk's documents, and the words of all one behind the other."""

    def __init__(self, row: dict):
        self.ids, self.name = row["ids"], row["chunk"]
        texts = zstandard.ZstdDecompressor().decompress(row["texts"])
        cut = np.concatenate([[0], np.cumsum(unpack(row["lengths"], np.uint32), dtype=np.int64)])
        self.documents = [texts[cut[i] : cut[i + 1]].split() for i in range(len(self.ids))]


def rolled(documents: list[list[bytes]], ids: list, run: int, gram: int):
    """Of the documents' runs: where they start among all words, their document, anchor and hash."""
    sizes = np.array([len(d) if i is not None else 0 for d, i in zip(documents, ids, strict=True)], np.int64)
    lengths = np.array([len(d) for d in documents], np.int64)
    firsts = np.cumsum(lengths) - lengths
    memo: dict[bytes, int] = {}
    digest = xxhash.xxh3_64_intdigest
    for d in documents:
        for w in set(d):
            if w not in memo:
                memo[w] = digest(w)
    h = np.fromiter((memo[w] for d in documents for w in d), np.uint64, int(lengths.sum()))
    doc = np.repeat(np.arange(len(documents)), np.maximum(0, sizes - run + 1))
    starts = np.arange(len(doc)) - np.repeat(np.cumsum(np.maximum(0, sizes - run + 1)) - np.maximum(0, sizes - run + 1), np.maximum(0, sizes - run + 1)) + firsts[doc]
    if not len(starts):
        return starts, doc, np.empty(0, np.uint64), np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        power = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(len(h), STEP, np.uint64)]), dtype=np.uint64)
        back = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(len(h), BACK, np.uint64)]), dtype=np.uint64)
        upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * power[:-1], dtype=np.uint64)])
        of = lambda at, n: mix((upto[at + n] - upto[at]) * back[at])
        least = of(np.arange(len(h) - gram + 1), gram)
        span, wide = 1, least
        while 2 * span <= run - gram + 1:
            wide, span = np.minimum(wide[:-span], wide[span:]), 2 * span
        anchors = np.minimum(wide[starts], wide[starts + run - gram + 1 - span])
        return starts, doc, anchors, of(starts, run)


def keyed(keys: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with the least and the greatest owner of each."""
    if not len(keys):
        return keys, owners, owners
    order = np.argsort(keys, kind="stable")
    keys, owners = keys[order], owners[order]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[at], np.minimum.reduceat(owners, at), np.maximum.reduceat(owners, at)


def chunked(docs: DataFrame, id_col: str, text_col: str, run: int, gram: int) -> DataFrame:
    """Chunks of documents: texts compressed, and the anchors with their least and greatest document. To be written before use."""
    most = chunk_tokens(docs)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held, size = [], [], 0

        def row() -> pa.RecordBatch:
            documents = [t.split() for t in held]
            _, doc, anchors, _ = rolled(documents, ids, run, gram)
            keys, low, high = keyed(anchors, np.array([i or 0 for i in ids], np.int64)[doc])
            lengths = np.array([len(t) for t in held], np.uint32)
            data = [zstandard.ZstdCompressor(level=3).compress(b"".join(held)), pack(lengths), pack_sorted(keys), pack(low), pack(high)]
            return pa.RecordBatch.from_arrays([pa.array([uuid.uuid4().hex]), pa.array([len(keys)], pa.int64()), pa.array([ids], pa.list_(pa.int64())), *(pa.array([d], pa.binary()) for d in data)], ["chunk", "n", "ids", "texts", "lengths", "keys", "low", "high"])

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), raw_texts(batch, 1), strict=True):
                ids.append(key)
                held.append(text)
                size += text.count(b" ") + len(text) // 64
                if size >= most:
                    yield row()
                    ids, held, size = [], [], 0
        if ids:
            yield row()
        release()

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(make, "chunk string, n long, ids array<long>, texts binary, lengths binary, keys binary, low binary, high binary")


def ends_of_keys(chunks: DataFrame) -> DataFrame:
    """For each chunk's keys, the least and the greatest document that any chunk has seen them in."""
    keys = chunks.agg(F.sum("n")).first()[0] or 0
    bounds = equal_ranges(max(1, -(-keys // BUCKET_KEYS)))

    def send(row: dict):
        keys, low, high = unpack_sorted(row["keys"]), unpack(row["low"], np.int64), unpack(row["high"], np.int64)
        cut = cuts_of(bounds, keys)
        for b in np.flatnonzero(np.diff(cut)):
            part = slice(cut[b], cut[b + 1])
            yield int(b), (pack_sorted(keys[part]), pack(low[part]), pack(high[part]))

    def answer(bucket: int, slices: list[tuple[bytes, ...]]):
        keys = [unpack_sorted(s[0]) for s in slices]
        all_ = np.unique(np.concatenate(keys))
        low, high = np.full(len(all_), np.iinfo(np.int64).max), np.full(len(all_), np.iinfo(np.int64).min)
        places = [np.searchsorted(all_, k) for k in keys]
        for at, s in zip(places, slices, strict=True):  # a slice has a key once
            low[at] = np.minimum(low[at], unpack(s[1], np.int64))
            high[at] = np.maximum(high[at], unpack(s[2], np.int64))
        return [(pack(low[at]), pack(high[at])) for at in places], b"", len(all_)

    return exchange(chunks.select("chunk", "keys", "low", "high"), send, answer, 3, 2)


def repeated_runs(chunks: DataFrame, answers: DataFrame, run: int, gram: int) -> DataFrame:
    """Of each chunk the runs whose anchor more than one document has, hashed; documents that have none are left out."""

    def find(row: dict, found: list[dict]) -> pa.Table:
        chunk = Chunk(row)
        keys = unpack_sorted(row["keys"])
        more = joined(found, "a0", np.int64) < joined(found, "a1", np.int64)
        starts, doc, anchors, hashes = rolled(chunk.documents, chunk.ids, run, gram)
        keep = more[np.searchsorted(keys, anchors)] if len(keys) else np.zeros(0, bool)
        doc, hashes, starts = doc[keep], hashes[keep], starts[keep]
        sizes = np.array([len(d) for d in chunk.documents], np.int64)
        within = starts - (np.cumsum(sizes) - sizes)[doc]
        distinct, low, high = keyed(hashes, np.array([i or 0 for i in chunk.ids], np.int64)[doc])
        used = np.unique(doc)
        texts = [b" ".join(chunk.documents[i]) for i in used]
        data = [zstandard.ZstdCompressor(level=3).compress(b"\n".join(texts)), pack(used.astype(np.uint32)), pack(np.array([chunk.ids[i] for i in used], np.int64)), pack(np.searchsorted(used, doc).astype(np.uint32)), pack(within.astype(np.uint32)), pack(np.searchsorted(distinct, hashes).astype(np.uint32)), pack_sorted(distinct), pack(low), pack(high)]
        n = 1 if len(doc) else 0
        return pa.table([pa.array([row["chunk"]] * n, pa.string()), pa.array([len(distinct)] * n, pa.int64()), *(pa.array([d] * n, pa.binary()) for d in data)], names=["chunk", "n", "texts", "used", "ids", "doc", "start", "place", "keys", "low", "high"])

    return with_answers(chunks, answers, find, "chunk string, n long, " + ", ".join(f"{c} binary" for c in ("texts", "used", "ids", "doc", "start", "place", "keys", "low", "high")))


def passages(runs: DataFrame, answers: DataFrame, run: int) -> DataFrame:
    """Stretches of words with the same first document: those of the document itself (asks null) are the reference; those of
    later ones ask. Equal stretches of a chunk are one row, with all places (document, first word, id) packed."""

    def find(row: dict, found: list[dict]) -> pa.Table:
        low, high = joined(found, "a0", np.int64), joined(found, "a1", np.int64)
        documents = [t.split() for t in zstandard.ZstdDecompressor().decompress(row["texts"]).split(b"\n")]
        used, ids = unpack(row["used"], np.uint32), unpack(row["ids"], np.int64)
        doc, start, place = unpack(row["doc"], np.uint32).astype(np.int64), unpack(row["start"], np.uint32).astype(np.int64), unpack(row["place"], np.uint32)
        first = low[place]
        keep = first < high[place]
        doc, start, first = doc[keep], start[keep], first[keep]
        breaks = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + 1) | (first[1:] != first[:-1])])) if len(doc) else np.empty(0, np.int64)
        refs: dict[tuple, None] = {}
        asks: dict[tuple, list] = {}
        for a, b in zip(breaks, np.append(breaks[1:], len(doc)), strict=True):
            d, s = int(doc[a]), int(start[a])
            text, key = b" ".join(documents[d][s : s + int(b - a) + run - 1]), int(first[a])
            if ids[d] == key:
                refs[key, text] = None
            else:
                asks.setdefault((key, text), []).append((int(used[d]), s, int(ids[d])))
        rows = [(key, text, None) for key, text in refs] + [(key, text, pack(np.array(places, np.int64).ravel())) for (key, text), places in asks.items()]
        return pa.table([pa.array([row["chunk"]] * len(rows), pa.string()), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1].count(b" ") + 1 for r in rows], pa.int64()), pa.array([zstandard.ZstdCompressor(level=1).compress(r[1]) for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())], names=["chunk", "first", "n_words", "text", "asks"])

    return with_answers(runs, answers, find, "chunk string, first long, n_words long, text binary, asks binary")


def removed_spans(stretches: DataFrame, run: int) -> DataFrame:
    """(chunk, spans): of each chunk, the spans (document, first word, end) that the shards' automata find in earlier documents."""
    reference = F.col("asks").isNull()
    words = stretches.filter(reference).agg(F.sum("n_words")).first()[0] or 0
    shards = max(1, -(-words // SHARD_WORDS))
    dealt = stretches.withColumn("shard", F.pmod(F.xxhash64("first"), F.lit(shards)))
    copies = dealt.filter(~reference).groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / F.lit(SHARD_ASKS)).cast("int").alias("copies"))
    dealt = dealt.join(copies, "shard")
    of = F.when(reference, F.sequence(F.lit(0), F.col("copies") - 1)).otherwise(F.array(F.pmod(F.xxhash64("chunk", "text"), F.col("copies")).cast("int")))
    dealt = dealt.withColumn("copy", F.explode(of)).select("shard", "copy", "chunk", "first", "text", "asks").repartition("shard", "copy")

    def walk(group: pa.Table) -> pa.Table:
        number: dict[bytes, int] = {}
        automaton, unzip = Automaton(), zstandard.ZstdDecompressor()
        wanted: list[int] = []
        firsts, texts, asked, names = (group.column(c).to_pylist() for c in ("first", "text", "asks", "chunk"))
        for i, data in enumerate(asked):
            if data is None:
                automaton.add([number.setdefault(w, len(number)) for w in unzip.decompress(texts[i]).split(b" ")], firsts[i])
            else:
                wanted.append(i)
        automaton.settle()
        chunks, spans = [], []
        for i in wanted:
            hits = list(automaton.earlier([number.get(w, -1) for w in unzip.decompress(texts[i]).split(b" ")], run))
            found = []
            for doc, start, owner in unpack(asked[i], np.int64).reshape(-1, 3).tolist():
                end = -1
                for at, first in hits:
                    if first < owner:
                        if at - run + 1 <= end:
                            found[-1][2] = start + at + 1
                        else:
                            found.append([doc, start + at - run + 1, start + at + 1])
                        end = at + 1
            if found:
                chunks.append(names[i])
                spans.append(pack(np.array(found, np.int64).ravel()))
        release()
        return pa.table([pa.array(chunks, pa.string()), pa.array(spans, pa.binary())], names=["chunk", "spans"])

    return dealt.groupBy("shard", "copy").applyInArrow(walk, "chunk string, spans binary")


def kept_texts(chunks: DataFrame, spans: DataFrame) -> DataFrame:
    """(id, n_words, n_removed, kept): the words left, joined by one space."""

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        chunk = Chunk(left.to_pylist()[0])
        marks: dict[int, list] = {}
        for data in right.column("spans").to_pylist():
            for doc, start, end in unpack(data, np.int64).reshape(-1, 3).tolist():
                marks.setdefault(doc, []).append((start, end))
        removed, kept = [], []
        for i, words in enumerate(chunk.documents):
            if i in marks:
                stay = np.ones(len(words), bool)
                for start, end in marks[i]:
                    stay[start:end] = False
                removed.append(int((~stay).sum()))
                kept.append(b" ".join([words[k] for k in np.flatnonzero(stay)]))
            else:
                removed.append(0)
                kept.append(b" ".join(words))
        out = pa.table([pa.array(chunk.ids, pa.int64()), pa.array([len(w) for w in chunk.documents], pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], names=["id", "n_words", "n_removed", "kept"])
        release()
        return out

    return chunks.select("chunk", "ids", "texts", "lengths").groupBy("chunk").cogroup(spans.groupBy("chunk")).applyInArrow(cut, "id long, n_words long, n_removed long, kept string")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: int = 50) -> DataFrame:
    """(id, n_words, n_removed, kept) for every document: words covered by a run of `run` words that also starts in a document
    with a smaller id are removed; runs are judged on the input. kept has the other words, joined by one space.

    Words are what stands between \\x20 and \\x09-\\x0D, unchanged. Null text has no words. Rows with a null id are kept whole
    and are nobody's reference; rows that share an id, which is not smaller than itself, don't remove one another's words.
    Texts shorter than `run` words are kept whole. An empty table gives an empty result. Other columns play no part.

    What is exchanged: an anchor for about one word in thirteen, the hashes of runs that look repeated, the repeated
    passages once a chunk, and the compressed texts to meet the answers. A passage that a third of all documents have is one entry
    a chunk, and its shard is copied to as many tasks as the chunks that ask need. An automaton's size is bounded by SHARD_WORDS and one document's passages.
    """
    if run < 2:
        raise ValueError("run must be 2 or more")
    spark, gram = docs.sparkSession, (run + 1) // 2
    work = Work(spark, "repeats", python=False)
    with batches_of(spark, 256):
        chunks = work.save("chunks", chunked(docs, id_col, text_col, run, gram))
    with batches_of(spark, 16):
        anchors = work.save("anchors", ends_of_keys(chunks))
        runs = work.save("runs", repeated_runs(chunks, anchors, run, gram))
        work.drop("anchors")
        stretches = work.save("passages", passages(runs, work.save("ends", ends_of_keys(runs)), run))
        work.drop("runs", "ends")
    with batches_of(spark, 256):
        spans = work.save("spans", removed_spans(stretches, run))
        work.drop("passages")
    return kept_texts(chunks, spans)
