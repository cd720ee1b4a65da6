"""Language-model scoring by Katz backoff over words."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .chunks import BUCKET_TOKENS, Slices, cuts_of, equal_ranges, exchange, joined, tokenised, with_answers
from .common import Work, mix, pack, pack_sorted, shuffle_partitions, unpack, unpack_sorted

#: The hash that stands for the end of a text; words are hashed elsewhere.
END = np.uint64(0x13198A2E03707344)
#: The number of the start of a text, which is a context only; words have numbers from 1.
START = 0
#: Counts up to this one are discounted.
LIMIT = 5
#: Totals that histograms tell apart.
COUNTED = LIMIT + 2
#: A context that occurs more often than this is dealt to several buckets.
HOT_CONTEXT = BUCKET_TOKENS // 8


def discounts(n: np.ndarray) -> np.ndarray:
    """What is left of a count of 0 to LIMIT, as a factor; n[r] is how many n-grams occur r times.

    Good-Turing after Katz. Where the counts of counts give no factor between 0 and 1 (small or odd data), a half of an
    occurrence is taken off instead.
    """
    d = np.ones(LIMIT + 1)
    top = (LIMIT + 1) * n[LIMIT + 1] / n[1] if n[1] else 0.0
    for r in range(1, LIMIT + 1):
        got = (((r + 1) * n[r + 1] / n[r]) / r - top) / (1 - top) if n[r] and top < 1 else 0.0
        d[r] = got if 0 < got < 1 else (r - 0.5) / r
    return d


def _seen(counts: np.ndarray, d: np.ndarray) -> np.ndarray:
    return counts * d[np.where(counts <= LIMIT, counts, 0)]


class Model:
    """What all chunks share: the numbers of tokens and of distinct ones, and the discounts of both orders."""

    def __init__(self, n: int, v: int, d1: np.ndarray, d2: np.ndarray, left: float, ones: bool):
        self.n, self.v, self.d1, self.d2, self.left, self.ones = n, v, d1, d2, left, ones

    def unigram(self, c: np.ndarray) -> np.ndarray:
        """Discounted for known words; what is left goes to the one unknown word, as backing off to the uniform
        distribution over the known words and it, normalised over what isn't known, gives it."""
        total = self.n + self.ones
        return np.where(c > 0, _seen(c, self.d1) / max(total, 1), self.left)


    def backoff(self, seen: np.ndarray, rest: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 of the contexts' backoff weights, and `cold`: contexts whose counts leave nothing, which are divided by
        one more occurrence. seen[r - 1] is how many bigrams of each context occur r times, rest the occurrences of those
        that occur more often, lower what the unigrams give to all of them. A context never learned has weight 1."""
        r = np.arange(1, LIMIT + 1)[:, None]
        whole = (seen * r).sum(0) + rest
        mass = (seen * r * self.d2[1:, None]).sum(0) + rest
        cold = (whole > 0) & (whole - mass <= 1e-9 * whole)
        left = np.where(cold, 1.0, whole - mass) / np.maximum(whole + cold, 1)
        return np.where(whole > 0, np.log10(np.where(whole > 0, left / np.maximum(1 - lower, self.left), 1)), 0.0), cold


def _histogram(totals: np.ndarray) -> bytes:
    """How many n-grams have a total of 0 to COUNTED - 1 or more, and the sums of their totals."""
    capped = np.minimum(totals, COUNTED)
    return pack(np.concatenate([np.bincount(capped, minlength=COUNTED + 1), np.bincount(capped, totals, COUNTED + 1).astype(np.int64)]))


def _histograms(answers: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """The buckets' histograms summed, and the largest number of n-grams of a bucket; one row reaches the driver for each
    total."""

    def run(batches):
        for batch in batches:
            rows = []
            for data, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ngrams, tokens = unpack(data, np.int64).reshape(2, -1)
                rows += [(r, int(k), int(t), size) for r, (k, t) in enumerate(zip(ngrams, tokens, strict=True))]
            columns = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["count", "ngrams", "tokens", "size"])

    found = answers.filter("chunk = ''").select("a0", "size").mapInArrow(run, "count long, ngrams long, tokens long, size long")
    ngrams, tokens, size = np.zeros(COUNTED + 1, np.int64), np.zeros(COUNTED + 1, np.int64), 0
    for r, k, t, most in found.groupBy("count").agg(F.sum("ngrams"), F.sum("tokens"), F.max("size")).collect():
        ngrams[r], tokens[r], size = k, t, max(size, most)
    return ngrams, tokens, size


def _unigrams(ngrams: np.ndarray, tokens: np.ndarray) -> Model:
    total, kinds = int(tokens.sum()), int(ngrams[1:].sum())
    d1 = discounts(ngrams)
    kept = tokens[LIMIT + 1 :].sum() + sum(r * ngrams[r] * d1[r] for r in range(1, LIMIT + 1))
    ones = kept >= total  # nothing is left: as if one more token had been seen
    return Model(total, kinds, d1, np.ones(LIMIT + 1), float(1 - kept / (total + ones)) if total else 1.0, bool(ones))


def _words_of(row: dict) -> np.ndarray:
    """The chunk's distinct tokens: its vocabulary, and the end of a text in the last place."""
    return np.append(unpack_sorted(row["vocabulary"]), END)


def _ask_words(buckets: int) -> Callable[[dict], Slices]:
    bounds = equal_ranges(buckets)

    def send(row: dict) -> Slices:
        words = _words_of(row)
        lengths = unpack(row["lengths"], np.uint32)
        learned = np.asarray(row["flags"], bool)
        counts = np.bincount(unpack(row["places"], np.uint32), np.repeat(learned, lengths), len(words))
        counts[-1] = learned.sum()
        order = np.argsort(words)
        words, counts = words[order], counts[order].astype(np.uint32)
        cuts = cuts_of(bounds, words)
        for b, (i, j) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if j > i:
                yield b, (pack_sorted(words[i:j]), pack(counts[i:j]))

    return send


def _count_words(buckets: int):
    """Totals of a bucket's words, and a number for each: their places, counted through all buckets."""

    def answer(bucket: int, slices: list) -> tuple[list, bytes, int]:
        parts = [unpack_sorted(s[0]) for s in slices]
        words, at = np.unique(np.concatenate(parts), return_inverse=True)
        totals = np.bincount(at, np.concatenate([unpack(s[1], np.uint32) for s in slices]), len(words)).astype(np.int64)
        cut = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        numbers = at.astype(np.uint64) * np.uint64(buckets) + np.uint64(bucket + 1)
        return [(pack(totals[at[i:j]]), pack_sorted(numbers[i:j])) for i, j in zip(cut[:-1], cut[1:], strict=True)], _histogram(totals), len(words)

    return answer


def _numbered(row: dict, answers: list[dict]) -> pa.Table:
    """The chunk with its words' numbers and totals instead of their hashes, in the order of its vocabulary and the end."""
    order = np.argsort(_words_of(row))
    totals, numbers = np.empty(len(order), np.int64), np.empty(len(order), np.uint64)
    totals[order] = joined(answers, "a0", np.int64)  # fails if there are fewer answers than words
    numbers[order] = np.concatenate([unpack_sorted(r["a1"]) for r in answers])
    columns = {**{c: [row[c]] for c in ("chunk", "ids", "flags", "lengths", "places")}, "numbers": [pack(numbers)], "totals": [pack(totals)]}
    return pa.table({c: pa.array(v, t) for (c, v), t in zip(columns.items(), (pa.string(), pa.list_(pa.int64()), pa.list_(pa.bool_()), *[pa.binary()] * 4), strict=True)})


NUMBERED = "chunk string, ids array<long>, flags array<boolean>, lengths binary, places binary, numbers binary, totals binary"


class Bigrams:
    """The distinct bigrams of a numbered chunk, in the order in which they are dealt to buckets.

    A bigram's key is number(context) * span + number(token): exact while the corpus has fewer than 2^32 distinct words, a
    64-bit hash of the pair beyond. Keys of a context lie together, in one bucket or, for a frequent context, in several; the
    chunk asks each of these with a key that no bigram has, so that it hears from all of them.
    """

    def __init__(self, row: dict, span: int, buckets: int, hot: int):
        self.ids, self.flags = row["ids"], np.asarray(row["flags"], bool)
        self.totals = unpack(row["totals"], np.int64)
        numbers = np.append(unpack(row["numbers"], np.uint64), np.uint64(START))
        end, start = len(numbers) - 2, len(numbers) - 1
        lengths = unpack(row["lengths"], np.uint32).astype(np.int64) + 1
        ends = np.cumsum(lengths) - 1
        inner = np.ones(int(lengths.sum()), bool)
        inner[ends] = False
        self.tokens = np.full(len(inner), end, np.int64)
        self.tokens[inner] = unpack(row["places"], np.uint32)
        before = np.empty_like(self.tokens)
        before[1:] = self.tokens[:-1]
        before[ends - lengths + 1] = start
        self.doc = np.repeat(np.arange(len(lengths)), lengths)
        pairs, at = np.unique(before * len(numbers) + self.tokens, return_inverse=True)
        contexts, words = pairs // len(numbers), pairs % len(numbers)
        #: how often each context was learned; every learned word has a token after it, and each text a start and an end
        self.followed = np.append(self.totals, self.totals[end])
        splits = np.minimum(self.followed // hot + 1, buckets)
        spread = mix(numbers[words]) % splits[contexts].astype(np.uint64)
        wide = np.flatnonzero((splits > 1) & (np.bincount(contexts, minlength=len(splits)) > 0))
        asked = np.repeat(wide, splits[wide])
        spread = np.concatenate([spread, (np.arange(len(asked)) - np.repeat(np.cumsum(splits[wide]) - splits[wide], splits[wide])).astype(np.uint64)])
        contexts, words = np.concatenate([contexts, asked]), np.concatenate([words, np.full(len(asked), start)])
        none = words == start  # never a token
        with np.errstate(over="ignore"):
            keys = numbers[contexts] * np.uint64(span) + np.where(none, np.uint64(span - 1), numbers[words])
            bucket = ((mix(numbers[contexts]) + spread) % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((keys, bucket))
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        self.at, self.keys, self.contexts, self.words = place[at], keys[order], contexts[order], words[order]
        bucket = bucket[order]
        self.cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]]) if len(bucket) else np.zeros(1, int)
        self.buckets = bucket[self.cuts[:-1]] if len(bucket) else bucket
        self.none = none[order]
        #: a context's first key in each bucket
        self.firsts = np.flatnonzero(np.concatenate([[True], (np.diff(self.contexts) != 0) | (np.diff(bucket) != 0)])) if len(bucket) else np.empty(0, int)


def _ask_bigrams(span: int, buckets: int, hot: int) -> Callable[[dict], Slices]:
    def send(row: dict) -> Slices:
        b = Bigrams(row, span, buckets, hot)
        counts = np.bincount(b.at, b.flags[b.doc], len(b.keys)).astype(np.uint32)
        totals = np.where(counts > 0, np.append(b.totals, 0)[b.words], 0)  # those who learned a bigram say how often its token occurs
        for bucket, i, j in zip(b.buckets.tolist(), b.cuts[:-1], b.cuts[1:], strict=True):
            yield bucket, (pack_sorted(b.keys[i:j]), pack(counts[i:j]), pack(totals[i:j]))

    return send


def _count_bigrams(model: Model, span: int):
    """Totals of a bucket's bigrams; for each context of a slice whether all of its bigrams here occur more than LIMIT times;
    and for those with a bigram that wasn't learned, so that the chunk has to back off, what Model.backoff needs of this
    bucket."""

    def answer(bucket: int, slices: list) -> tuple[list, bytes, int]:
        parts = [unpack_sorted(s[0]) for s in slices]
        keys, at = np.unique(np.concatenate(parts), return_inverse=True)
        counts = np.concatenate([unpack(s[1], np.uint32) for s in slices])
        totals = np.bincount(at, counts, len(keys)).astype(np.int64)
        word = np.zeros(len(keys), np.int64)
        told = counts > 0
        word[at[told]] = np.concatenate([unpack(s[2], np.int64) for s in slices])[told]
        _, context = np.unique(keys // np.uint64(span), return_inverse=True)
        n = int(context[-1]) + 1
        seen = np.stack([np.bincount(context, totals == r, n) for r in range(1, LIMIT + 1)]).astype(np.int64)
        rest = np.bincount(context, np.where(totals > LIMIT, totals, 0), n).astype(np.int64)
        lower = np.bincount(context, np.where(totals > 0, model.unigram(word), 0.0), n)
        out, cut = [], np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        for i, j in zip(cut[:-1], cut[1:], strict=True):
            mine = at[i:j]
            first = np.flatnonzero(np.concatenate([[True], np.diff(context[mine]) != 0]))
            own = context[mine[first]]
            asked = own[np.logical_or.reduceat(totals[mine] == 0, first)]
            often = seen[:, own].sum(0) == 0
            out.append((pack(totals[mine]), pack(np.packbits(often)), pack(np.concatenate([seen[:, asked].ravel(), rest[asked]])), pack(lower[asked])))
        return out, _histogram(totals), len(keys)

    return answer


def _score(model: Model, span: int, buckets: int, hot: int):
    def run(row: dict, answers: list[dict]) -> pa.Table:
        b = Bigrams(row, span, buckets, hot)
        totals = joined(answers, "a0", np.int64)
        assert len(totals) == len(b.keys), "a chunk got another number of answers than it asked for"
        n = len(b.followed)
        owner = b.contexts[b.firsts]  # what several buckets say of a context is summed
        sizes = np.diff(np.searchsorted(b.firsts, b.cuts))
        often = np.concatenate([np.unpackbits(unpack(r["a1"], np.uint8), count=k) for r, k in zip(answers, sizes, strict=True)] or [np.empty(0, np.uint8)])
        rare = np.bincount(owner, often == 0, n) > 0
        asked = owner[np.logical_or.reduceat(totals == 0, b.firsts)] if len(owner) else owner
        parts = [unpack(r["a2"], np.int64).reshape(LIMIT + 1, -1) for r in answers]
        told = np.concatenate(parts, 1) if parts else np.zeros((LIMIT + 1, 0), np.int64)
        told = np.stack([np.bincount(asked, x, n) for x in told])
        weight = model.backoff(told[:LIMIT], told[LIMIT], np.bincount(asked, joined(answers, "a3", np.float64), n))[0]
        cold = ~rare & (b.followed > 0)  # all that follows occurs too often to be discounted
        seen = _seen(totals, model.d2)
        hit = np.log10(np.maximum(seen, 1e-300)) - np.log10(np.maximum(b.followed + cold, 1))[b.contexts]
        p1 = np.log10(model.unigram(b.totals))
        logs = np.where(totals > 0, hit, weight[b.contexts] + np.append(p1, 0.0)[b.words])[b.at]
        docs, count = len(b.ids), b.totals[b.tokens]
        base = np.log10((count + 1) / (model.n + model.v + 1))
        columns = [pa.array(b.ids, pa.int64()), pa.array(b.flags), pa.array(np.bincount(b.doc, minlength=docs)), pa.array(np.bincount(b.doc, count > 0, docs).astype(np.int64)), pa.array(np.full(docs, model.n)), pa.array(np.bincount(b.doc, base, docs)), pa.array(np.bincount(b.doc, logs, docs))]
        return pa.table(columns, names=["id", "learned", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


def score_texts(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", hot_context: int = HOT_CONTEXT) -> DataFrame:
    """id, learned, n_tokens, n_known, train_tokens, base_score, score of every whole text, learning from the rows where
    `learn` is true.

    Words are lower-cased (A-Z) and split at ASCII white space, and an end follows each text. score is the log10
    probability of the text under a bigram model with Katz backoff to unigrams and from them to the uniform distribution
    over the learned words and one unknown word. Counts up to LIMIT are discounted by Good-Turing; the backoff weight of a
    context is what its discounted bigrams leave, divided by what the lower order gives to words unseen in it, so the
    probabilities after any context sum to 1. base_score is the sum of add-one unigram log10 probabilities.

    Two exchanges (see chunks) count: the first words, which get a number and their count; the second bigrams, dealt by
    context, so that the bucket that counts a context's bigrams also sums what its backoff weight needs; frequent contexts
    are dealt to several buckets. Chunks meet the answers and evaluate the model token by token. Sizes that one task holds
    are bounded by BUCKET_TOKENS and the chunk's; the tables grow with the corpus. Null or empty text is one end token.
    Null and repeated ids are rows of their own; other columns are ignored; without learned rows every token is unknown
    and has probability 1; an empty table gives no rows.
    """
    spark = docs.sparkSession
    work = Work(spark, "katz")
    chunks = work.save("chunks", tokenised(docs, id_col, text_col, learn))
    n_tokens = chunks.agg(F.sum(F.col("n_tokens") + F.size("ids"))).first()[0] or 0
    buckets, big = max(shuffle_partitions(spark), -(-n_tokens // BUCKET_TOKENS)), n_tokens > BUCKET_TOKENS
    words = work.save("words", exchange(chunks, _ask_words(buckets), _count_words(buckets), 2, 2), free=big)
    ngrams, tokens, largest = _histograms(words)
    model, span = _unigrams(ngrams, tokens), buckets * (largest + 1) + 1
    numbered = work.save("numbered", with_answers(chunks, words, _numbered, NUMBERED), free=big)
    work.drop("chunks", "words")
    bigrams = work.save("bigrams", exchange(numbered, _ask_bigrams(span, buckets, hot_context), _count_bigrams(model, span), 3, 4), free=big)
    model.d2 = discounts(_histograms(bigrams)[0])
    if big:
        work.free()
    out = with_answers(numbered, bigrams, _score(model, span, buckets, hot_context), "id long, learned boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return out.withColumnRenamed("id", id_col)
