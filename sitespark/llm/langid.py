"""Language identification by cross-parsing against suffix automata of labelled text."""

from __future__ import annotations

import gc
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import release, small_batches


class SuffixAutomaton:
    """All substrings of a text. A state is the dictionary of its transitions, so that a parse is one look-up a character."""

    def __init__(self, text: str):
        self.root: dict[str, dict] = {}
        states, link, length, number = [self.root], [-1], [0], {id(self.root): 0}
        last = 0
        for c in text:
            cur = len(states)
            states.append({})
            number[id(states[cur])] = cur
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in states[p]:
                states[p][c] = states[cur]
                p = link[p]
            if p >= 0:
                q = number[id(states[p][c])]
                if length[q] == length[p] + 1:
                    link[cur] = q
                else:
                    new = len(states)
                    states.append(dict(states[q]))
                    number[id(states[new])] = new
                    length.append(length[p] + 1)
                    link.append(link[q])
                    link[q] = link[cur] = new
                    old = states[q]
                    while p >= 0 and states[p].get(c) is old:
                        states[p][c] = states[new]
                        p = link[p]
            last = cur
        self._states = states

    def states(self) -> list[dict]:
        return self._states

    def phrases(self, text) -> int:
        """Phrases of the greedy parse: each the longest match from where the one before ended, or one unknown character."""
        root = state = self.root
        count = 0
        for c in text:
            to = state.get(c)
            if to is None:
                if state is not root:
                    count += 1
                to = root.get(c)
                if to is None:
                    count += 1
                    to = root
            state = to
        return count + (state is not root)


class Alphabet:
    """Codes of characters: 0 for all that isn't a letter, then those of the model, then one for all other letters."""

    letter: np.ndarray | None = None

    def __init__(self, model: dict[str, str]):
        if Alphabet.letter is None:
            Alphabet.letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
        known = sorted({c for text in model.values() for c in text} - {" "})
        self.code_of = {" ": 0} | {c: k for k, c in enumerate(known, 1)}
        self.size = len(known) + 2
        self.table = np.where(Alphabet.letter, len(known) + 1, 0).astype(np.uint16 if self.size > 255 else np.uint8)
        for c, k in self.code_of.items():
            self.table[ord(c)] = k

    def codes(self, text: str) -> np.ndarray:
        """Of the text in lower case, with one 0 for each stretch without letters, and at both ends; empty without a letter."""
        raw = self.table[np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)]
        keep = raw > 0
        if not keep.any():
            return raw[:0]
        keep[1:] |= raw[:-1] > 0
        keep[0] = True
        out = raw[keep]
        return out[1:] if len(out) > 1 and not out[0] and not out[1] else out


def letters_of(text: str) -> str:
    """The text in lower case, with one space for each stretch without letters, and at both ends; empty without a letter."""
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    return f" {' '.join(words)} " if words else ""


class Parser:
    """Parses many texts against the automata of all languages at once, a character of every text in each step.

    The automata are one table: for a state and a character the next state and how many phrases end, 0 to 2. Texts are
    taken in groups, the longest first, so that those still running are the first ones. Where the table would be too large
    (many languages or characters) the automata are walked one by one.
    """

    def __init__(self, model: dict[str, str], most_cells: int = 1 << 25):
        self.langs = sorted(model)
        self.alphabet = Alphabet(model)
        self.automata = [SuffixAutomaton(model[x]) for x in self.langs]
        self.chars = {k: c for c, k in self.alphabet.code_of.items()}
        states = [a.states() for a in self.automata]
        k = self.alphabet.size
        self.cells = None
        if sum(map(len, states)) * k > most_cells:
            return
        cells, base, self.roots = [], 0, []
        for found in states:
            row = {id(s): base + i * k for i, s in enumerate(found)}
            root = np.full(k, base << 2 | 1, np.int32)  # an unknown character is a phrase
            for c, to in found[0].items():
                root[self.alphabet.code_of[c]] = row[id(to)] << 2
            table = np.tile(root + 1, (len(found), 1))  # a phrase ends, and the next one starts with this character
            table[0] = root
            for i, s in enumerate(found[1:], 1):
                for c, to in s.items():
                    table[i, self.alphabet.code_of[c]] = row[id(to)] << 2
            cells.append(table.ravel())
            self.roots.append(base)
            base += table.size
        self.cells = np.concatenate(cells) if cells else np.empty(0, np.int32)
        self.automata = []

    def phrases(self, texts: list[np.ndarray], least_lanes: int = 12) -> np.ndarray:
        """Phrases of each text (codes of Alphabet) in each language."""
        out = np.zeros((len(texts), len(self.langs)), np.int64)
        if self.cells is None:
            for i, t in enumerate(texts):
                out[i] = [a.phrases([self.chars.get(c) for c in t.tolist()]) for a in self.automata]
            return out
        lengths = np.array([len(t) for t in texts], np.int64)
        order = np.argsort(-lengths, kind="stable")
        lengths = lengths[order]
        n = int((lengths > 0).sum())
        if not n:
            return out
        codes = np.concatenate([texts[i] for i in order])
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        roots = np.array(self.roots, np.int32)[:, None]
        state = np.repeat(roots << 2, len(texts), 1)
        count = np.zeros(state.shape, np.int64)
        cells, t = self.cells, 0
        while n >= least_lanes:
            steps = min(int(lengths[n - 1]) - t, 256)
            block = codes[(starts[:n] + t)[:, None] + np.arange(steps)].T.astype(np.int32, order="C")
            live, total, ended = state[:, :n].copy(), np.zeros((len(roots), n), np.int32), np.empty((len(roots), n), np.int32)
            for column in block:
                live >>= 2
                live += column
                cells.take(live, out=live, mode="clip")
                np.bitwise_and(live, 3, out=ended)
                total += ended
            state[:, :n] = live
            count[:, :n] += total
            t += steps
            n = int((lengths > t).sum())
        for i in range(n):  # few texts are left: each by itself
            rest = codes[starts[i] + t : starts[i] + lengths[i]].tolist()
            for j in range(len(roots)):
                v, c, get = int(state[j, i]), 0, cells.item
                for x in rest:
                    v = get((v >> 2) + x)
                    c += v & 3
                state[j, i] = v
                count[j, i] += c
        out[order] = (count + (state >> 2 != roots)).T
        return out


def bounded_sample(rows: DataFrame, key: str, by: list[str], most: int, most_keys: int | None = None) -> DataFrame:
    """At most `most` rows for each value of key, or of the most_keys commonest ones: those with the least hash of the
    columns `by`. Rows that agree in these count once, so repeats can't crowd others out.

    One aggregation counts the distinct hashes of each key (approximately); rows with hashes beyond one and a half times
    the share wanted don't leave the scan, repeats of the others collapse in the map tasks, and ranks do the rest. _u is a row's
    hash, _rate the share of its key's distinct rows that are taken.
    """
    unit = F.coalesce(F.xxhash64(F.lit("sample"), *by).bitwiseAND(F.lit((1 << 52) - 1)), F.lit(0)).cast("double") / float(1 << 52)
    rows = rows.withColumn("_u", unit)
    counts = rows.groupBy(key).agg(F.approx_count_distinct("_u", 0.01).alias("n")).orderBy(F.desc("n"), key)
    counts = (counts if most_keys is None else counts.limit(most_keys)).collect()
    if not counts:
        return rows.limit(0).withColumn("_rate", F.lit(0.0))
    rates = F.create_map(*[F.lit(x) for r in counts for x in (r[key], min(1.0, most / r["n"]))])
    near = rows.withColumn("_rate", F.coalesce(F.element_at(rates, F.col(key)), F.lit(0.0))).filter((F.col("_u") < 1.5 * F.col("_rate") + 1e-6) & (F.col("_rate") > 0))
    rank = F.row_number().over(Window.partitionBy(key).orderBy("_u"))
    return near.dropDuplicates([key, "_u"]).withColumn("_k", rank).filter(F.col("_k") <= most).drop("_k")


def fit_languages(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", sample_docs: int = 60, model_chars: int = 30_000) -> dict[str, str]:
    """Labelled text for each language: a sample of at most sample_docs labelled documents, taken by hash
    of id and text, is what the driver receives; whole ones are joined in the order of that hash up to model_chars
    characters, and those that don't fit are passed over (the first is cut where none fits).

    Every language is learnt. No labelled row gives an empty model.
    """
    rows = labelled.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    rows = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.col(id_col).alias("id"))
    seen: dict[str, list[str]] = {}
    for lang, text in sorted(map(tuple, bounded_sample(rows, "lang", ["id", "text"], sample_docs).orderBy("_u", "text").select("lang", "text").collect()), key=lambda r: r[0]):
        seen.setdefault(lang, []).append(text)
    model = {}
    for lang, sample in seen.items():
        whole = [t for t in dict.fromkeys(map(letters_of, sample)) if t]
        text = ""
        for t in whole:
            if len(text) + len(t) <= model_chars:
                text = text[:-1] + t
        if whole:
            model[lang] = text or whole[0][:model_chars]
    return model


def languages_of(model: dict[str, str], spark, group_chars: int = 4_000_000):
    """A function of a text column: struct (lang_pred, score, entropy). Only the text goes to Python; a task holds
    group_chars characters at a time, and the text that exceeds them."""
    langs = sorted(model)
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        parser = Parser(shared.value)
        bits = np.array([math.log2(2 + len(shared.value[x])) for x in langs])

        def answer(group: list[list[np.ndarray]]) -> Iterator[pa.Array]:
            counts = parser.phrases([t for batch in group for t in batch])
            at = 0
            for batch in group:
                out = []
                for t, n in zip(batch, counts[at : at + len(batch)], strict=True):
                    if not len(t) or not langs:
                        out.append(("und", 0.0, None))
                        continue
                    h = n * bits / len(t)
                    best, *rest = np.argsort(h, kind="stable").tolist()
                    out.append((langs[best], float(1 - h[best] / h[rest[0]]) if rest else 1.0, float(h[best])))
                at += len(batch)
                pred, score, entropy = zip(*out, strict=True) if out else ((), (), ())
                yield pa.StructArray.from_arrays([pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(entropy, pa.float64())], ["lang_pred", "score", "entropy"])

        group, size = [], 0
        for batch in batches:
            group.append([parser.alphabet.codes(t or "") for t in batch.to_pylist()])
            size += sum(map(len, group[-1]))
            if size > group_chars:
                yield from answer(group)
                group, size = [], 0
        yield from answer(group)
        del parser
        gc.collect()  # the states refer to each other
        release()

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "struct<lang_pred string, score double, entropy double>")


def identify_languages(docs: DataFrame, model: dict[str, str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred, score, entropy of every whole text.

    Cross-parsing: a text, in lower case with a space for all that isn't a letter, is cut greedily into the longest
    phrases that the language's labelled text has. The entropy under a language is phrases * log2(model characters) /
    characters; the least wins, ties to the language that sorts first. score = 1 - least / second least, from 0 to 1 (1 if
    there is one language only). Null text or one without a letter: und, score 0, entropy null; so is all if the model is
    empty. Time is linear in the text for each language. No shuffle; the broadcast model is bounded by model_chars for each
    language. Repeated rows and null ids are kept; other columns are ignored.
    """
    found = languages_of(model, docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), found(F.col(text_col).cast("string")).alias("found"))
    return rows.select(F.col("id").alias(id_col), "found.*")


def keep_identified(docs: DataFrame, model: dict[str, str], text_col: str = "text", min_score: float = 0.0) -> DataFrame:
    """The rows of docs, all columns, that are in some language of the model; texts without a letter are rejected, and so
    is a score under min_score. Equal to a filter on identify_languages, without a join back; other columns stay in the JVM."""
    found = languages_of(model, docs.sparkSession)(F.col(text_col).cast("string"))
    return docs.filter((found.getField("lang_pred") != "und") & (found.getField("score") >= min_score))


def learns(id_col: str, folds: int, held: int) -> Column:
    """True for rows outside the held-out fold: crc32(id as text) mod folds is not held. A null id counts as text ''."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds != held
