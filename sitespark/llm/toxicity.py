"""Toxicity by compression distance: zstandard dictionaries of toxic and ordinary text."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, release, small_batches, texts
from .langid import bounded_sample

WINDOW_BYTES = 192


def windows(text: bytes, size: int = WINDOW_BYTES) -> list[bytes]:
    """The whole text in windows of at most `size` bytes that end between words where they can."""
    out, at, n = [], 0, len(text)
    while at < n:
        end = at + size
        if end < n:
            cut = text.rfind(b" ", at + 1, end)
            end = cut if cut > at else end
        out.append(text[at:end])
        at = end
    return out


def plain(text: str) -> bytes:
    return b" " + " ".join(text.lower().split()).encode() + b" "


class Distance:
    """Bytes by which a window compresses better with the toxic dictionary than with the ordinary one."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        # matches of 6 bytes or more: shorter ones say little, as any text shares them
        how = zstandard.ZstdCompressionParameters.from_level(3, min_match=6, hash_log=16, chain_log=16, search_log=4, write_content_size=False, write_checksum=False, write_dict_id=False)
        self.compress = []
        for content in (ordinary, toxic):
            primed = zstandard.ZstdCompressionDict(content)  # it starts with a trained one, so it has entropy tables too
            primed.precompute_compress(compression_params=how)
            self.compress.append(zstandard.ZstdCompressor(dict_data=primed, compression_params=how).compress)

    def gains(self, text: str) -> np.ndarray:
        ordinary, toxic = self.compress
        return np.array([len(ordinary(w)) - len(toxic(w)) for w in windows(plain(text))], np.float64)


#: Gains in bytes that windows are counted from.
STEPS = (2, 3, 5)


def features(gains: np.ndarray) -> list[float]:
    """The best window's gain, the next two's, the logarithm of the number of windows, among which chance has its pick, the
    mean gain, the shares of windows that gain STEPS bytes, and all that windows gain beyond the first of them."""
    top = np.concatenate([np.sort(gains)[::-1], np.full(3, -5.0)])[:3]
    shares = [float((gains >= s).mean()) if len(gains) else 0.0 for s in STEPS]
    return [float(min(top[0], 12)), float(min(top[1] + top[2], 24)), float(np.log1p(len(gains))), float(gains.mean()) if len(gains) else 0.0, *shares, float(np.log1p(np.maximum(gains - STEPS[0], 0).sum()))]


def words_of(text: bytes) -> list[bytes]:
    return [w for w in (x.strip(b".,;:!?\"'()[]") for x in text.split()) if w]


def told_apart(texts: list[bytes], others: list[bytes], ratio: float) -> list[bytes]:
    """What is left of texts without the words that aren't `ratio` times as common among them as among the others."""
    own, other = (Counter(w for t in ts for w in set(words_of(t))) for ts in (texts, others))
    least = ratio * len(texts) / max(1, len(others))
    left = (b" ".join(w for w in words_of(t) if own[w] > least * (other[w] + 0.5)) for t in texts)
    return [b" " + t + b" " for t in left if t]


def trained(size: int, texts: list[bytes], **how) -> bytes:
    """A zstandard dictionary trained on the texts' windows; the end of the texts where they are too few to train on."""
    try:
        return zstandard.train_dictionary(size, [w for t in texts for w in windows(t)], level=3, **how).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(texts)[-size:]


def train(sample: list[tuple[str, int]], size: int = 24_576, own_size: int = 2048, ratio: float = 20.0) -> tuple[bytes, bytes]:
    """The ordinary and the toxic dictionary. Each is trained by zstandard on its own label's text, less the words that the
    other label has as well, and stands behind what both share, a dictionary trained on ordinary text as it is: so prose
    compresses alike with either, and only what tells the labels apart differs. A text counts once, however many copies the
    sample has."""
    kinds = [[plain(t) for t, y in dict.fromkeys(sample) if y == label] for label in (0, 1)]
    shared = trained(size, kinds[0])
    own = [trained(own_size, told_apart(kinds[k], kinds[1 - k], ratio), k=16, d=6) for k in (0, 1)]
    return shared + own[0], shared + own[1]


def calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> list[float]:
    """Weights of a logistic model, intercept first, by Newton's method with a small ridge. Each row counts `weight`
    times, once by default: 1 / its label's sampling rate makes the odds those of the rows that were sampled from."""
    weight = np.ones(len(x)) if weight is None else weight / weight.mean()  # the ridge weighs the same on any table
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * (p * (1 - p) + 1e-6))[:, None]).T @ x + 0.1 * np.eye(len(w)), x.T @ (weight * (y - p)) - 0.1 * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w.tolist()


def fit_toxicity(labelled: DataFrame, text_col: str = "text", label_col: str = "toxic", id_col: str = "doc_id", sample_docs: int = 1500, weight_col: str | None = None) -> dict:
    """Dictionaries and calibration from at most sample_docs labelled documents of each label, whole texts, taken
    by hash of id and text; this is what the driver receives. Two thirds train the dictionaries, and the
    thresholds are calibrated on the others, where each document stands for as many of its label as the sample left out:
    weight_col says how many rows a row of labelled stands for, 1 by default. Without documents of both labels every score is the share of toxic ones."""
    rows = labelled.filter(F.col(label_col).isNotNull()).select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), (F.col(label_col).cast("int") == 1).cast("int").alias("toxic"), F.col(id_col).alias("id"), (F.col(weight_col) if weight_col else F.lit(1.0)).alias("weight"))
    taken = sorted((hash_of(t), t, y) for t, y in map(tuple, bounded_sample(rows, "toxic", ["id", "text"], sample_docs, 2).select("text", "toxic").collect()))
    sample = [(t, y) for _, t, y in taken]
    toxic = sum(y for _, y in sample)
    if not 0 < toxic < len(sample):
        return {"ordinary": b"", "toxic": b"", "weights": [], "share": toxic / len(sample) if sample else 0.0}
    stand_for = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.sum("weight").alias("n")).collect()}
    weight = np.array([stand_for[0] / (len(sample) - toxic), stand_for[1] / toxic])
    cut = -(-2 * len(sample) // 3)
    ordinary, told = train(sample[:cut])
    distance = Distance(ordinary, told)
    x, y = np.array([features(distance.gains(t)) for t, _ in sample[cut:]]), np.array([float(y) for _, y in sample[cut:]])
    return {"ordinary": ordinary, "toxic": told, "weights": calibrate(x, y, weight[y.astype(int)]) if len(x) else [], "share": toxic / len(sample)}


def labelled_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic", text_col: str = "text", sample_docs: int = 1500) -> DataFrame:
    """id, text, label, weight of a bounded sample of the labels: at most sample_docs ids of each label, taken by hash of the id
    before the join, so that it can be broadcast and texts aren't shuffled; an id that is labelled twice counts once for
    each label. weight is 1 / the label's sampling rate."""
    told = labels.filter(F.col(label_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(label_col))
    told = bounded_sample(told, label_col, ["_id"], sample_docs, 2).select("_id", label_col, (1 / F.col("_rate")).alias("weight"))
    return docs.select(id_col, text_col).join(F.broadcast(told), F.col(id_col) == F.col("_id")).select(id_col, text_col, label_col, "weight")


def hash_of(text: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(text.encode())


def score_toxicity(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score (0 to 1), predicted (1 from 0.5 on), gain (the best window's, in bytes) of every whole text.

    No shuffle; the broadcast model is two dictionaries of at most 30 KB each. Null and empty texts have gain 0 and the score
    that goes with it; repeated rows and null ids are kept; other columns are ignored.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        distance = Distance(m["ordinary"], m["toxic"]) if m["weights"] else None
        for batch in blocks(batches, 256):
            if distance is None:
                gains, scores = [0.0] * batch.num_rows, [float(m["share"])] * batch.num_rows
            else:
                x = np.array([features(distance.gains(t)) for t in texts(batch, 1)])
                gains = x[:, 0].tolist()
                scores = (1 / (1 + np.exp(-np.clip(m["weights"][0] + x @ np.array(m["weights"][1:]), -30, 30)))).tolist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()), pa.array(gains, pa.float64())], ["id", "score", "predicted", "gain"])
        del distance
        release()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, score double, predicted int, gain double").withColumnRenamed("id", id_col)
