"""Quality classifier: hashed word n-gram logistic regression, trained by follow-the-regularised-leader.

A text's words are read at two grains: the word itself and its form (case and trailing marks). Unigrams of both,
bigrams of both and a mark for a word that repeats its predecessor are hashed into 2**BITS buckets; a feature's
value is its share among the text's features, so long and short texts are on one scale. Scores are sparse dot
products with the model, read per word from a table of distinct words.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.llm.common import documents, held_out, slices, staged, texts, tidied

BITS = 18
#: Labelled rows that the fit uses at most: those with the smallest hash of doc_id among the rows it may learn from.
FIT_ROWS = 6000
#: Features that the fit uses at most, summed over those rows; what comes after them in order of the hash is left out.
FIT_FEATURES = 1 << 24
EPOCHS, ALPHA, BETA, L1, L2 = 4, 0.3, 1.0, 0.02, 0.01
SCALE = 20.0
THRESHOLD = 0.7
#: Distinct words that a worker keeps; words turned to features at once.
TABLE, BLOCK = 200_000, 1 << 17
_MASK = (1 << BITS) - 1


def _bucket(s: str) -> int:
    return zlib.crc32(s.encode("utf-8", "surrogatepass"))


def form(word: str) -> str:
    """Case of the letters and the marks around them: DE!! -> XX!!, Ofered. -> Xx."""
    body = word.rstrip("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
    case = "0" if not body else "9" if any(c.isdigit() for c in body) else "X" if len(body) > 1 and body.isupper() else "Xx" if body[:1].isupper() else "x"
    return case + word[len(body) :][:3]


class Words:
    """Hashes of distinct words and of their forms."""

    def __init__(self):
        self.at: dict[str, int] = {}
        self.hash = np.zeros((TABLE, 2), np.uint32)

    def ids(self, words: list[str]) -> np.ndarray:
        index = list(map(self.at.get, words))
        if None in index:
            new = list(dict.fromkeys(w for w, k in zip(words, index) if k is None))
            if len(self.at) + len(new) > TABLE:
                self.at.clear()
                new = list(dict.fromkeys(words))
            n = len(self.at)
            self.hash[n : n + len(new)] = [(_bucket(w), _bucket("\t" + form(w))) for w in new]
            self.at.update(zip(new, range(n, n + len(new))))
            index = list(map(self.at.get, words))
        return np.array(index, np.int64)


def blocks(text: str, words: Words):
    """Feature buckets of a text, with repeats, a block of words at a time."""
    all_words = text.split()
    last = None
    for at in range(0, len(all_words), BLOCK):
        h = words.hash[words.ids(all_words[at : at + BLOCK])]
        parts = [h.ravel()]
        two = h if last is None else np.concatenate([last, h])
        if len(two) > 1:
            pair = two[:-1] * np.uint32(0x9E3779B1) + two[1:] * np.uint32(0x85EBCA6B) + np.uint32(1)
            same = two[:-1, 0] == two[1:, 0]
            parts += [pair.ravel(), np.where(same, np.uint32(0x5A5A5A5A), np.uint32(0x3C3C3C3C))]
        last = h[-1:]
        x = np.concatenate(parts)
        yield ((x ^ (x >> np.uint32(BITS))) & np.uint32(_MASK)).astype(np.int32)


def features(text: str, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, values) with each bucket once."""
    total = np.zeros(1 << BITS, np.int64) if len(text) > 1 << 20 else None
    got = list(blocks(text, words)) if total is None else None
    if total is not None:
        for b in blocks(text, words):
            total += np.bincount(b, minlength=1 << BITS)
        at = np.flatnonzero(total)
        n = total[at]
    else:
        at, n = np.unique(np.concatenate(got), return_counts=True) if got else (np.zeros(0, np.int64), np.zeros(0))
    return at.astype(np.int32), (SCALE * n / max(n.sum(), 1)).astype(np.float32)


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]]) -> tuple[np.ndarray, float]:
    """Weights by FTRL-proximal updates, row after row; the bias is the log odds of label 1, which a text without
    words keeps."""
    size = 1 << BITS
    z, n = np.zeros(size), np.zeros(size)
    good = (sum(y for *_, y in rows) + 0.5) / (len(rows) + 1)
    bias = float(np.log(good / (1 - good)))

    def weights(at):
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    order = np.random.default_rng(1)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            at, x, y = rows[i]
            w = weights(at)
            g = (1 / (1 + np.exp(-np.clip(bias + w @ x, -35, 35))) - y) * x
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    return weights(np.arange(size)).astype(np.float32), bias


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, most: int = FIT_FEATURES) -> tuple[np.ndarray, float]:
    """The model from at most ``rows`` labelled documents with at most ``most`` features, none of them held out.

    A doc_id with several labels counts by their mean; null ids and null labels teach nothing. Of rows with one doc_id
    one counts, that with the least hash of its text. Without any label the model is the constant one half."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("id")).agg((F.avg("quality") >= 0.5).cast("int").alias("y"))
    chosen = known.select("id", "y", F.xxhash64("id").alias("order")).orderBy("order", "id").limit(rows)
    some = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "id")
    some = some.groupBy("id", "y", "order").agg(F.min_by("text", F.xxhash64("text")).alias("text"))

    def mapped(batches):
        words = Words()
        for whole in batches:
            for batch in slices(whole):
                got = [features(t, words) for t in texts(batch)]
                at, x = ([g[k].tobytes() for g in got] for k in (0, 1))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "y", "order")), pa.array([len(g[0]) for g in got], pa.int64()), pa.array(at), pa.array(x)], ["id", "y", "order", "n", "at", "x"])

    found = staged(some.select("id", "y", "order", "text").mapInArrow(mapped, "id long, y int, order long, n long, at binary, x binary"), "features")
    sizes = sorted((r.order, r.id, r.n) for r in found.select("order", "id", "n").collect())  # at most ``rows``
    taken = int(np.searchsorted(np.cumsum([n for *_, n in sizes]), most, "right"))
    if not taken:
        return np.zeros(1 << BITS, np.float32), 0.0
    last = F.struct(F.lit(sizes[taken - 1][0]).alias("order"), F.lit(sizes[taken - 1][1]).alias("id"))
    got = found.filter(F.struct("order", "id") <= last).select("id", "y", "at", "x").collect()
    got.sort(key=lambda r: r.id)
    return fit_ftrl([(np.frombuffer(r.at, np.int32), np.frombuffer(r.x, np.float32), r.y) for r in got])


def scored(text: str, words: Words, weights: np.ndarray, bias: float) -> float:
    """Probability of label 1; a text without words gets that of the bias."""
    total, n = 0.0, 0
    for b in blocks(text, words):
        total += float(weights[b].sum(dtype=np.float64))
        n += len(b)
    return float(1 / (1 + np.exp(-np.clip(bias + SCALE * total / max(n, 1), -35, 35))))


def score(docs: DataFrame, model: tuple[np.ndarray, float], threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Null text counts as empty; it and texts without words get the bias alone. Texts of any length are read whole, in
    blocks; repeated rows and null ids come out as they go in, equal texts with equal scores; an empty table gives no
    rows. Further columns, whatever their names, are not read."""
    w, bias = model
    shared = docs.sparkSession.sparkContext.broadcast(w)  # 2**BITS floats, whatever the input

    @tidied
    def mapped(batches):
        words, weights = Words(), shared.value
        for whole in batches:
            for batch in slices(whole):
                out = [scored(text, words, weights, bias) for text in texts(batch)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.float64())], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = rows.mapInArrow(mapped, "doc_id long, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: tuple[np.ndarray, float], threshold: float = THRESHOLD) -> DataFrame:
    """The documents, all columns, whose score reaches the threshold. Only texts go to Python and only scores back.

    Null and wordless texts count by the bias; repeated rows stay or go together; an empty table gives no rows. Columns
    of any name pass unchanged."""
    w, bias = model
    shared = docs.sparkSession.sparkContext.broadcast(w)

    @tidied
    def scores(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words, weights = Words(), shared.value
        for whole in parts:
            yield pa.array([scored(t or "", words, weights, bias) for some in slices(whole) for t in some.to_pylist()], pa.float64())

    return docs.filter(F.arrow_udf(scores, "double")(F.col("text").cast("string")) >= threshold)


def op6_quality(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return score(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
