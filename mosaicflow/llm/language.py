"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are lower-cased n-grams of 1 to 3 characters, hashed to a fixed number of buckets; a document's value for a
bucket is its share of the document's n-grams times the bucket's inverse document frequency. With shares for counts a
document's score is one sum of weights over its n-grams, so whole texts of any length cost one table look-up each.

Document frequencies are counted over all training rows. Weights are fitted by follow-the-regularised-leader with
elastic-net penalties on at most `per_language` training rows of each language (a documented bound, drawn by a hash of
the id), and a temperature is then fitted on training rows kept apart from them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from . import kernels as K
from .common import small_batches, table, unused

ORDERS, BUCKETS = (1, 2, 3), 1 << 16
PER_LANGUAGE, EPOCHS = 1000, 3
#: Follow-the-regularised-leader: learning rate, its smoothing, and the two penalties.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 2e-4, 1e-4
#: One document's shares are small numbers; this brings them to about 1.
SCALE = 20.0
UNKNOWN = "und"
SLICE_CHARS = 400_000
#: Odd multipliers, one for each order and place.
_MULTIPLIERS = np.array([2654435761, 2246822519, 3266489917, 668265263, 374761393, 1540483477], dtype=np.uint32)


def gram_buckets(texts: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Documents i to j, the buckets of all their n-grams in document order, and how many there are before each."""
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= SLICE_CHARS):
            size += len(texts[j])
            j += 1
        lowered = [t.lower() for t in texts[i:j]]
        lens = np.fromiter(map(len, lowered), dtype=np.int64, count=j - i)
        points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        ends = np.cumsum(lens)
        found, owners = [], []
        for k, order in enumerate(ORDERS):
            n = len(points) - order + 1
            if n <= 0:
                continue
            h = np.full(n, 97 * order + 1, dtype=np.uint32)
            for p in range(order):
                h = (h ^ points[p : p + n]) * _MULTIPLIERS[k + p]
                h ^= h >> np.uint32(15)
            keep = np.ones(n, dtype=bool)
            for back in range(1, order):  # n-grams that cross into the next document
                cross = ends[:-1] - back
                keep[cross[(cross >= 0) & (cross < n)]] = False
            per = np.maximum(lens - order + 1, 0)
            found.append((h >> np.uint32(16))[keep].astype(np.int64))
            owners.append(per)
        if found:
            starts = [np.concatenate(([0], np.cumsum(p))) for p in owners]
            total = np.sum(owners, axis=0)
            first = np.concatenate(([0], np.cumsum(total)))
            out = np.empty(int(first[-1]), dtype=np.int64)
            base = first[:-1].copy()
            for values, per, begin in zip(found, owners, starts, strict=True):
                out[np.arange(len(values)) + np.repeat(base - begin[:-1], per)] = values
                base += per
            yield i, j, out, first
        else:
            yield i, j, np.zeros(0, dtype=np.int64), np.zeros(j - i + 1, dtype=np.int64)
        i = j


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # BUCKETS x languages, with the inverse document frequency and the temperature in them
    bias: np.ndarray

    def scores(self, texts: list[str]) -> np.ndarray:
        """Calibrated probabilities, one row a text."""
        out = np.zeros((len(texts), len(self.languages)))
        for i, j, buckets, first in gram_buckets(texts):
            sums = np.zeros((j - i, len(self.languages)))
            full = np.flatnonzero(np.diff(first))
            if len(full):
                sums[full] = np.add.reduceat(self.weights[buckets], first[:-1][full], axis=0)
            out[i:j] = sums / np.maximum(np.diff(first), 1)[:, None]
        return softmax(out + self.bias)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def shares(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text its distinct buckets and their shares."""
    out = []
    for i, j, buckets, first in gram_buckets(texts):
        for d in range(j - i):
            at, n = np.unique(buckets[first[d] : first[d + 1]], return_counts=True)
            out.append((at, n / max(1, n.sum())))
    return out


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, n_languages: int, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """Weights (BUCKETS x languages) and bias by follow-the-regularised-leader, one row at a time."""
    z, n = np.zeros((BUCKETS + 1, n_languages)), np.zeros((BUCKETS + 1, n_languages))

    def weights(at: np.ndarray) -> np.ndarray:
        zz = z[at]
        return np.where(np.abs(zz) <= L1, 0.0, -(zz - np.sign(zz) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    order = np.arange(len(rows))
    for epoch in range(epochs):
        np.random.Generator(np.random.Philox(key=[7, epoch])).shuffle(order)
        for k in order.tolist():
            at, x = rows[k]
            at, x = np.append(at, BUCKETS), np.append(x, 1.0)
            w = weights(at)
            p = softmax(x @ w)
            p[labels[k]] -= 1.0
            g = x[:, None] * p
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    full = weights(np.arange(BUCKETS + 1))
    return full[:-1], full[-1]


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The factor on logits of least log loss on rows not trained on, by golden-section search."""
    if not len(labels):
        return 1.0

    def loss(t: float) -> float:
        return float(-np.log(softmax(logits * math.exp(t))[np.arange(len(labels)), labels] + 1e-12).mean())

    a, b, ratio = -3.0, 3.0, (math.sqrt(5) - 1) / 2
    for _ in range(40):
        c, d = b - ratio * (b - a), a + ratio * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return math.exp((a + b) / 2)


def fit(training: DataFrame, per_language: int = PER_LANGUAGE) -> Model | None:
    """A model of training (doc_id, text, lang; none of them null); None where there are no rows.

    To the driver come: one count a language, one vector of document frequencies, and the sample, per_language rows a
    language at most (the least by a hash of the id; ties by id and text). A language of few rows is learned from these.
    """
    spark = training.sparkSession
    small_batches(spark)
    counts = {r["lang"]: r["n"] for r in training.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    languages = sorted(counts)

    @K.lean
    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen, docs = np.zeros(BUCKETS, dtype=np.int64), np.zeros(BUCKETS, dtype=bool), 0
        for batch in batches:
            for i, j, buckets, first in gram_buckets(batch.column(0).to_pylist()):
                docs += j - i
                for d in range(j - i):
                    seen[buckets[first[d] : first[d + 1]]] = True
                    total += seen
                    seen[:] = False
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, BUCKETS)), pa.array(np.append(total[at], docs))], names=["bucket", "n"])

    found = training.select("text").mapInArrow(frequencies, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    n = np.zeros(BUCKETS + 1)
    n[found["bucket"].to_numpy()] = found["n"].to_numpy()
    idf = np.log((1 + n[-1]) / (1 + n[:-1])) + 1.0

    # twice the share that is wanted, by a hash of the id, and of these in the order of the hash exactly the bound
    shares_of = spark.createDataFrame([(lang, min(1.0, 2.0 * per_language / have)) for lang, have in counts.items()], "lang string, share double")
    uniform = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(17)), F.lit(1 << 30)) / float(1 << 30)
    some = training.join(F.broadcast(shares_of), "lang").withColumn("uniform", uniform).filter("uniform <= share")
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("uniform", "doc_id", "text"))).filter(F.col("rank") <= per_language)
    sample = ranked.select("doc_id", "text", "lang", F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(23)), F.lit(5)).alias("part")).toPandas().sort_values(["doc_id", "text", "lang"])
    labels = sample["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy()
    rows = [(at, s * idf[at] * SCALE) for at, s in shares(sample["text"].tolist())]
    apart = sample["part"].to_numpy() == 0
    if (~apart).sum() == 0:
        apart[:] = False
    weights, bias = fit_ftrl([r for r, a in zip(rows, apart, strict=True) if not a], labels[~apart], len(languages))
    logits = np.array([x @ weights[at] + bias for (at, x), a in zip(rows, apart, strict=True) if a]).reshape(-1, len(languages))
    factor = fit_temperature(logits, labels[apart])
    return Model(languages, (weights * idf[:, None] * SCALE * factor).astype(np.float32), bias * factor)


def predict(docs: DataFrame, model: Model | None, keep: list[str], prefix: str = "") -> DataFrame:
    """The kept columns, lang_pred and score (after the prefix) of each row; `und` and 0 where the text is null, has no letter, or no model is there.

    Repeated rows and rows without id are told like all others; columns of any name may be kept but those given out.
    """
    small_batches(docs.sparkSession)
    text, letter = unused(docs, "whole_text", "letter")
    kept = docs.select(*[F.col(c) for c in keep], F.col("text").cast("string").alias(text), F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias(letter))
    if model is None:
        return kept.select(*keep, F.lit(UNKNOWN).alias(prefix + "lang_pred"), F.lit(0.0).alias(prefix + "score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # buckets x languages floats, whatever the corpus
    out = T.StructType([*kept.select(*keep).schema, T.StructField(prefix + "lang_pred", T.StringType()), T.StructField(prefix + "score", T.DoubleType())])

    @K.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            letters = batch.column(len(keep) + 1).to_numpy(zero_copy_only=False)
            p = m.scores([t or "" for t in batch.column(len(keep)).to_pylist()])
            best = p.argmax(axis=1)
            lang = [m.languages[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), letters.tolist(), strict=True)]
            score = np.where(letters, p[np.arange(len(best)), best], 0.0)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(keep))), pa.array(lang, pa.string()), pa.array(score)], names=out.names)

    return kept.mapInArrow(run, out)


def held_out():  # noqa: ANN201
    """True for rows never learned from: crc32 of the id as text leaves 2 by 4; False for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def train_rows(docs: DataFrame) -> DataFrame:
    return docs.filter(~held_out() & F.col("text").isNotNull() & F.col("lang").isNotNull()).select("doc_id", "text", F.col("lang").cast("string").alias("lang"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, learned from rows that are not held out; see predict for null and empty texts."""
    docs = table(spark, sf_dir, "documents")
    marked = docs.select("doc_id", "text", held_out().alias("held_out"))
    return predict(marked, fit(train_rows(docs)), ["doc_id", "held_out"])
