"""Text quality by nearest-neighbour voting over latent-semantic vectors.

A text's features are its hashed byte bigrams (log of their rate per thousand, weighted by inverse
document frequency, unit length) and ten measures of its form (shares of capitals, digits and
signs, variety and repetition of words, breaks, lengths; standardised). Both are reduced to
``RANK`` latent dimensions, the leading eigenvectors of the training rows' products. Every text is
compared with all labelled vectors by exact blocked cosine products; the ``NEIGHBOURS`` nearest, and all
that are as near as the last of them (to ``DIGITS`` decimals), vote with their labels, weighted by a power
of their similarity: the order of the training rows decides nothing. Neither labels nor any column but the
text enters a score.

Training uses a bounded sample of labelled rows (``SAMPLE``, those with the least hash of the id);
the broadcast holds that many vectors. Scoring is a map over all rows without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridflow.llm.common import list_array, small_batches, words64

SAMPLE = 4096           # labelled rows used, at most
BUCKETS = 1024          # hashed byte bigrams
FORMS = 10
FORM_WEIGHT = 0.3       # of a form measure against the unit bigram vector
RANK = 64
NEIGHBOURS = 15
POWER = 4               # of a neighbour's similarity in its vote
DIGITS = 5              # of a similarity
LEAST_GOOD = 0.3        # texts from this score on are predicted good
BLOCK = 512             # texts compared with the labelled vectors at once

_BUCKET = np.random.default_rng(3).integers(0, BUCKETS, 1 << 16)


def features(data: bytes) -> np.ndarray:
    """Bigram rates and form measures of a UTF-8 text, over its whole length."""
    a = np.frombuffer(data, dtype=np.uint8)
    out = np.zeros(BUCKETS + FORMS, dtype=np.float32)
    if len(a) > 1:
        pair = (a[:-1].astype(np.uint16) << 8) | a[1:]
        out[:BUCKETS] = np.log1p(np.bincount(_BUCKET[pair], minlength=BUCKETS) * (1000 / len(a)))
    if len(a):
        n = np.bincount(a, minlength=256) / len(a)
        signs = n[33:48].sum() + n[58:65].sum() + n[91:97].sum() + n[123:127].sum()
        h, start, end = words64(data.lower())
        words = max(1, len(h))
        counts = np.unique(h, return_counts=True)[1]
        out[BUCKETS:] = (n[65:91].sum(), n[48:58].sum(), signs, len(counts) / words, counts.max(initial=0) / words,
                         (h[1:] == h[:-1]).sum() / words, n[10], (end - start).sum() / words, np.log1p(words), 1)
    return out


@dataclass
class Neighbours:
    """The model: how features become vectors, the labelled vectors and their labels."""

    idf: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def weighted(self, x: np.ndarray) -> np.ndarray:
        bigrams = x[:, :BUCKETS] * self.idf
        bigrams /= np.maximum(np.linalg.norm(bigrams, axis=1, keepdims=True), 1e-9)
        return np.hstack([bigrams, FORM_WEIGHT * (x[:, BUCKETS:] - self.mean) / self.scale])

    def latent(self, x: np.ndarray) -> np.ndarray:
        v = self.weighted(x) @ self.axes
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """From 0 to 1; without a similar labelled text the share of good ones, without labels 0.5."""
        prior = self.labels.mean() if len(self.labels) else 0.5
        if not len(self.labels):
            return np.full(len(x), prior)
        out = []
        for at in range(0, len(x), BLOCK):
            cosine = np.round(self.latent(x[at:at + BLOCK]) @ self.vectors.T, DIGITS)
            k = len(self.labels) - min(NEIGHBOURS, len(self.labels))
            last = np.partition(cosine, k, axis=1)[:, k:k + 1]
            vote = np.where(cosine >= last, cosine, 0).clip(0).astype(np.float64) ** POWER
            total = vote.sum(axis=1)
            out.append(np.where(total > 0, vote @ self.labels / np.where(total > 0, total, 1), prior))
        return np.concatenate(out).clip(0, 1) if out else np.empty(0)


def fit(x: np.ndarray, y: np.ndarray) -> Neighbours:
    """From training features and 0/1 labels."""
    if not len(y):
        return Neighbours(np.ones(BUCKETS, np.float32), np.zeros(FORMS, np.float32), np.ones(FORMS, np.float32),
                          np.zeros((BUCKETS + FORMS, RANK), np.float32), np.zeros((0, RANK), np.float32), np.zeros(0))
    idf = np.log((1 + len(x)) / (1 + (x[:, :BUCKETS] > 0).sum(axis=0))) + 1
    m = Neighbours(idf.astype(np.float32), x[:, BUCKETS:].mean(axis=0), x[:, BUCKETS:].std(axis=0) + 1e-6, np.empty(0), np.empty(0), y)
    w = m.weighted(x)
    m.axes = np.ascontiguousarray(np.linalg.eigh(w.T @ w)[1][:, ::-1][:, :RANK])
    m.vectors = m.latent(x)
    return m


def _bytes(texts: pa.Array) -> list[bytes]:
    return [x or b"" for x in texts.cast(pa.binary()).to_pylist()]


def _matrix(texts: pa.Array) -> np.ndarray:
    return np.stack([features(x) for x in _bytes(texts)]) if len(texts) else np.empty((0, BUCKETS + FORMS), np.float32)


def _featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x = _matrix(b.column(1))
        yield pa.RecordBatch.from_arrays([b.column(0), list_array(x.ravel(), [x.shape[1]] * len(x))], ["y", "x"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", sample: int = SAMPLE) -> Neighbours:
    """Fit on at most ``sample`` labelled ids; a repeated label counts as good if any is, of a repeated id
    the least text counts."""
    y = labels.select(F.col(id_col).alias("l_id"), F.col(label_col).cast("int").alias("y")).dropna()
    y = y.groupBy("l_id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("l_id"), "l_id").limit(sample)
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # at most ``sample`` pairs of an id and a label are broadcast
    rows = d.join(F.broadcast(y), F.col("id") == F.col("l_id")).groupBy("l_id").agg(F.max("y").alias("y"), F.min("text").alias("text"))
    rows = rows.orderBy("l_id").select("y", "text").mapInArrow(
        _featurize, "y int, x array<float>").toArrow()
    x = rows.column(1).combine_chunks().flatten().to_numpy().reshape(-1, BUCKETS + FORMS)
    return fit(x, (rows.column(0).to_numpy() > 0).astype(np.float64))


def scored(docs: DataFrame, model: Neighbours, text_col: str = "text", out: str = "quality_score") -> DataFrame:
    """Adds ``out``. All rows and columns of ``docs`` stay; a null text counts as empty."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(shared.value.scores(_matrix(texts)), pa.float64())

    return docs.withColumn(out, F.arrow_udf(run, "double")(F.col(text_col)))


def score_texts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                fold: F.Column | None = None) -> DataFrame:
    """One row per input row: id, held_out, score, predicted.

    Labels of rows whose ``fold`` (default: crc32 of the id as text, null as empty, modulo 5) is 0 are
    held out of training.
    """
    fold = F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(5)) if fold is None else fold
    model = train(docs, labels.where(fold != 0), id_col, text_col)
    r = scored(docs.select(id_col, text_col), model, text_col, "score")
    return r.select(id_col, (fold == 0).alias("held_out"), "score", (F.col("score") >= LEAST_GOOD).cast("int").alias("predicted"))
