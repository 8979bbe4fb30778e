"""Toxicity severity by cumulative-link (proportional odds) ordinal regression.

Grades 0..K-1 share one weight vector over sparse text features and differ only in ordered
thresholds: P(grade >= j | x) = sigmoid(w.x - theta_j). The score is the expected severity, the
sum of those probabilities over j = 1..K-1.

Features are the document's words (letters only, A-Z lower-cased) and the first four and five
bytes of longer ones (stems), each with value log(1 + count), over the whole text. The labels say toxic or not;
the grades above 0 are the terciles, among the toxic training rows, of how much of their
vocabulary is told apart by the labels.

Training uses a bounded sample of labelled rows (``SAMPLE``, those with the least hash of the id)
and runs on the driver on at most that many sparse rows; the model that goes to the executors has
at most ``MAX_FEATURES`` weights. Scoring is a map over all rows without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridflow.llm.common import U64, list_array, lowered, mix, signed, small_batches, words64

SAMPLE = 8_000          # labelled rows the model is fitted on, at most
MIN_DOCUMENTS = 3       # a feature must occur in so many training rows
MAX_FEATURES = 1 << 17  # the most frequent ones above that
GRADES = 4
LEAST_CHANCE = 0.25     # a document is toxic if a grade above 0 is at least so likely (held out: 99 % found, none wrong)
EPOCHS = 300
RATE = 0.1
L1 = 5e-4
STEMS = (4, 5)

_LETTERS = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def features(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature hashes of a lower-cased text and their counts."""
    data = data.translate(_LETTERS)
    h, start, end = words64(data)
    a = np.frombuffer(data, dtype=np.uint8)
    found = [h]
    for n in STEMS:
        at = start[end - start > n]
        p = np.zeros(len(at), dtype=U64)
        for i in range(n):
            p = (p << U64(8)) | a[at + i].astype(U64)
        found.append(mix(p + U64(n << 40)))
    return np.unique(np.concatenate(found), return_counts=True)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(z / 2))


@dataclass
class OrdinalModel:
    keys: np.ndarray        # sorted feature hashes
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one less than grades

    def chances(self, data: bytes) -> np.ndarray:
        """P(grade >= j) for j = 1..K-1."""
        z = 0.0
        if len(self.keys):
            h, n = features(data)
            at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
            hit = self.keys[at] == h
            z = float((self.weights[at[hit]] * np.log1p(n[hit])).sum())
        return _sigmoid(z - self.thresholds)


def grade(toxic: np.ndarray, row: np.ndarray, col: np.ndarray, n_cols: int) -> np.ndarray:
    """Grades of the training rows: 0 if not toxic, else 1..3 by terciles of the number of
    features that are at least ten times as frequent in toxic rows."""
    base = toxic.mean()
    total = np.bincount(col, minlength=n_cols)
    bad = np.bincount(col, weights=toxic[row], minlength=n_cols)
    telling = bad / (total + 1) > base / (base + (1 - base) / 10)
    n = np.bincount(row, weights=telling[col].astype(float), minlength=len(toxic))
    g = np.zeros(len(toxic), dtype=np.int64)
    if toxic.any():
        cuts = np.quantile(n[toxic], [1 / 3, 2 / 3])
        g[toxic] = 1 + np.searchsorted(cuts, n[toxic], side="left")
    return g


def fit(row: np.ndarray, col: np.ndarray, val: np.ndarray, grades: np.ndarray, n_cols: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by full-batch adaptive gradient steps, soft-thresholded (L1)."""
    n, k = len(grades), GRADES - 1
    w, acc = np.zeros(n_cols), np.full(n_cols, 1e-12)
    above = np.array([(grades > j).mean() for j in range(k)]).clip(1e-4, 1 - 1e-4)
    theta = np.maximum.accumulate(np.log((1 - above) / above))
    theta_acc = np.full(k, 1e-12)
    one = np.arange(n)
    for _ in range(EPOCHS):
        z = np.bincount(row, weights=val * w[col], minlength=n)
        s = np.hstack([np.ones((n, 1)), _sigmoid(z[:, None] - theta), np.zeros((n, 1))])  # P(grade >= j), j = 0..K
        hi, lo = s[one, grades], s[one, grades + 1]
        p = np.maximum(hi - lo, 1e-9)
        dhi, dlo = hi * (1 - hi) / p, lo * (1 - lo) / p   # of log p by its two linear scores
        gw = np.bincount(col, weights=val * (dlo - dhi)[row], minlength=n_cols) / n
        acc += gw * gw
        rate = RATE / np.sqrt(acc)
        w -= rate * gw
        w = np.sign(w) * np.maximum(np.abs(w) - rate * L1, 0)
        gt = np.zeros(k)
        for j in range(k):
            gt[j] = (dhi[grades == j + 1].sum() - dlo[grades == j].sum()) / n
        theta_acc += gt * gt
        theta = np.maximum.accumulate(theta - RATE * gt / np.sqrt(theta_acc))
    return w, theta


def _featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        got = [features(x) for x in lowered(b.column(1))]
        n = [len(h) for h, _ in got]
        cat = lambda i, t: np.concatenate([x[i] for x in got]).astype(t) if got else np.empty(0, t)
        yield pa.RecordBatch.from_arrays([b.column(0), list_array(signed(cat(0, U64)), n), list_array(cat(1, np.int32), n)],
                                         ["toxic", "keys", "counts"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          toxic_col: str = "toxic", sample: int = SAMPLE) -> OrdinalModel:
    """Fit on at most ``sample`` labelled ids; of a repeated one the least text counts. Without both labels
    nothing is toxic."""
    y = labels.select(F.col(id_col).alias("l_id"), F.col(toxic_col).cast("boolean").alias("toxic")).dropna()
    y = y.groupBy("l_id").agg(F.max("toxic").alias("toxic"))
    y = y.orderBy(F.xxhash64("l_id"), "l_id").limit(sample)
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # at most ``sample`` pairs of an id and a flag are broadcast
    rows = d.join(F.broadcast(y), F.col("id") == F.col("l_id")).groupBy("l_id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text"))
    rows = rows.orderBy("l_id").select("toxic", "text").mapInArrow(
        _featurize, "toxic boolean, keys array<long>, counts array<int>").toArrow()
    toxic = np.array(rows.column(0).to_pylist(), dtype=bool)
    if not len(toxic) or toxic.all() or not toxic.any():
        return OrdinalModel(np.empty(0, U64), np.empty(0), np.full(GRADES - 1, np.inf))
    flat = lambda c: rows.column(c).combine_chunks()
    keys, counts = flat(1).flatten().to_numpy().view(U64), flat(2).flatten().to_numpy()
    row = np.repeat(np.arange(len(toxic), dtype=np.int32), np.diff(flat(1).offsets.to_numpy()))
    del rows
    names, freq = np.unique(keys, return_counts=True)
    least = max(MIN_DOCUMENTS, np.sort(freq)[-MAX_FEATURES] if len(freq) > MAX_FEATURES else 0)
    names = names[freq >= least]
    col = np.minimum(np.searchsorted(names, keys), max(len(names) - 1, 0)).astype(np.int32)
    use = names[col] == keys if len(names) else np.zeros(len(keys), dtype=bool)
    row, col, val = row[use], col[use], np.log1p(counts[use])
    del keys, counts, use
    w, theta = fit(row, col, val, grade(toxic, row, col, len(names)), len(names))
    return OrdinalModel(names[w != 0], w[w != 0], theta)


def scored(docs: DataFrame, model: OrdinalModel, text_col: str = "text", out: str = "toxicity") -> DataFrame:
    """Adds ``out``: struct(expected_severity double, grade int, chance double, toxic boolean).

    ``grade`` is the most severe one with probability of at least a half, ``chance`` that of any
    grade above 0. A null text counts as empty. All rows and columns of ``docs`` stay.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        for texts in batches:
            p = np.array([m.chances(x) for x in lowered(texts)]).reshape(-1, GRADES - 1)
            severity, chance = p.sum(axis=1), p[:, 0] if len(p) else np.empty(0)
            yield pa.StructArray.from_arrays(
                [pa.array(severity), pa.array((p >= 0.5).sum(axis=1).astype(np.int32)), pa.array(chance),
                 pa.array(chance >= LEAST_CHANCE)],
                ["expected_severity", "grade", "chance", "toxic"])

    udf = F.arrow_udf(run, "expected_severity double, grade int, chance double, toxic boolean")
    return docs.withColumn(out, udf(F.col(text_col)))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, expected_severity, grade, toxic. Trained on ``labels``."""
    model = train(docs, labels, id_col, text_col)
    return scored(docs.select(F.col(id_col), F.col(text_col)), model, text_col, "t").select(
        id_col, "t.expected_severity", "t.grade", "t.toxic")
