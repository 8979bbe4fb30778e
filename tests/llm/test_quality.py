import zlib

import numpy as np
from pyspark.sql import functions as F

from gridflow.llm import quality as Q
from gridflow.sources.tables import read_table


def test_held_out_accuracy(spark):
    docs, labels = (read_table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    out = Q.score_texts(docs, labels)
    r = out.where("held_out").join(labels, "doc_id").select("score", "predicted", "quality").collect()
    y, p, s = (np.array([x[k] for x in r]) for k in ("quality", "predicted", "score"))
    assert len(y) > 300 and (p[y == 1] == 1).mean() > 0.99 and (p[y == 0] == 0).mean() > 0.9
    assert s.min() >= 0 and s.max() <= 1
    order = s.argsort().argsort()
    auc = (order[y == 1].mean() - ((y == 1).sum() - 1) / 2) / (y == 0).sum()
    assert auc > 0.98
    assert {bool(x.held_out) == (zlib.crc32(str(x.doc_id).encode()) % 5 == 0) for x in out.select("doc_id", "held_out").collect()} == {True}


def test_votes_equal_brute_force():
    rng = np.random.default_rng(4)
    texts = ["".join(rng.choice(list("abc XYZ!%\n")) for _ in range(n)).encode() for n in rng.integers(0, 90, 80)]
    x = np.stack([Q.features(t) for t in texts])
    m = Q.fit(x[:60], (np.arange(60) % 3 > 0).astype(float))
    got = m.scores(x)
    for i, v in enumerate(m.latent(x)):
        c = np.round(m.vectors @ v, Q.DIGITS)
        at = np.flatnonzero(c >= np.sort(c)[-Q.NEIGHBOURS])
        w = np.maximum(c[at], 0).astype(float) ** Q.POWER
        if w.sum() > 0 and np.abs(np.sort(c)[-Q.NEIGHBOURS] - np.sort(c)[-Q.NEIGHBOURS - 1]) > 2e-5:
            assert abs(got[i] - (w * m.labels[at]).sum() / w.sum()) < 1e-4


def test_ties_do_not_depend_on_order():
    x = np.stack([Q.features(b"the same text")] * 40 + [Q.features(f"other {i} words".encode()) for i in range(40)])
    y = np.array([1.0, 0.0] * 20 + [0.0] * 40)
    for seed in range(4):
        at = np.random.default_rng(seed).permutation(80)
        assert abs(Q.fit(x[at], y[at]).scores(x[:1])[0] - 0.5) < 1e-9


def test_held_out_labels_do_not_matter(spark):
    docs, labels = (read_table(spark, "/root/testdata/sf0.001", t) for t in ("documents", "labels"))
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    flipped = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    moved = docs.withColumns({"lang": F.lit("xx"), "source": F.lit("s")})
    a, b = ({r.doc_id: r.score for r in Q.score_texts(d, y).collect()} for d, y in ((docs, labels), (moved, flipped)))
    assert a.keys() == b.keys() and max(abs(a[i] - b[i]) for i in a) < 1e-6


def test_edge_rows(spark):
    rows = [(i, "plain words of a kind text" if i % 2 else "JUNK!! JUNK!! %%%") for i in range(30)]
    docs = spark.createDataFrame([(i, t, 0.5) for i, t in rows + [(100, None), (101, ""), (None, "plain words"), (102, "x " * 200_000), (1, "same id")]],
                                 "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)] + [(None, 1), (3, None), (5, 0)], "doc_id long, quality int")
    out = Q.score_texts(docs, labels)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    r = out.collect()
    assert len(r) == 35 and all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.3) for x in r)
    assert all(x.predicted == x.doc_id % 2 for x in r if x.doc_id is not None and 1 < x.doc_id < 30)
    assert {x.score for x in Q.score_texts(docs, labels.limit(0)).collect()} == {0.5}
    assert Q.score_texts(docs.limit(0), labels).count() == 0
