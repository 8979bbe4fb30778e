import numpy as np
from pyspark.sql import functions as F

from gridflow.llm import toxicity as T
from gridflow.sources.tables import read_table


def test_held_out_rows(spark):
    docs = read_table(spark, "/root/testdata/sf0.1", "documents")
    labels = read_table(spark, "/root/testdata/sf0.1", "labels")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 0
    model = T.train(docs, labels.where(~held))
    r = T.scored(docs.join(labels.where(held).select("doc_id", "toxic"), "doc_id"), model)
    n = {(x.toxic, x.p): x.n for x in r.groupBy("toxic", F.col("toxicity.toxic").alias("p")).agg(F.count("*").alias("n")).collect()}
    assert n[1, True] / (n[1, True] + n.get((1, False), 0)) > 0.9
    assert n.get((0, True), 0) / n[0, False] < 0.01
    # severity follows the graded evidence and lies in range
    e = r.select(F.min("toxicity.expected_severity"), F.max("toxicity.expected_severity")).first()
    assert 0 <= e[0] and 2 < e[1] <= T.GRADES - 1


def test_gradient_descends_to_a_proportional_odds_fit():
    rng = np.random.default_rng(1)
    n = 4000
    x = rng.integers(0, 3, n)
    z = 1.5 * x - np.array([1.0, 2.0, 3.5])[:, None] - rng.logistic(size=n)
    g = (z > 0).sum(axis=0)
    rows = np.flatnonzero(x)
    w, theta = T.fit(rows, np.zeros(len(rows), int), x[rows].astype(float), g, 1)
    assert abs(w[0] - 1.5) < 0.15
    assert np.abs(theta - [1.0, 2.0, 3.5]).max() < 0.2


def test_shared_weights_give_ordered_chances():
    m = T.OrdinalModel(*[np.sort(T.features(b"vile")[0]), np.array([4.0]), np.array([2.0, 3.0, 5.0])])
    p = m.chances(b"a vile, VILE!".lower())
    assert p[0] >= p[1] >= p[2] and p[0] > 0.5 > m.chances(b"")[0]


def test_edge_rows(spark):
    rows = [(i, "bad awful words" if i % 5 == 0 else "good nice words", int(i % 5 == 0)) for i in range(40)]
    docs = spark.createDataFrame([(a, b, "k") for a, b, _ in rows] + [(100, None, "k"), (101, "", "k"), (None, "awful bad", "k"),
                                 (102, "awful " * 200_000, "k"), (1, "good nice words", "k")],
                                 "doc_id long, text string, toxic string")
    labels = spark.createDataFrame([(a, c) for a, _, c in rows] + [(None, 1), (100, None), (10, 1)], "doc_id long, toxic int")
    out = T.toxicity(docs, labels)
    assert out.columns == ["doc_id", "expected_severity", "grade", "toxic"]
    r = out.collect()
    assert len(r) == 45
    got = {(x.doc_id, x.toxic) for x in r}
    assert got == {(i, i % 5 == 0) for i in range(40)} | {(100, False), (101, False), (None, True), (102, True)}
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert not any(x.toxic for x in T.toxicity(docs, none).collect())
    assert T.toxicity(docs.limit(0), labels).count() == 0
