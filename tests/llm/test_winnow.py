import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from gridflow.llm import winnow as W
from gridflow.sources.tables import read_table


def brute_winnow(h, w=W.WINDOW):
    """Least upper half of every window, rightmost of equal ones."""
    out = {}
    for s in range(max(1, len(h) - w + 1) if h else 0):
        span = range(s, min(s + w, len(h)))
        p = min(span, key=lambda i: ((h[i] & (1 << 64) - 1) >> 32, -i))
        out[p] = h[p]
    return [(h, p) for p, h in sorted(out.items())]


@pytest.mark.parametrize("w", [1, 3, 8, 11])
def test_choice_equals_brute_force(spark, w):
    rng = random.Random(w)
    rows = [[rng.choice([rng.getrandbits(64) - (1 << 63), 5, -7, 1 << 40]) for _ in range(rng.randrange(40))] for _ in range(80)]
    df = spark.createDataFrame([(x,) for x in rows], "h array<bigint>").select("h", W.winnowed(F.col("h"), w).alias("f"))
    for r in df.collect():
        assert [(x.hash, x.pos) for x in r.f] == brute_winnow(r.h, w)


def test_grams(spark):
    texts = ["", "  \n", "one", "a b c d e", "a b c d e f", "A  B\tc d E f a b c d e", "x" * 40]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", W.gram_hashes(F.col("t")).alias("g"))
    g = {r.t: r.g for r in df.collect()}
    assert [len(g[t]) for t in texts] == [0, 0, 1, 1, 2, 7, 1]
    assert g[texts[4]] == g[texts[5]][:2] and g[texts[3]] == g[texts[5]][6:]


def test_shared_run_shares_a_fingerprint(spark):
    rng = random.Random(8)
    words = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    rows = []
    for _ in range(40):
        run = words(W.GRAM + W.WINDOW - 1)
        rows.append((f"{words(rng.randrange(30))} {run} {words(rng.randrange(30))}", f"{words(rng.randrange(30))} {run} {words(rng.randrange(30))}"))
    df = spark.createDataFrame(rows, "a string, b string")
    near = df.select(W.likeness(W.hashes_of(W.fingerprint(F.col("a"))), W.hashes_of(W.fingerprint(F.col("b")))).alias("x"))
    assert all(r.x > 0 for r in near.collect())


def want(rows):
    """id, n_chars, sha256 of the edited text and the two texts, by the contract."""
    key = lambda r: (r[0] is None, 0 if r[0] is None else -r[0], r[1])
    rows = sorted(((i, t or "") for i, t in rows), key=key)
    out = []
    for (i, t), (_, nxt) in zip(rows, rows[1:] + rows[:1]):
        half = len(t) // 2
        out.append((i, len(t), hashlib.sha256((t[:len(t) - half] + nxt[:half]).encode()).hexdigest()))
    return sorted(out, key=str)


def test_driver_documents(spark):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    out = W.edited_fingerprints(docs).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in out), key=str) == want(rows)
    by_text = {}
    prints = {r.doc_id: r for r in out}
    for i, t in rows:
        assert by_text.setdefault(t, prints[i].fingerprint) == prints[i].fingerprint
        assert all(re.fullmatch(r"[0-9A-F]+:\d+", x) for x in prints[i].fingerprint.split(","))
    long = [r for r in out if r.n_chars > 1000]
    assert sum(r.near_edited > r.near_next for r in long) > 0.98 * len(long)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in out)


@pytest.mark.parametrize("buckets", [1, 2, 7, 100])
def test_next_rows_and_edges(spark, buckets):
    rng = random.Random(buckets)
    rows = [(rng.randrange(200) * 3, " ".join(rng.choice("abcdé") * rng.randrange(1, 20) for _ in range(rng.randrange(9)))) for _ in range(150)]
    rows = list({i: (i, t) for i, t in rows}.values()) + [(rows[0][0], "twice"), (None, "no id é"), (None, None), (7, None), (8, ""), (1000, "w " * 40_000)]
    docs = spark.createDataFrame([(i, t, 1, "b") for i, t in rows], "doc_id long, text string, bucket int, copy string").repartition(5)
    d = docs.select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    got = W.with_next(d, {"t": lambda t: t}, buckets)
    key = lambda r: (r[0] is None, 0 if r[0] is None else -r[0], r[1])
    order = sorted(((i, t or "") for i, t in rows), key=key)
    assert sorted(((r.id, r.text, r.next_t) for r in got.collect()), key=str) == sorted(
        ((i, t, n) for (i, t), (_, n) in zip(order, order[1:] + order[:1])), key=str)
    if buckets == 7:
        out = W.edited_fingerprints(docs)
        assert out.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in out.collect()), key=str) == want(rows)
        assert W.edited_fingerprints(docs.limit(0)).count() == 0
        single = W.edited_fingerprints(docs.where("doc_id = 1000")).collect()
        assert [(r.n_chars, r.near_next) for r in single] == [(80_000, 1.0)]


def test_plan_has_no_python(spark):
    plan = W.edited_fingerprints(read_table(spark, "/root/testdata/sf0.001", "documents"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
