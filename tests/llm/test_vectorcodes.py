import hashlib
import math
import random

import duckdb
import numpy as np
import pytest

from gridflow.llm import queries
from gridflow.llm import vectorcodes as V


def brute(rows, parts=4, entries=256, rounds=4):
    """(id, label, vector) -> (id, code, error, label_error, digest) in Python integers."""
    good = sorted((r for r in rows if r[2] is not None and all(x is not None and math.isfinite(x) for x in r[2])),
                  key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    good = [(i, y, [math.floor(min(V.LIMIT, max(-V.LIMIT, float(x) * 1024))) for x in v]) for i, y, v in good]
    if not good:
        return []
    w = len(good[0][2])
    at = [w * p // parts for p in range(parts + 1)]
    books = [[r[2][at[p]:at[p + 1]] for r in good[:entries]] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), k) for k, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for _, _, v in good:
                x = v[at[p]:at[p + 1]]
                members.setdefault(near(x, books[p])[1], []).append(x)
            for k, xs in members.items():
                books[p][k] = [sum(c) // len(xs) for c in zip(*xs)]
    digest = hashlib.sha256(",".join(str(v) for b in books for c in b for v in c).encode()).hexdigest()
    out = []
    for i, y, v in good:
        found = [near(v[at[p]:at[p + 1]], books[p]) for p in range(parts)]
        out.append((i, y, "".join(f"{k:02x}" for _, k in found), min(V.LONG_MAX, sum(d for d, _ in found))))
    total = {}
    for _, y, _, e in out:
        total[y] = total.get(y, 0) + e
    return [(i, c, e, min(V.LONG_MAX, total[y]), digest) for i, y, c, e in out]


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=str)


@pytest.mark.parametrize("top,bits", [(2, 0), (1000, 9), (1 << 20, 20), (1 << 40, 40), (1 << 61, 60)])
def test_products_are_exact(top, bits):
    rng = np.random.default_rng(bits)
    a, b = rng.integers(-top, top, (17, 16)), rng.integers(-top, top, (9, 16))
    want = [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a]
    assert V.products(a, b).tolist() == want
    width = V.limb_bits(16)
    for x in V.limbs(a, width):
        assert np.abs(x).max() <= 2 ** width
    assert 16 * 2 ** (2 * width) <= 2 ** 53
    back = sum(x.astype(object).astype(int).astype(object) * (1 << width * i) for i, x in enumerate(V.limbs(a, width)))
    assert (back == a).all()
    k, d = V.nearest(a, b)
    for i, r in enumerate(a):
        assert (int(d[i]), int(k[i])) == min((sum((int(x) - int(y)) ** 2 for x, y in zip(r, s)), j) for j, s in enumerate(b))


def test_ties_go_to_the_lower_entry():
    k, d = V.nearest(np.array([[0, 0], [5, 5]]), np.array([[1, 0], [0, 1], [-1, 0], [1, 0]]))
    assert k.tolist() == [0, 0] and d.tolist() == [1, 41]


def test_driver_vectors_equal_brute_force_and_sql(spark):
    d = "/root/testdata/sf0.001"
    got = ordered(queries.QUERIES["op12_limbcodes"](spark, d).collect())
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from read_parquet('{d}/embeddings.parquet')")
    rows = con.execute("select vec_id, label, embedding from embeddings").fetchall()
    assert got == ordered(brute(rows)) and len(got) == len(rows)
    assert got == ordered(con.execute(queries.ORACLE["op12_limbcodes"]).fetchall())


def test_codes_shrink_the_error(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    first, last = (V.train(V.kept(rows), rounds=n) for n in (0, 4))
    before, after = (V.encoded(V.kept(rows), b).selectExpr("sum(vector_code.error)").first()[0] for b in (first, last))
    assert after < before
    x = V.integers(np.array([r.embedding for r in rows.collect()]))
    codes, error = last.codes(x)
    apart = (x - np.round(last.decoded(codes) * 1024).astype(np.int64)) ** 2
    assert (apart.sum(axis=1) == error).all()


@pytest.mark.parametrize("kind,scale", [("float", 1.0), ("double", 1e9), ("double", 1e300)])
def test_random_rows_equal_brute_force(spark, kind, scale):
    rng = random.Random(int(math.log10(scale)) + 1)
    rows = []
    for i in range(300):
        v = [rng.choice([rng.uniform(-scale, scale), 0.0, scale / 3]) for _ in range(6)]
        rows.append((i // 2 if i % 5 else None, rng.choice([None, 1, 2, 2, 2]), v))
    rows += [(1, 1, None), (2, None, [None] * 6), (3, 2, [float("nan")] + [0.0] * 5), (4, 2, [0.0] * 5 + [float("-inf")]), (-1, 2, [1.0])]
    df = spark.createDataFrame(rows, f"vec_id long, label int, embedding array<{kind}>").repartition(5)
    if kind == "float":
        rows = [(i, y, v and [None if x is None else float(np.float32(x)) for x in v]) for i, y, v in rows]
    out = V.compress(df)
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert ordered(out.collect()) == ordered(brute(rows[:-1]))


def test_edge_tables(spark):
    kind = "vec_id long, embedding array<float>, label string, code int, error string, v int"
    none = spark.createDataFrame([], kind)
    assert V.compress(none).count() == 0
    bad = spark.createDataFrame([(1, None, "a", 1, "x", 1), (2, [None, 1.0], "a", 1, "x", 1)], kind)
    assert V.compress(bad).count() == 0
    rows = [(7, "a", [0.5, 0.25, -0.001, 0.0])] * 3 + [(8, None, [0.5, 0.25, 1.0, 0.0]), (None, None, [9.0] * 4)]
    df = spark.createDataFrame([(i, v, y, 1, "x", 1) for i, y, v in rows], kind)
    got = ordered(V.compress(df).collect())
    assert got == ordered(brute([(i, y, [float(np.float32(x)) for x in v]) for i, y, v in rows])) and len(got) == 5
    assert V.encoded(V.kept(df), V.train(V.kept(df)), out="new").columns == [*df.columns, "new"]
    empty = spark.createDataFrame([(1, [], "a", 1, "x", 1)], kind)
    assert [tuple(r)[:4] for r in V.compress(empty).collect()] == [(1, "00000000", 0, 0)]
