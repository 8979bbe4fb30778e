import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridflow.llm import minhash
from gridflow.llm.common import words64
from gridflow.llm.graph import components
from gridflow.sources.tables import read_table


def shingles(text, k):
    w = [] if text is None else [x for x in text.encode().lower().split()]
    if not w:
        return set()
    return {tuple(w)} if len(w) < k else {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def brute(rows, k, threshold=80):
    sets = [(i, shingles(t, k)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for (i, a), (j, b) in itertools.combinations(sets, 2):
        if a and b and 100 * len(a & b) >= threshold * len(a | b):
            x, y = sorted((find(i), find(j)))
            parent[y] = x
    return sorted((i, len(s), find(i), find(i) == i) for i, s in sets)


def got(df):
    return sorted(tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect())


def test_driver_documents_equal_brute_force(spark):
    docs = read_table(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(minhash.near_duplicates(docs, shingle_words=4)) == brute(rows, 4)


def _chains(seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows, i = [], 0
    for _ in range(12):
        base = [rng.choice(vocab) for _ in range(rng.choice([3, 30, 120]))]
        for _ in range(6):  # drifting copies: neighbours are linked, ends may not be
            rows.append((i, " ".join(base)))
            i += 1
            base = list(base)
            for _ in range(max(1, len(base) // 60)):
                base[rng.randrange(len(base))] = rng.choice(vocab)
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("paired,rare", [(1024, 64), (1, 64), (1, 2), (1024, 1)])
def test_chains_of_near_copies(spark, monkeypatch, paired, rare):
    monkeypatch.setattr(minhash, "PAIRED_BUCKET", paired)
    monkeypatch.setattr(minhash, "RARE", rare)
    rows = _chains(paired)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(minhash.near_duplicates(docs)) == brute(rows, 5)


@pytest.mark.parametrize("paired,rare", [(1024, 64), (8, 3)])
def test_edited_copies_of_one_text(spark, monkeypatch, paired, rare):
    """Many edits of one text: some reach the threshold with some others, many with none."""
    monkeypatch.setattr(minhash, "PAIRED_BUCKET", paired)
    monkeypatch.setattr(minhash, "RARE", rare)
    rng = random.Random(21)
    base = [f"b{i}" for i in range(100)]
    shared = " ".join(f"s{i}" for i in range(60))
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.randrange(9)):
            w[rng.randrange(100)] = f"n{rng.randrange(40)}"
        rows.append((i, " ".join(w)))
    rows += [(200 + i, shared + " " + " ".join(f"u{i}_{j}" for j in range(40))) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute(rows, 5)
    assert 30 < len({c for _, _, c, _ in want}) < 170
    assert got(minhash.near_duplicates(docs)) == want


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "ONE  two"), (6, "one two three"), (None, "one two"),
            (8, "x " * 30_000), (9, "x " * 30_001), (4, "one two")]
    docs = spark.createDataFrame([(i, t, "c", "n") for i, t in rows], "doc_id long, text string, cls string, node string")
    out = minhash.near_duplicates(docs)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    r = {(x.doc_id, x.n_shingles, x.component_id, x.kept) for x in out.collect()}
    assert r == {(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False), (6, 1, 6, True),
                 (None, 1, None, None), (8, 1, 8, True), (9, 1, 8, False)}
    assert out.count() == len(rows)
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_repeated_id_ties_its_texts(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "p q r s t u"), (3, "a b c d e f"), (3, "p q r s t u")],
                                 "doc_id long, text string")
    assert {x.component_id for x in minhash.near_duplicates(docs).collect()} == {1}


def test_estimate_tracks_similarity(spark):
    rng = np.random.default_rng(0)
    for share in (0.0, 0.5, 0.8, 0.95):
        both = rng.integers(0, 2**64, 2000, dtype=np.uint64)
        n = int(2000 * share)
        own = rng.integers(0, 2**64, (2, 2000 - n), dtype=np.uint64)
        sides = [np.concatenate([both[:n], own[i]]) for i in (0, 1)]
        sig = [minhash.packed(minhash.minima(s)).view(np.int64).tolist() for s in sides]
        df = spark.createDataFrame([tuple(sig)], "x array<long>, y array<long>")
        est = df.select(minhash._agreement("x", "y")).first()[0]
        assert abs(est - n / (4000 - n)) < 0.2


def test_components(spark):
    rng = random.Random(3)
    e = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(400 + i, 401 + i) for i in range(40)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in e:
        if a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    want = {(n, find(n)) for n in list(parent)}
    df = spark.createDataFrame(e + [(None, 1)], "a long, b long")
    assert {tuple(r) for r in components(df).collect()} == want
    assert components(df.where(F.lit(False))).count() == 0


def test_word_hashes_ignore_position_and_chunks(monkeypatch):
    from gridflow.llm import common
    text = b"alpha beta\talpha\n\x0b gamma alphaalpha alpha"
    h, s, e = words64(text)
    assert [text[i:j] for i, j in zip(s, e)] == text.split()
    assert h[0] == h[2] == h[5] and len(set(h.tolist())) == 4
    monkeypatch.setattr(common, "CHUNK", 7)
    h2, s2, e2 = common.words64(text)
    assert (h == h2).all() and (s == s2).all() and (e == e2).all()
