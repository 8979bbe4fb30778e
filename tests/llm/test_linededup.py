import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridflow.llm import linededup as L
from gridflow.sources.tables import read_table


def distance_at_most_one(x, y):
    if x == y:
        return True
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y)) <= 1
    if len(x) > len(y):
        x, y = y, x
    return len(y) - len(x) == 1 and any(y[:i] + y[i + 1:] == x for i in range(len(y)))


def brute(rows, least, exact=None):
    places = []
    for id_, text in sorted({(i, t) for i, t in rows if i is not None and t is not None}):
        for n, line in enumerate(text.split("\n")):
            w = tuple(line.encode().lower().split())
            if len(w) >= (least if exact is None else exact):
                places.append(((id_, n), w))
    places.sort()
    gone, first, seen = set(), {}, []
    for at, w in places:
        if w in first:
            gone.add(at)
            if first[w] is False:
                continue
        else:
            near = len(w) >= least and any(abs(len(w) - len(v)) <= 1 and distance_at_most_one(w, v) for v in seen)
            first[w] = not near
            if near:
                gone.add(at)
            if len(w) >= least:
                seen.append(w)
    out = []
    for id_, text in rows:
        lines = [] if text is None else text.split("\n")
        left = [x for n, x in enumerate(lines) if (id_, n) not in gone]
        out.append((id_, None if text is None else "\n".join(left), len(lines), len(lines) - len(left)))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_driver_documents_equal_brute_force(spark):
    docs = read_table(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(L.dedup_lines(docs)) == brute(rows, L.MIN_WORDS)


@pytest.mark.parametrize("broadcast", [L.BROADCAST_PLACES, 0])
def test_edits_equal_brute_force(spark, monkeypatch, broadcast):
    monkeypatch.setattr(L, "BROADCAST_PLACES", broadcast)
    rng = random.Random(5)
    vocab = ["a", "b", "Cc", "é", "dd"]
    pool = [[rng.choice(vocab) for _ in range(rng.randrange(1, 9))] for _ in range(40)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rng.randrange(0, 5)):
            w = list(rng.choice(pool))
            k = rng.randrange(4)
            at = rng.randrange(len(w) + 1)
            if k == 1:
                w.insert(at, rng.choice(vocab))
            elif k == 2 and len(w) > 1:
                del w[at % len(w)]
            elif k == 3:
                w[at % len(w)] = rng.choice(vocab)
            lines.append(rng.choice([" ", "  ", "\t"]).join(w) + rng.choice(["", " "]))
        rows.append((i, "\n".join(lines)))
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(L.dedup_lines(docs)) == brute(rows, L.MIN_WORDS)


def test_edge_rows(spark):
    line = "one two three four five"
    rows = [(3, line), (1, None), (2, ""), (None, line), (4, "\n\n" + line.upper() + "\nshort line\n"), (5, "x " * 50_000),
            (6, "x " * 50_001), (3, line), (7, "short line")]
    docs = spark.createDataFrame([(i, t, 0, "k") for i, t in rows], "doc_id long, text string, line int, keys string")
    out = L.dedup_lines(docs)
    assert out.columns == ["doc_id", "text", "n_lines", "n_removed"]
    assert got(out) == brute(rows, L.MIN_WORDS)
    assert L.dedup_lines(docs.limit(0)).count() == 0


def test_variants_hash_as_lines():
    x = L.Lines(b"p q\na b c d e f\n", 5)
    less = [L.Lines(b" ".join(w for j, w in enumerate(b"a b c d e f".split()) if j != i), 5).whole()[0][0] for i in range(6)]
    assert x.number.tolist() == [1]
    assert L.variants(x.words[x.first[0]:x.last[0]]).tolist() == less


def test_within_one():
    f = lambda x, y: L.within_one(np.array(x), np.array(y))
    assert f([1, 2, 3], [1, 2, 3]) and f([1, 2, 3], [1, 9, 3]) and f([1, 2, 3], [1, 3]) and f([1], [])
    assert not f([1, 2, 3], [2, 1, 3]) and not f([1, 2, 3], [2, 3, 4]) and not f([1, 2, 3], [1])


def test_short_lines_that_repeat_go_near_ones_stay(spark):
    rows = [(1, "All rights reserved.\n\none two three four five\nx"), (2, "all  rights reserved.\n\none two three four"),
            (3, "中文の行です\nall rights waived."), (4, "中文の行です\none two three four six\nX")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.text for r in L.dedup_lines(docs, exact_words=L.EXACT_WORDS).collect()}
    assert out == {1: rows[0][1], 2: "\none two three four", 3: rows[2][1], 4: ""}


def test_scraps(spark):
    rows = [(1, "a b c d e", "a"), (2, "a b c d e f", "a"), (3, "a b\nc", "a b"), (4, None, None), (5, "", ""), (6, "  x", "  x"), (7, "a\nb", ""),
            (8, " \n \n", " "), (9, "a b c d\ne", "e")]
    df = spark.createDataFrame(rows, "id long, x string, y string")
    assert {r.id for r in df.where(L.scrap(F.col("x"), F.col("y"))).collect()} == {2, 7}
    assert df.where(L.scrap(F.col("x"), F.col("y")).isNull()).count() == 0
