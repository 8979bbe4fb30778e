import itertools
import random
import re
import tracemalloc

import numpy as np
import pytest

from gridflow.llm import decontam as D
from gridflow.sources.tables import read_table


def words(text):
    return re.findall(rb"[a-z0-9\x80-\xff]+", (text or "").encode().lower())


def best(doc, item):
    """Most equal words over all ungapped overlaps of two word lists, each judged by its best stretch or,
    where that does not qualify, by all of its stretches."""
    found = 0
    for shift in range(-len(item) + 1, len(doc)):
        eq = [doc[i] == item[i - shift] for i in range(max(0, shift), min(len(doc), shift + len(item)))]
        top, at = (0, 0, 0), 0
        score = 0
        for e, x in enumerate(eq):
            if score <= 0:
                score, at = 0, e
            score += 1 if x else -2
            if score > top[0]:
                top = (score, at, e + 1)
        n, length = sum(eq[top[1]:top[2]]), top[2] - top[1]
        least = min(D.MIN_MATCHES, len(item))
        if n < least or 5 * n < 4 * length:
            n = all_stretches(eq, least) if sum(eq) >= least else 0
        found = max(found, n)
    return found


def test_driver_documents_equal_brute_force(spark):
    docs, bench = (read_table(spark, "/root/testdata/sf0.001", t) for t in ("documents", "benchmark"))
    items = {r.item_id: words(r.text) for r in bench.collect()}
    want = {}
    for r in docs.collect():
        w = words(r.text)
        grams = {x for x in zip(w, w[1:], w[2:])}
        # three equal words in a row are necessary for an accepted overlap
        n = {i: best(w, x) for i, x in items.items() if any(g in grams for g in zip(x, x[1:], x[2:]))}
        want[r.doc_id] = (sorted(i for i, v in n.items() if v), max(n.values(), default=0))
    got = {r.doc_id: (r["items"], r.matches) for r in D.decontaminate(docs, bench).collect()}
    assert got == want
    assert any(v[0] for v in want.values())


@pytest.mark.parametrize("block_words", [D.BLOCK_WORDS, 40])
def test_substitutions_and_edges(spark, block_words):
    rng = random.Random(2)
    vocab = [f"v{i}" for i in range(5000)]
    item = {i: [rng.choice(vocab) for _ in range(n)] for i, n in enumerate([40, 25, 13, 7, 5, 4])}
    fill = lambda n: [rng.choice(vocab) for _ in range(n)]

    def changed(w, every):
        return [("zz" if i % every == every - 1 else x) for i, x in enumerate(w)]
    texts = {1: fill(50) + item[0] + fill(9), 2: fill(3) + changed(item[0], 7), 3: changed(item[0], 2), 4: fill(200),
             5: fill(10) + item[1][5:20], 6: fill(10) + item[1][5:15], 7: item[2] + item[0], 8: fill(4) + item[3] + fill(4),
             9: item[4], 10: item[5] + fill(3), 11: fill(60_000) + item[2] + fill(60_000), 12: item[2][:6] + ["new"] + item[2][6:]}
    rows = [(i, ", ".join(w).upper(), "x") for i, w in texts.items()] + [(13, None, "x"), (14, "", "x"), (None, " ".join(item[0]), "x"),
                                                                          (1, ", ".join(texts[1]), "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, items string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in item.items()] + [(0, " ".join(item[0])), (None, "a b c d e f"), (9, None)],
                                  "item_id long, text string")
    found = D.contaminated(docs, bench, block_words=block_words)
    got = sorted((r.doc_id or 0, tuple(x.item_id for x in r["__items"])) for r in found.collect())
    assert got == sorted([(0, (0,)), (1, (0,)), (1, (0,)), (2, (0,)), (3, ()), (4, ()), (5, (1,)), (6, ()), (7, (0, 2)), (8, (3,)), (9, (4,)),
                          (10, ()), (11, (2,)), (12, ()), (13, ()), (14, ())])
    out = D.decontaminate(docs, bench)
    assert out.columns == ["doc_id", "contaminated", "items", "matches"]
    assert D.decontaminate(docs.limit(0), bench).count() == 0
    assert not any(r.contaminated for r in D.decontaminate(docs, bench.limit(0)).collect())


def test_long_items_are_cut_with_overlap(monkeypatch):
    monkeypatch.setattr(D, "PIECE_WORDS", 60)
    monkeypatch.setattr(D, "OVERLAP", 20)
    import pyarrow as pa
    text = " ".join(f"w{i}" for i in range(200))
    out = next(D._pieces(iter([pa.RecordBatch.from_arrays([pa.array([1]), pa.array([text])], ["i", "t"])])))
    n = [len(x) for x in out.column(1)]
    assert n[0] == 60 and sum(n) - 20 * (len(n) - 1) == 200


def least_stretches():
    """All patterns of equal (1) and other words that qualify and hold no shorter one that does. A split of
    such a pattern leaves one side that does not fall short in share, so with fewer than 13 equal words:
    it has at most 25 of them, in at most 31 words."""
    for length in range(13, 32):
        for m in range(length // 5 + 1):
            n = length - m
            if 13 <= n <= 25:
                out = np.array(list(itertools.combinations(range(1, length - 1), m)), dtype=int)
                eq = np.ones((len(out), length), dtype=int)
                eq[np.arange(len(out))[:, None], out] = 0
                c, size = eq.cumsum(axis=1)[:, :-1], np.arange(1, length)
                shorter = ((c >= 13) & (5 * c >= 4 * size)) | ((n - c >= 13) & (5 * (n - c) >= 4 * (length - size)))
                yield from eq[~shorter.any(axis=1)]


def test_masks_meet_every_qualifying_stretch():
    n = 0
    for eq in least_stretches():
        n += 1
        text = "".join(map(str, eq))
        assert any(all(text[at + i] == "1" for i, c in enumerate(mask) if c == "1")
                   for mask in D.MASKS for at in range(len(text) - len(mask) + 1)), text
    assert n == 2487


@pytest.mark.parametrize("size,equal", [(13, 13), (14, 13), (15, 13), (16, 13), (17, 14), (18, 15), (20, 16), (25, 20), (40, 32), (100, 80)])
def test_recall_by_length(size, equal):
    rng = np.random.default_rng(size)
    item = rng.integers(1, 1 << 60, size).astype(np.uint64)
    index = D.SeedIndex([(1, item)])
    docs = []
    for _ in range(300):
        w = item.copy()
        w[rng.choice(size, size - equal, replace=False)] = rng.integers(1, 1 << 60, size - equal)
        docs.append(np.concatenate([rng.integers(1, 1 << 60, 9).astype(np.uint64), w]))
    first = np.concatenate([[0], np.cumsum([len(w) for w in docs])])
    assert {x[0] for x in index.overlaps(np.concatenate(docs), first, 13, 0.8)} == set(range(300))


def test_repeated_words_in_bounded_memory():
    one, two, three = np.uint64(5), np.uint64(6), np.uint64(7)
    items = [(1, np.full(1000, one)), (2, np.tile([one, two, three], 200)), (3, np.tile([two, two, three], 300))]
    index = D.SeedIndex(items)
    w = np.concatenate([np.full(100_000, one), np.tile([one, two, three], 3_000)])
    first = np.array([0, 100_000, len(w)])
    tracemalloc.start()
    got = {}
    for doc, k, n, length in index.overlaps(w, first, 13, 0.8):
        got[doc, k] = max(got.get((doc, k), (0, 0)), (n, length))
    assert tracemalloc.get_traced_memory()[1] < 500 << 20
    tracemalloc.stop()
    assert got == {(0, 0): (1000, 1000), (1, 1): (600, 600)}


def test_masks_ignore_their_zeros():
    for mask in D.MASKS:
        w = np.arange(1, len(mask) + 1, dtype=np.uint64)
        x = w.copy()
        x[[i for i, c in enumerate(mask) if c == "0"]] = 99
        assert (D.seeds(w, mask) == D.seeds(x, mask)).all()
        x[mask.index("1")] = 99
        assert D.seeds(w, mask)[0] != D.seeds(x, mask)[0]


def all_stretches(equal, least):
    """Most equal words of any stretch that qualifies."""
    return max((n for i in range(len(equal)) for j in range(i + 1, len(equal) + 1)
                if (n := sum(equal[i:j])) >= least and 5 * n >= 4 * (j - i)), default=0)


def test_every_stretch_is_tested():
    rng = random.Random(7)
    for share in (0.5, 0.7, 0.75, 0.8, 0.85):
        for _ in range(12):
            equal = [rng.random() < share for _ in range(rng.randrange(1, 70))]
            n, length = D.longest(np.array(equal), 13, 0.8)
            assert n == all_stretches(equal, 13) and 5 * n >= 4 * length


def test_passage_within_a_longer_unlike_one(spark):
    rng = random.Random(3)
    vocab = [f"v{i}" for i in range(5000)]
    item = [rng.choice(vocab) for _ in range(100)]
    text = item[:20] + [("zz" if i % 10 in (0, 3, 6) else w) for i, w in enumerate(item[20:])]
    docs = spark.createDataFrame([(1, " ".join(text)), (2, " ".join(text[20:]))], "doc_id long, text string")
    bench = spark.createDataFrame([(5, " ".join(item))], "item_id long, text string")
    got = {r.doc_id: (r["items"], r.matches) for r in D.decontaminate(docs, bench).collect()}
    eq = [a == b for a, b in zip(text, item)]
    assert got[1] == ([5], all_stretches(eq, 13)) and (got[2][0] == [5]) == bool(all_stretches(eq[20:], 13))
