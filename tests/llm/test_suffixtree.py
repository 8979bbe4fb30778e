import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from gridflow.llm import suffixtree as S
from gridflow.sources.tables import read_table


def toks(text):
    return (text or "").encode().lower().split() + [S.END]


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0


def brute_base(rows):
    c = Counter(t for i, x in rows if not held(i) for t in toks(x))
    n, v = sum(c.values()), len(c)
    return [(i, held(i), len(toks(x)), sum(c[t] > 0 for t in toks(x)), n,
             sum(math.log10((c[t] + 0.1) / (n + 0.1 * (v + 1))) for t in toks(x))) for i, x in rows]


def compare(df, rows):
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in df.collect()), key=str)
    want = sorted(brute_base(rows), key=str)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [(g, w) for g, w in zip(got, want) if abs(g[5] - w[5]) > 1e-9 * abs(w[5]) + 1e-7] == []


@pytest.mark.parametrize("head", [S.HEAD_WORDS, 50, 0])
def test_base_scores_equal_brute_force(spark, monkeypatch, head):
    monkeypatch.setattr(S, "HEAD_WORDS", head)
    docs = read_table(spark, "/root/testdata/sf0.001", "documents")
    compare(S.score_texts(docs), [(r.doc_id, r.text) for r in docs.collect()])


def test_held_out_texts_are_likelier_than_by_words(spark):
    docs = read_table(spark, "/root/testdata/sf0.1", "documents").select("doc_id", "text")
    r = S.score_texts(docs).where("held_out").selectExpr("sum(score) s", "sum(base_score) b", "max(score) m").first()
    assert r.b < 1.05 * r.s < 0 and r.m < 0


def brute_tree(texts, words, monkey):
    """The tree by plain dictionaries, as the definition says: kept contexts and P(symbol | context)."""
    n = sum(words.values())
    alphabet = {w for w, c in words.items() if c >= n * S.LEAST_SHARE and w != S.END}
    sym = lambda w: w if w in alphabet or w == S.END else None
    count = Counter()
    for w, c in words.items():
        count[sym(w)] += c
    once = max(1, sum(c == 1 for c in words.values()))
    root = {s: c / (n + once) for s, c in count.items()}
    root[None] = (count[None] + once) / (n + once)
    following = defaultdict(Counter)
    for t in texts:
        s = [S.END] + [sym(w) for w in toks(t)]
        for i in range(1, len(s)):
            for d in range(1, min(S.DEPTH, i) + 1):
                following[tuple(s[i - d:i])][s[i]] += 1
    least = max(2, n * S.LEAST_ENTRY)
    total = {u: sum(x.values()) for u, x in following.items()}
    own = {u: {s: k for s, k in x.items() if k >= least} for u, x in following.items()}

    def considered(u):
        return len(u) == 1 or (u[:-1] in total and considered(u[:-1]) and own[u[:-1]].get(u[-1], 0) >= n * S.LEAST_SHARE)

    def prob(u, s, states):
        if not u:
            return root[s]
        lower = prob(u[1:], s, states)
        if states is not None and u not in states:
            return lower
        kinds = len(own[u]) + (sum(own[u].values()) < total[u])
        return (own[u].get(s, 0) + (kinds + total[u] - sum(own[u].values())) * lower) / (total[u] + kinds)
    kept = set()
    for u in [u for u in total if considered(u)]:
        p = {s: prob(u[1:], s, None) for s in own[u]}
        nats = sum(k / total[u] * math.log(k / total[u] / p[s]) for s, k in own[u].items())
        mine, theirs = 1 - sum(own[u].values()) / total[u], 1 - sum(p.values())
        if mine > 0:
            nats += mine * math.log(max(mine, 1e-12) / max(theirs, 1e-12))
        kinds = len(own[u]) + (sum(own[u].values()) < total[u])
        if total[u] >= n * S.LEAST_SHARE and nats >= S.LEAST_DIVERGENCE and nats * total[u] > kinds * math.log(max(total[u], 2)):
            kept |= {u[i:j] for i in range(len(u)) for j in range(i + 1, len(u) + 1)}
    others = count[None] + once

    def score(t):
        s = [S.END] + [sym(w) for w in toks(t)]
        out = 0.0
        for i, w in enumerate(toks(t), 1):
            u = next((u for d in range(min(S.DEPTH, i), 0, -1) if (u := tuple(s[i - d:i])) in kept), ())
            out += math.log10(prob(u, s[i], kept))
            if s[i] is None:
                out += math.log10((words.get(w) or once) / others)
        return out
    return kept, score, prob, root


@pytest.mark.parametrize("head", [S.HEAD_WORDS, 60])
def test_scores_equal_plain_dictionaries(spark, monkeypatch, head):
    monkeypatch.setattr(S, "HEAD_WORDS", head)
    for name, value in (("LEAST_SHARE", 1e-3), ("LEAST_ENTRY", 2e-4), ("LEAST_DIVERGENCE", 0.05)):
        monkeypatch.setattr(S, name, value)
    docs = read_table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    texts = [x for i, x in rows if not held(i)]
    kept, score, prob, root = brute_tree(texts, Counter(t for x in texts for t in toks(x)), monkeypatch)
    assert len({len(u) for u in kept}) == 3
    assert all(abs(sum(prob(u, s, kept) for s in root) - 1) < 1e-9 for u in list(kept)[:50])
    got = {r.doc_id: r.score for r in S.score_texts(docs).collect()}
    assert got.keys() == dict(rows).keys()
    assert all(abs(got[i] - score(x)) < 1e-7 * abs(got[i]) for i, x in rows)


def test_edge_rows(spark):
    rows = [(1, "a b A"), (2, None), (3, ""), (None, "a c"), (4, "a b A"), (4, "a b A"), (15, "long " * 100_000 + "x" * 5000), (5, "\t\n ")]
    docs = spark.createDataFrame([(i, t, 1, "w") for i, t in rows], "doc_id long, text string, c int, word string")
    out = S.score_texts(docs)
    assert out.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    compare(out, rows)
    assert all(r.score < 0 and math.isfinite(r.score) for r in out.collect())
    assert S.score_texts(docs.limit(0)).count() == 0
    none = docs.where("doc_id is null")
    compare(S.score_texts(none), [(None, "a c")])


@pytest.mark.parametrize("grams", [S.HEAD_GRAMS, 300])
def test_model_grows_with_the_corpus(spark, monkeypatch, grams):
    """Beyond REFERENCE tokens the least counts stand still; frequent grams are broadcast, the others joined."""
    for name, value in (("REFERENCE", 10_000), ("LEAST_SHARE", 2e-3), ("LEAST_ENTRY", 4e-4), ("HEAD_GRAMS", grams), ("HEAD_WORDS", 60)):
        monkeypatch.setattr(S, name, value)
    docs = read_table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    texts = [x for i, x in rows if not held(i)]
    words = Counter(t for x in texts for t in toks(x))
    n = sum(words.values())
    assert S.least_counts(n) == S.least_counts(100 * n) == (20, 4)
    got = {r.doc_id: r.score for r in S.score_texts(docs).collect()}
    monkeypatch.setattr(S, "LEAST_SHARE", 20 / n)
    monkeypatch.setattr(S, "LEAST_ENTRY", 4 / n)
    _, score, _, _ = brute_tree(texts, words, monkeypatch)
    assert all(abs(got[i] - score(x)) < 1e-7 * abs(got[i]) for i, x in rows)


@pytest.mark.parametrize("wide", [False, True])
def test_packed_grams_sum_like_a_counter(wide):
    """Occurrences packed by several tasks: the grams and counts of a counter, in few bytes each."""
    rng, total, pieces, size = np.random.default_rng(3), Counter(), [], 0
    top = 1 << (64 if wide else 20)
    pool = rng.integers(0, top, (20_000, 2), dtype=np.uint64)
    for k in range(3):
        some = pool[rng.integers(0, len(pool), 30_000) // (1 + k)]
        total.update(map(tuple, some.tolist()))
        ctx, suf, n = S._sums(some[:, 0].copy(), some[:, 1].copy(), None, not wide)
        data = S._packed(ctx, suf, n)
        assert [x.tolist() for x in S._unpacked(data)] == [x.tolist() for x in (ctx, suf, n)]
        size += len(ctx)
        assert len(data) <= len(ctx) * (18 if wide else 7) + 7
        pieces.append(S._unpacked(data))
    got = S._sums(*(np.concatenate([x[i] for x in pieces]) for i in range(3)), not wide)
    assert {(a, b): c for a, b, c in zip(*(x.tolist() for x in got))} == dict(total)
    assert size > len(total)


def test_grams_are_shuffled_packed(spark, monkeypatch):
    """A shuffled row holds a part's grams, not one gram; the least count is applied to their sums."""
    alphabet = spark.sparkContext.broadcast(np.unique(S.words64(b"a b c d")[0]))
    names = [spark.sparkContext.broadcast(np.concatenate([np.array([S.OTHER, S.END_SYMBOL]), alphabet.value]))] * 2
    texts = spark.createDataFrame([("a b c d x",), ("b c a b",), (None,)], "text string").selectExpr("text", "cast(null as array<long>) extra").repartition(3)
    for two in (names, [None, None]):
        packed = texts.mapInArrow(S._count_grams(2, alphabet, None, None, two, 2), "part long, grams binary")
        assert packed.count() <= 6
        got = packed.groupBy("part").applyInArrow(S._sum_grams(2, two, 2), "key long, ctx long, suf long, n long").collect()
        word = {w: int(S.words64(w.encode())[0].view(np.int64)[0]) for w in "abcd"}
        assert sorted((r.ctx, r.suf, r.n) for r in got) == sorted([(word["a"], word["b"], 2), (word["b"], word["c"], 2)])


def test_uses_of_infrequent_grams_come_once_a_text():
    """A text's gram comes once with its uses, as two lists of numbers."""
    rest = [tuple(np.array(x) for x in ([1, 0, 1], np.array([7, 2**63 + 5, 7], dtype=np.uint64), [1, 1, 1], [0, 0, 0])),
            tuple(np.array(x) for x in ([1, 1], np.array([7, 9], dtype=np.uint64), [0, 0], [1, 1]))]
    keys, uses = S._uses(rest, 3)
    assert keys.to_pylist() == [[5 - 2**63], [7, 9], []] and uses.to_pylist() == [[1 << 32], [(2 << 32) + 1, 1], []]
    assert [x.to_pylist() for x in S._uses([], 2)] == [[[], []], [[], []]]


def test_words_are_shuffled_packed(spark):
    """A shuffled row holds a part's words, not one word; they sum up to a counter's counts, without texts to none."""
    rows = [f"w{i % 70} W{i % 9} \u00c9t\u00e9\tw{i}" for i in range(300)] + [None, "", " \n "]
    texts = spark.createDataFrame([(x,) for x in rows], "text string").repartition(3)
    packed = texts.mapInArrow(S._count_words(2), "part long, words binary, n long")
    assert packed.count() <= 6
    want = Counter(t for x in rows for t in toks(x))
    got = packed.groupBy("part").applyInArrow(S._sum_words, "word binary, c long").collect()
    assert {bytes(r.word): r.c for r in got} == want and len(got) == len(want)
    assert {bytes(r.word): r.c for r in S.word_counts(texts).collect()} == want
    assert S.word_counts(texts.limit(0)).count() == 0


@pytest.mark.parametrize("n", [0, 1, 5, 70_000])
def test_keys_are_found_like_by_search(n):
    """Spread keys, the two small symbols and keys that share their high bits are found at their places, others are not."""
    rng = np.random.default_rng(n)
    some = rng.integers(0, 1 << 64, n, dtype=np.uint64)
    for keys in (some, some & np.uint64(0xFFFFF), some | np.uint64(0xFFFFFFFFF << 28)):
        keys = np.unique(np.concatenate([keys, np.array([0, 1], np.uint64)[:n]]))
        x = np.concatenate([keys, keys + np.uint64(1), rng.integers(0, 1 << 64, 1000, dtype=np.uint64), np.array([0, 1, 2**64 - 1], np.uint64)])
        assert S.Keys(keys).find(x).tolist() == S._find(keys, x).tolist()


def test_filter_passes_all_infrequent_grams_and_few_others(spark, monkeypatch):
    monkeypatch.setattr(S, "FILTER_BITS", 1 << 16)
    rng = np.random.default_rng(1)
    keys, others = rng.integers(0, 1 << 64, (2, 2000), dtype=np.uint64)
    bits = S._bitmap(spark.createDataFrame([(int(k),) for k in S.signed(keys)], "key long"))
    none = np.empty(0)
    scorer = S.Scorer(none, none, none, none, none, none, False, bits, 0, 1, 0.0)
    assert scorer.maybe(keys).all() and scorer.maybe(others).sum() < 2000 * 0.015
