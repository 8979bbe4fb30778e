import random
import re
import zlib
from collections import Counter

from gridflow.llm import variants as V
from gridflow.sources.tables import read_table

KIND = "doc_id long, text string, n int, word string"


def brute_words(rows):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}


def one_edit(a, b):
    if len(a) < len(b):
        a, b = b, a
    if a == b or len(a) - len(b) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def brute_pairs(words):
    by_length = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    return {(a, b) for a in words for size in (len(a), len(a) - 1) for b in by_length.get(size, ())
            if (len(b) < len(a) or a < b) and one_edit(a, b)}


def brute(rows):
    n = brute_words(rows)
    near = {w: [] for w in n}
    for a, b in brute_pairs(n):
        near[a].append(b)
        near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), None if form[w] is None else n[form[w]]))
    return out


def result(spark, rows):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], KIND).repartition(3)
    out = V.spelling_variants(df)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_driver_documents_equal_brute_force(spark):
    docs = read_table(spark, "/root/testdata/sf0.001", "documents", ["doc_id", "text"])
    got = [tuple(r) for r in V.spelling_variants(docs).collect()]
    want = brute([tuple(r) for r in docs.collect()])
    assert set(got) == want and len(got) == len(want) and any(x[1] for x in want)


def close_words(rng):
    """Words close to each other, long runs of equal letters included."""
    heads, tails = ["color", "colour", "aaaaaa", "übergäng", "münchén", "zz×÷zzz"], ["", "s", "ed", "eed", "aa", "aaaaaaaa"]
    out = set()
    for _ in range(260):
        w = rng.choice(heads) + rng.choice(tails)
        at = rng.randrange(len(w))
        out.add(rng.choice([w, w[:at] + w[at + 1:], w[:at] + rng.choice("abcéa") + w[at:], w[:at] + rng.choice("abcé") + w[at + 1:]]))
    return sorted(w for w in out if len(w) >= 6)


def test_pairs_equal_brute_force_with_large_groups(spark, monkeypatch):
    words = close_words(random.Random(3))
    df = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, n long").repartition(3)
    for group in (128, 3, 0):  # 0: every group is halved as long as it can be
        monkeypatch.setattr(V, "GROUP", group)
        got = [(r.a, r.b) for r in V.near_pairs(df).collect()]
        assert set(got) == brute_pairs(words) and len(got) == len(set(got))


def test_forms_and_chains_equal_brute_force(spark):
    rng = random.Random(8)
    rows = []
    for k, w in enumerate(close_words(rng)[:60]):
        for j in range(rng.choice([4, 5, 6, 30, 160])):
            rows.append((rng.choice([None, k, j, j]), rng.choice([w, w.upper() if w.isascii() else w]) + rng.choice([" ", "1", "’ a b", "\n"]) * 2))
    rows += [(i, " ".join(["kittens"] * 5 + ["mittens"] * 30 + ["mittent"] * 160 + ["bittent"] * 900)) for i in (1, 1, 2)]
    got = result(spark, rows)
    assert got == brute(rows)
    assert max(Counter(x[2] for x in got).values()) > 2 and any(x[1] not in (None, x[2]) for x in got)


def test_edge_rows(spark):
    assert result(spark, []) == set()
    assert result(spark, [(1, None), (None, ""), (2, "short words only here"), (3, "lonely")]) == set()
    long = "ab" * 60_000
    rows = [(i, t) for i in range(6) for t in (long, long[:70_001] + "x" + long[70_001:], "word " * 300_000 + "ending")]
    got = result(spark, rows)
    assert {(len(x[0]), x[3], x[4]) for x in got} >= {(len(long), 6, 1), (len(long) + 1, 6, 1)}


def test_pieces_end_where_runs_end(monkeypatch):
    monkeypatch.setattr(V, "PIECE", 7)
    text = "abc defghijklm nop  q" * 9 + "xyz" * 20
    assert "".join(V.pieces(text)) == text
    assert [r for p in V.pieces(text) for r in V.RUN.findall(p)] == V.RUN.findall(text)
