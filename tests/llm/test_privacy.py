import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from gridflow.llm import privacy as P
from gridflow.llm import privacy_examples as X
from gridflow.sources.tables import read_table

# the contract's patterns as they stand
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_base(text):
    digits = lambda t: [int(c) for c in t if c in "0123456789"]

    def luhn(d):
        return sum(x if i % 2 == 0 else sum(map(int, str(2 * x))) for i, x in enumerate(reversed(d))) % 10 == 0

    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]


def want(doc_id, text):
    base = brute_base(text or "")
    joined = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
    return (doc_id, *[sum(x[0] == k for x in base) for k in P.BASE_KINDS], hashlib.sha256(joined.encode()).hexdigest())


@pytest.fixture(scope="module")
def field():
    return P.fit(X.examples())


def test_patterns_equal_plain_regular_expressions():
    rng = random.Random(5)
    parts = ["a", "b.c", "@", "@", ".", ".", "-", "%", "é", " ", "(", ")", "+", "+1", "12", "255", "256", "007", "0", "4111111111111111", "4111 1111", "1111-1111", "\n", "x@y.z"]
    for _ in range(6000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(16)))
        assert P.base_spans(text) == brute_base(text), repr(text)


def test_words_equal_a_plain_tokenizer():
    rng = random.Random(2)
    parts = ["Anna", "ßé", "ABC", "aBc", "12", "٣٤", "&", "-", " ", "\n", "\t", "中文", "\U0001F600", "\U00020000a", "É", "x", "_"]
    for _ in range(2000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(12)))
        group = lambda c: "l" if c.isalpha() or ord(c) > 0xFFFF else "d" if c in "0123456789" else "s"
        out, line = [], 0
        for i, c in enumerate(text):
            line += c == "\n"
            if c.isspace():
                continue
            if out and out[-1][1] == i and group(c) != "s" and group(text[i - 1]) == group(c):
                out[-1][1] = i + 1
            else:
                out.append([i, i + 1, line])
        w = P.words_of(text)
        assert list(zip(w.start, w.end)) == [(s, e) for s, e, _ in out], repr(text)
        gaps = [b - a for a, b in itertools.pairwise(w.place.tolist())]
        assert gaps == [1 if x[2] == y[2] else 1 + P.REACH for x, y in itertools.pairwise(out)]
        names = [text[s:e].lower() for s, e, _ in out]
        for (a, x), (b, y) in itertools.combinations(zip(names, w.hash), 2):
            if not a.isdecimal() and not b.isdecimal():
                assert (a == b) == (x == y)


def paths(e, turn):
    for y in itertools.product(range(P.K), repeat=len(e)):
        full = (0, *y, 0)
        yield y, sum(turn[a, b] for a, b in itertools.pairwise(full)) + sum(e[i, k] for i, k in enumerate(y))


def test_decoding_and_likelihood_equal_all_paths():
    rng = np.random.default_rng(7)
    turn = rng.normal(size=(P.K, P.K)) * 2
    first, length = np.array([1, 4, 9, 11]), np.array([2, 4, 1, 5])
    e = rng.normal(size=(18, P.K)) * 2
    out = np.zeros(18, dtype=np.int64)
    P.viterbi(e, turn, first, length, out)
    total, p, turns = P.likelihood(e, turn, first, length)
    logs, probs, expected = 0, np.zeros_like(e), np.zeros_like(turn)
    for f, n in zip(first, length):
        found = list(paths(e[f:f + n], turn))
        assert tuple(out[f:f + n]) == max(found, key=lambda x: x[1])[0]
        z = np.logaddexp.reduce([s for _, s in found])
        logs += z
        for y, s in found:
            q = np.exp(s - z)
            probs[np.arange(f, f + n), y] += q
            for a, b in itertools.pairwise((0, *y, 0)):
                expected[a, b] += q
    assert abs(total - logs) < 1e-8 and np.allclose(p[np.concatenate([np.arange(f, f + n) for f, n in zip(first, length)])],
                                                    probs[np.concatenate([np.arange(f, f + n) for f, n in zip(first, length)])])
    assert np.allclose(turns, expected)


def test_settled_words_do_not_change_the_decoding(field):
    texts = [t for t, _ in X.examples(seed=9, fills=2, plain=100)]
    w = P.words_of("\n".join(texts))
    e = field.emissions(*field.ids(w))
    inside = np.zeros(w.places, dtype=np.int8)
    inside[w.place] = 1
    edge = np.diff(inside, prepend=0, append=0)
    first = np.flatnonzero(edge == 1)
    out = np.zeros(w.places, dtype=np.int64)
    P.viterbi(e, field.turn, first, np.flatnonzero(edge == -1) - first, out)
    assert (out[w.place] == field.labels(w)).all() and out.any()


def test_held_out_accuracy(field):
    hit = wrong = missed = 0
    for text, spans in X.examples(seed=77, fills=4, plain=300):
        got, right = set(P.added_spans(text, field)), set(spans)
        hit, wrong, missed = hit + len(got & right), wrong + len(got - right), missed + len(right - got)
    assert hit / (hit + wrong) > 0.9 and hit / (hit + missed) > 0.9


def test_clean_documents_are_left_alone(spark, field):
    texts = [r.text for r in read_table(spark, "/root/testdata/sf0.01", "documents", ["text"]).collect()]
    found = P.spans(texts, field)
    assert [[x for x in f if x[0] in P.BASE_KINDS] for f in found] == [brute_base(t) for t in texts]
    assert sum(any(x[0] in P.ADDED_KINDS for x in f) for f in found) <= len(texts) // 100


def test_driver_documents_equal_brute_force(spark):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    out = P.digest(docs, X.labelled_table(spark))
    assert out.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    rows = out.collect()
    assert {tuple(r)[:6] for r in rows} == {want(r.doc_id, r.text) for r in docs.collect()} and len(rows) == docs.count()


def test_batches_and_pieces_do_not_matter(field, monkeypatch):
    texts = [t for t, _ in X.examples(seed=4, fills=1, plain=40)] + ["", "\n\n", "x"]
    alone = [P.spans([t], field)[0] for t in texts]
    assert P.spans(texts, field) == alone and any(x[0] == "person" for f in alone for x in f)
    whole = P.spans(["\n".join(texts)], field)[0]
    monkeypatch.setattr(P, "PIECE", 400)
    assert max(map(len, texts)) < 400
    assert P.spans(["\n".join(texts)], field)[0] == whole
    assert "".join(p for _, p in P.pieces("ab c\n" * 300 + "x" * 1500)) == "ab c\n" * 300 + "x" * 1500


def test_pattern_spans_stay(field):
    text = "Phone: +1 (523) 555-1055 or Tel. 020 7946 0958"
    assert P.spans([text], field)[0][0] == ("phone", 7, 24)
    for t in [t for t, _ in X.examples(seed=6, fills=2, plain=50)]:
        found = P.spans([t], field)[0]
        base = [x for x in found if x[0] in P.BASE_KINDS]
        assert base == brute_base(t) and found == sorted(found, key=lambda x: (P.KINDS.index(x[0]), x[1]))
        assert not any(a[1] < b[2] and b[1] < a[2] for a in base for b in found if b[0] in P.ADDED_KINDS)


def test_very_long_texts_take_linear_time(field):
    # plain regular expressions would take hours here
    text = "1" * 400_000 + "@" * 50_000 + "a" * 300_000 + " +1" + " " * 200_000 + "1." * 200_000 + " é" * 400_000 + " b@c.d"
    assert [x[0] for x in P.base_spans(text) if x[0] == "email"] == ["email"]
    assert [x for x in P.spans([text], field)[0] if x[0] in P.BASE_KINDS] == P.base_spans(text)


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (None, "Mr. Peter Novak, a.b@c.de"), (3, "1" * 900 + "@" * 500 + "+1" + " " * 900 + "1.1.1.1"),
            (3, "no data"), (3, "no data"), (4, "x퟿ü 4111-1111-1111-1111\n" * 3000), (5, "a " * 70_000 + "b@c.d")]
    docs = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, s int, spans string")
    labelled = X.labelled_table(spark)
    out = P.digest(docs, labelled).collect()
    assert sorted((tuple(r)[:6] for r in out), key=str) == sorted((want(*r) for r in rows), key=str)
    assert any("person:4:15" in r.spans for r in out if r.doc_id is None)
    assert P.digest(docs.limit(0), labelled).count() == 0
    untrained = P.digest(docs.where("doc_id = 4"), labelled.limit(0)).first()
    assert untrained.n_card == 3000 and "person" not in untrained.spans
    odd = spark.createDataFrame([(None, None), ("x y", None), ("Mr X", [("other", 0, 1), (None, None, None), None])],
                                "text string, spans array<struct<kind:string,start:long,end:long>>")
    assert P.digest(docs, odd).count() == len(rows)
    assert P.scanned(docs, P.train(odd), out="new").columns == [*docs.columns, "new"]
