import hashlib
import random
import re

from gridflow.llm import secrets as S
from gridflow.sources.tables import read_table


def brute(text):
    text = text or ""
    out = [("assign", m.start(), m.end()) for m in S.ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [("access", m.start(), m.end()) for m in S.ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [("hex", m.start(), m.end()) for m in S.HEX.finditer(text) if len(m[0]) >= 24]
    return sorted(out, key=lambda x: (x[1], S.BASE_KINDS.index(x[0])))


def want(doc_id, text):
    b = brute(text)
    s = ",".join(f"{k}:{i}:{j}" for k, i, j in b)
    return (doc_id, *[sum(x[0] == k for x in b) for k in S.BASE_KINDS], hashlib.sha256(s.encode()).hexdigest())


def test_driver_documents_equal_brute_force(spark):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    got = {tuple(r)[:5] for r in S.digest(docs).collect()}
    assert got == {want(r.doc_id, r.text) for r in docs.collect()}
    assert sum(x[1] + x[2] + x[3] for x in got) > 0


def test_random_texts_equal_brute_force():
    rng = random.Random(11)
    parts = ["password", "PassWd", "secret", "TOKEN", "api_key", "apikey", "api__key", "AKIA", "AKIAAKIA", "akia", "0123456789abcdef", "abcdef01", "=", ":", " ",
             "'", '"', "\n", "é", "ſecret", "toKen", "İ", "A1B2C3D4E5F6G7H8", "x/y+z", "ab", "-", "ghp_", "ß"]
    keywords = S.automaton()
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(14)))
        assert [x for x in S.spans(text, keywords) if x[0] in S.BASE_KINDS] == brute(text), repr(text)


def test_checksums():
    keywords = S.automaton()
    payload = "abcdefghij0123456789ABCDEFGHIJ"
    good = "ghp_" + payload + S.checksum(payload)
    bad = "npm_" + payload + "000000"
    assert len(good) == 40 and re.fullmatch("[0-9A-Za-z]{6}", S.checksum(payload))
    text = f"é {good} {bad} npm_{payload}{S.checksum(payload)}x"
    assert S.spans(text, keywords) == [("github", 2, 42)]


def test_edge_rows(spark):
    key = "AKIA" + "A" * 16
    rows = [(1, None), (2, ""), (None, f"é{key}"), (3, "x" * 300_000 + " token=abcdef"), (3, "no secret"), (3, "no secret"),
            (4, "password=deadbeefdeadbeefdeadbeef end")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, s int")
    out = S.digest(docs)
    assert out.columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    assert sorted((tuple(r)[:5] for r in out.collect()), key=str) == sorted((want(*r) for r in rows), key=str)
    assert S.digest(docs.limit(0)).count() == 0
    red = {(r.doc_id, r.text) for r in S.redacted(docs).collect()}
    assert (None, "é[SECRET]") in red and (4, "[SECRET] end") in red and (1, None) in red and (3, "no secret") in red
