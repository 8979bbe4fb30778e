import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from gridflow.llm import packing as P
from gridflow.sources.tables import read_table

EXACT = Tokenizer.from_file(public_tokenizers.path(P.VOCABULARY))


def ids_of(text):
    return EXACT.encode(text or "", add_special_tokens=False).ids + [P.END_ID]


def check(rows, texts, size=P.WINDOW):
    """Exact round trip: pieces rebuild every document, sequences are gapless; returns the padding share."""
    docs, seqs = {}, {}
    for r in rows:
        docs.setdefault(r.doc_id, []).append(r)
        seqs.setdefault(r.sequence_id, []).append(r)
        assert zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length > 0
    assert set(docs) == set(texts)
    total = 0
    for k, text in texts.items():
        want = ids_of(text)
        pieces = sorted(docs[k], key=lambda r: r.start)
        assert [x for p in pieces for x in p.ids] == want
        assert all(p.doc_tokens == len(want) for p in pieces)
        at = 0
        for p in pieces:
            assert p.start == at
            at += p.length
        total += len(want)
    for s in seqs.values():
        at = 0
        for p in sorted(s, key=lambda r: r.offset):
            assert p.offset == at
            at += p.length
        assert at <= size
    return 1 - total / (len(seqs) * size)


def test_driver_documents_round_trip(spark):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert check(P.pack(docs).collect(), texts) < 0.01


def test_edge_rows(spark):
    texts = {1: None, 2: "", 3: "x " * 50_000, 4: "a<|endoftext|>b", 5: "語" * 5000 + "  \u0085 x", 6: "x" * 3000}
    docs = spark.createDataFrame([(i, t, 1) for i, t in texts.items()], "doc_id long, text string, start int").repartition(3)
    check(P.pack(docs).collect(), texts)
    out = P.pack(docs, with_ids=False)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert P.pack(docs.limit(0)).count() == 0
    two = spark.createDataFrame([(None, "a b"), (7, "a b"), (7, "a b")], "doc_id long, text string")
    r = P.pack(two).collect()
    assert sorted((x.doc_id is None, x.length) for x in r) == [(False, 3), (False, 3), (True, 3)]


def test_fast_path_equals_the_exact_one():
    encode = P.encoder()
    rng = random.Random(1)
    chars = [chr(c) for c in range(1, 0x280)]
    mixed = [" ", "\n", "\t", "\r", "\x0b", "\x1c", "\x85", "\xa0", "'s", "'LL", "a", "é", "9", "²", "½", "!", "\xad"]
    for _ in range(1500):
        text = "".join(rng.choice(chars if rng.random() < 0.3 else mixed) for _ in range(rng.randrange(40)))
        assert encode(text.encode()).tolist() + [P.END_ID] == ids_of(text), repr(text)


def test_level_minimises_the_sum_of_squares():
    rng = random.Random(4)
    p = P.Packer(12)
    for step in range(400):
        n = rng.randrange(1, 12)
        best = None
        for h in range(12 - n + 1):
            c = p.counts.copy()
            if h and not c[h]:
                continue
            c[h] -= h > 0
            if h + n < 12:
                c[h + n] += 1
            best = min(best, (int((c[1:12] ** 2).sum()), -h)) if best else (int((c[1:12] ** 2).sum()), -h)
        assert p.level(n) == -best[1]
        list(p.add(step, np.arange(n)))
        assert [len(x) for x in p.open] == p.counts[:12].tolist()


def test_rest_leaves_one_partial_window():
    rng = random.Random(9)
    for _ in range(50):
        p, out, total = P.Packer(16), [], 0
        for k in range(rng.randrange(0, 40)):
            n = rng.randrange(1, 40)
            total += n
            out += list(p.add(k, np.arange(n)))
        out += list(p.rest())
        fills = [sum(len(x[2]) for x in w) for w in out]
        assert sum(fills) == total and sum(f < 16 for f in fills) <= 1 and all(len(x[2]) for w in out for x in w)


def test_open_windows_are_bounded():
    p, out, given = P.Packer(1024, most=50_000), [], 0
    rng = np.random.default_rng(2)
    for k in range(2_000):
        ids = rng.integers(1, 50, 600).astype(np.uint32)  # no two fit one window
        given += len(ids)
        out += p.add(k, ids)
        assert p.held <= 50_000 and p.held == sum(len(x[2]) for ws in p.open for w in ws for x in w)
        assert p.counts.sum() == sum(map(len, p.open))
    out += p.rest()
    sizes = [sum(len(x[2]) for x in w) for w in out]
    assert sum(sizes) == given and sum(s < 1024 for s in sizes) == 1 and max(sizes) == 1024
    pieces = sorted((k, start, len(ids)) for w in out for k, start, ids in w)
    at = {}
    for k, start, n in pieces:
        assert at.get(k, 0) == start
        at[k] = start + n
    assert set(at.values()) == {600}
