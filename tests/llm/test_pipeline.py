import itertools

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from gridflow.llm import decontam, linededup, minhash, packing, toxicity
from gridflow.sources.tables import read_table
from test_decontam import best, words
from test_linededup import brute as brute_lines
from test_minhash import shingles
from test_packing import check

SF = "/root/testdata/sf0.001"


def brute_near(rows, k=5):
    sets = {i: shingles(t, k) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for (i, a), (j, b) in itertools.combinations(sorted(sets.items()), 2):
        if a and b and 100 * len(a & b) >= 80 * len(a | b):
            x, y = sorted((find(i), find(j)))
            parent[y] = x
    return {i for i in sets if find(i) == i}


def test_each_stage_against_brute_force(spark, tmp_path):
    docs = read_table(spark, SF, "documents")
    labels, bench = read_table(spark, SF, "labels"), read_table(spark, SF, "benchmark")
    items = [words(r.text) for r in bench.collect()]
    columns = docs.columns
    for k, (name, stage) in enumerate(C.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        df = stage(spark, docs, SF)
        df.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        if name == "packing":
            assert check(out.collect(), {i: r.text for i, r in before.items()}) < 0.01
            break
        assert out.columns == columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        after = {r.doc_id: r for r in out.collect()}
        if name == "toxicity":
            m = toxicity.train(docs, labels)
            want = {i for i, r in before.items() if m.chances(r.text.encode().lower())[0] < toxicity.LEAST_CHANCE}
            assert set(after) == want and after == {i: before[i] for i in want}
        elif name == "line_dedup":
            n = lambda t: len(t.encode().split())
            want = {i: t for i, t, _, gone in brute_lines([(i, r.text) for i, r in before.items()], linededup.MIN_WORDS, linededup.EXACT_WORDS)
                    if not gone or n(t) >= linededup.LEAST_LEFT * n(before[i].text)}
            assert {i: r.text for i, r in after.items()} == want
            assert all(r.n_chars == len(r.text) for r in after.values())
        elif name == "near_dedup":
            assert set(after) == brute_near([(i, r.text) for i, r in before.items()])
        else:
            grams = [set(zip(x, x[1:], x[2:])) for x in items]

            def clean(text):
                w = words(text)
                own = set(zip(w, w[1:], w[2:]))
                return not any(own & g and best(w, x) for x, g in zip(items, grams))
            assert set(after) == {i for i, r in before.items() if clean(r.text)} < set(before)
        docs = out


def test_no_near_copy_lives_on_as_a_scrap(spark):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    firsts = brute_near(texts.items(), 4)
    lines = C.drop_repeated_lines(spark, docs, SF)
    left = {r.doc_id: r.text for r in C.drop_near_duplicates(spark, lines, SF).collect()}
    n = lambda t: len((t or "").split())
    copies = set(texts) - firsts
    assert copies and all(n(left[i]) >= linededup.LEAST_LEFT * n(texts[i]) for i in copies & set(left))


def test_run(spark):
    out = C.run(spark, SF)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
    assert out.count() > 100


@pytest.mark.parametrize("extra", [False, True])
def test_edge_rows(spark, extra):
    base = "one two three four five six seven eight"
    rows = [(1, base, "en", "s", 39), (2, base, "en", "s", 39), (1, base, "en", "s", 39), (3, None, None, None, None), (4, "", "en", "s", 0),
            (None, base, "en", "s", 39), (5, base + " nine\nother words that stay here now", "en", "s", 70)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    if extra:
        docs = docs.withColumns({c: F.lit(1) for c in ("id", "kept", "lines", "line", "toxic", "items", "component_id", "start", "key")})
    lines = C.drop_repeated_lines(spark, docs, SF)
    got = sorted((str(r.doc_id), r.text, r.n_chars) for r in lines.collect())
    assert got == [("1", base, 39), ("1", base, 39), ("3", None, None), ("4", "", 0), ("5", "other words that stay here now", 30), ("None", base, 39)]
    near = C.drop_near_duplicates(spark, docs, SF)
    assert sorted(str(r.doc_id) for r in near.collect()) == ["1", "3", "4", "5", "None"]
    for name, stage in C.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0
        out = stage(spark, docs, SF)
        assert name == "packing" or out.columns == docs.columns
        out.count()
