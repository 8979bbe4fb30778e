"""Spelling variants: words one edit apart, found by asymmetric q-chunks.

The vocabulary holds every word of the corpus that is long and frequent enough, with its count. To
find the pairs that differ by one inserted, deleted or replaced character, the longer word of a pair
(either, if they are as long) contributes its two halves as disjoint chunks; the other contributes its
positional grams as long as such a chunk, at the chunk's place or one before. An edit touches one character
of the longer word, so the chunk without it is a gram of the shorter word, and the pair meets in a join
on (length, place, gram); edit distance is then verified on whole words. Grams further off than one
place cannot join, so they are not written.

Groups of words that share a chunk may be large (common beginnings and endings). Where more than ``GROUP``
words meet, none are paired yet: the half in which the edit lies is halved in turn, and by the same
argument the pair shares the chunk and one half of the rest. This goes on, in those groups only, until they are
small; with one character left out at most an alphabet of words meets. So every pair is found,
and never all pairs of a large group are formed.

A word's form is its near word of the largest count (ties: the least in code-point order), if that
count is at least ``RATIO`` times its own; its root is the last form reachable. Counts grow along forms,
so these chains are short and are followed by pointer doubling.

Defined cases: a null text has no words; a null id counts as the empty string in the hash; rows that repeat an
id are rows of their own. Words may be of any length.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridflow.llm.common import compact, cut, partitions_for, small, small_batches

RUN = re.compile("[a-zÀ-ÿ]+")  # of a text whose A-Z are lower-cased
DAMAGE = 199         # one in so many (document, run) pairs loses a character
LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5
GROUP = 128          # words that are paired within one group, at most
HELD_WORDS = 300_000  # counted in a task before they are handed on
HELD_CHARS = 8 << 20
PIECE = 1 << 20      # code points searched for runs at once
HOT_KEYS = 1 << 20   # keys of large groups that are broadcast, at most


def _lowered(text: str) -> str:
    return text.lower() if text.isascii() else text.encode().lower().decode()


def pieces(text: str) -> Iterator[str]:
    """``text`` in pieces of about ``PIECE`` code points that end where a run ends."""
    at = 0
    while at < len(text):
        to = min(len(text), at + PIECE)
        if to < len(text) and (run := RUN.match(text, to)):
            to = run.end()
        yield text[at:to]
        at = to


def damaged(run: str, h: int) -> str:
    """The run without one character if its hash says so."""
    if h % DAMAGE:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[str] = Counter()
    chars = 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    for b in batches:
        for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            head = zlib.crc32(f"{doc}:".encode())
            for piece in pieces(_lowered(text)):
                for run, n in Counter(RUN.findall(piece)).items():
                    if len(run) < LEAST_LENGTH:
                        continue  # a run only gets shorter
                    word = damaged(run, zlib.crc32(run.encode(), head))
                    if len(word) >= LEAST_LENGTH:
                        if word not in counts:
                            chars += len(word)
                        counts[word] += n
                if len(counts) >= HELD_WORDS or chars >= HELD_CHARS:
                    yield batch()
                    counts.clear()
                    chars = 0
    yield batch()


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): all words of at least ``LEAST_LENGTH`` characters and ``LEAST_COUNT`` occurrences."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(_count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _text(at: Column, length: Column) -> Column:
    return F.substring("word", (at + 1).cast("int"), length.cast("int"))


def _keyed(rows: DataFrame) -> DataFrame:
    """rows (word, n, size, whole, lo, hi): adds ``key``. ``whole`` is the length of the longer word of
    the pairs sought, [lo, hi) the part of it that is left out; the word's own part is as much shorter
    as the word is. ``size`` is the word's length."""
    end = F.col("hi") - (F.col("whole") - F.col("size"))
    return rows.withColumn("key", F.xxhash64("whole", "lo", "hi", _text(F.lit(0), F.col("lo")), _text(end, F.col("size") - end)))


def _halved(rows: DataFrame) -> DataFrame:
    """Each row twice, with either half of its left-out part."""
    mid = F.expr("lo + (hi - lo) div 2")
    halves = F.array(F.struct(F.col("lo").alias("lo"), mid.alias("hi")), F.struct(mid.alias("lo"), F.col("hi").alias("hi")))
    return rows.select("word", "n", "size", "whole", F.inline(halves))


def _paired(rows: DataFrame) -> DataFrame:
    """Verified pairs of rows with one key: the longer word (of equals the lesser) first."""
    a = rows.where("size = whole").select("key", F.col("word").alias("a"), F.col("n").alias("n_a"), F.col("whole").alias("whole_a"))
    b = rows.select("key", F.col("word").alias("b"), F.col("n").alias("n_b"), F.col("size").alias("size_b"))
    return a.join(b, "key").where(((F.col("size_b") < F.col("whole_a")) | (F.col("a") < F.col("b"))) & (F.levenshtein("a", "b", 1) == 1)) \
        .select("a", "n_a", "b", "n_b")


def near_pairs(words: DataFrame) -> DataFrame:
    """words (word, n) -> (a, n_a, b, n_b): every two words one edit apart, once."""
    size = F.char_length("word").cast("long")
    # a word is sought as the longer or an equal one, and as the shorter one
    rows = words.select("word", "n", size.alias("size"), F.explode(F.array(size, size + 1)).alias("whole"))
    rows = _keyed(_halved(rows.select("*", F.lit(0).cast("long").alias("lo"), F.col("whole").alias("hi"))))
    found = None
    while True:
        groups = rows.groupBy("key").agg(F.count("*").alias("words"), F.max(F.col("size") == F.col("whole")).alias("longer"),
                                         F.max(F.col("hi") - F.col("lo")).alias("part"))
        hot = cut(groups.where((F.col("words") > GROUP) & F.col("longer") & (F.col("part") > 1)).select(F.col("key").alias("hot")))
        some = not hot.isEmpty()
        cold = rows.join(small(hot, HOT_KEYS), F.col("key") == F.col("hot"), "left_anti") if some else rows
        pairs = _paired(cold)
        found = pairs if found is None else found.unionByName(pairs)
        if not some:
            break
        within = rows.join(small(hot, HOT_KEYS), F.col("key") == F.col("hot"), "left_semi")
        rows = compact(_keyed(_halved(within)))[0]
    # a letter left out of a run of equal letters is found at several places
    return found.distinct()


def roots(forms: DataFrame) -> DataFrame:
    """forms (word, form), without cycles -> (word, root): the end of each chain."""
    now, n = compact(forms.select("word", F.col("form").alias("root")))
    parts = partitions_for(n)
    while n:
        onward = now.select(F.col("word").alias("at"), F.col("root").alias("further"))
        moved = now.join(onward, F.col("root") == F.col("at"), "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        moved = cut(moved.coalesce(parts))
        now = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            break
    return now


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per word of the vocabulary: word, form, root, n, n_near, form_n."""
    words, _ = compact(vocabulary(docs, id_col, text_col))
    pairs = cut(near_pairs(words))
    both = pairs.select(F.col("a").alias("of"), F.col("b").alias("other"), F.col("n_b").alias("m")).unionByName(
        pairs.select(F.col("b").alias("of"), F.col("a").alias("other"), F.col("n_a").alias("m")))
    near = both.groupBy("of").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("less"), "other")).alias("best"))
    judged = words.join(near, F.col("word") == F.col("of"), "left")
    is_form = -F.col("best.less") >= RATIO * F.col("n")
    judged = cut(judged.select("word", F.when(is_form, F.col("best.other")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                               F.when(is_form, -F.col("best.less")).alias("form_n")))
    ends = roots(judged.where("form is not null").select("word", "form")).select(F.col("word").alias("of"), "root")
    return judged.join(ends, F.col("word") == F.col("of"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
