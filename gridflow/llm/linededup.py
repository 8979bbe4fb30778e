"""Corpus-wide removal of repeated lines, exact or one word apart, by a deletion-neighbourhood join.

Words are compared with A-Z lower-cased. Of equal lines the earliest (least document id, then line
number) stays; lines take part from ``EXACT_WORDS`` words on if the caller says so (op9_linededup does:
every line that is not blank), else from ``MIN_WORDS``. A line of at least ``MIN_WORDS`` words also goes if an
earlier such line lies within one word edit (insertion, deletion or substitution) of it.

Near lines: every distinct line emits the hashes of its variants, itself and itself less any one
word. Two lines are one substitution apart if they share the variant less the same position, and
one insertion apart if a line equals the other's variant; so a variant's earliest line is the one
to keep for all others that share it, and no pairs within a variant are formed. The chosen pair is
verified by edit distance on the words.

Only lines that can have a neighbour emit variants: if one word is edited, the lines still share
their first half or their last half, so a line whose halves (for its own length and one less)
occur in no other distinct line has none. That filter loses nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridflow.llm.common import U64, _powers, cut, list_array, lowered, mix, signed, small, small_batches, words64

MIN_WORDS = 5            # of lines compared with one word edited
EXACT_WORDS = 1          # of lines compared as they are
LEAST_LEFT = 0.2         # of a document's words: near duplicates share 0.8
BROADCAST_PLACES = 4_000_000  # (document, line) places, 12 bytes each; more are joined by a shuffle
_B1, _B2 = 0xD1342543DE82EF95, 0x2545F4914F6CDD1D
_I1, _I2 = (pow(b, -1, 1 << 64) for b in (_B1, _B2))
_PREFIX_KEY, _SUFFIX_KEY = U64(0x9FB21C651E98DF25), U64(0xA24BAED4963EE407)


class Lines:
    """The word hashes of a text and, per line of at least ``least`` words, their range."""

    def __init__(self, data: bytes, least: int):
        self.words, at, _ = words64(data)
        a = np.frombuffer(data, dtype=np.uint8)
        breaks = np.flatnonzero(a == 10)
        first = np.concatenate([[0], np.searchsorted(at, breaks)])
        last = np.append(first[1:], len(at))
        self.number = np.flatnonzero(last - first >= least)
        self.first, self.last = first[self.number], last[self.number]
        self.sums = {b: self._sums(b) for b in (_B1, _B2)}

    def _sums(self, base: int) -> np.ndarray:
        s = np.zeros(len(self.words) + 1, dtype=U64)
        np.cumsum(self.words * _powers(base, len(self.words)), out=s[1:])
        return s

    def part(self, first: np.ndarray, last: np.ndarray, base: int = _B1, inverse: int = _I1) -> np.ndarray:
        """Order-sensitive hash (a polynomial) of the words first..last-1, wherever they stand."""
        if not len(self.words):
            return np.empty(0, dtype=U64)
        s = self.sums[base]
        return (s[last] - s[first]) * _powers(inverse, len(s))[first]

    def whole(self) -> tuple[np.ndarray, np.ndarray]:
        n = (self.last - self.first).astype(U64)
        return mix(self.part(self.first, self.last) + n), mix(self.part(self.first, self.last, _B2, _I2) ^ n)

    def halves(self) -> list[np.ndarray]:
        """Three keys per line: its first and last half for its length and for one word less, of
        which two coincide."""
        n = self.last - self.first
        h, odd = n // 2, n % 2 == 1
        head, tail = self.part(self.first, self.first + h), self.part(self.last - h, self.last)
        third = np.where(odd, self.part(self.last - h - odd, self.last), self.part(self.first, self.first + h - 1))
        size = h.astype(U64)
        return [mix(head + size * _PREFIX_KEY), mix(tail + size * _SUFFIX_KEY),
                mix(third + np.where(odd, (size + U64(1)) * _SUFFIX_KEY, (size - U64(1)) * _PREFIX_KEY))]


def variants(words: np.ndarray) -> np.ndarray:
    """Hashes, as ``Lines.whole`` would give them, of a line less each one of its words."""
    n = len(words)
    power = _powers(_B1, n + 1)
    head = np.zeros(n + 1, dtype=U64)
    np.cumsum(words * power[:n], out=head[1:])
    # what follows the word left out moves up by one place
    tail = (head[n] - head[1:]) * U64(_I1)
    return mix(head[:n] + tail + U64(n - 1))


def _lines(least: int, near: int):
    """The lines of at least ``least`` words with their hashes; those of fewer than ``near`` have no halves."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [Lines(x, least) for x in lowered(b.column(1))]
            n = [len(x.number) for x in got]
            cat = lambda v, t=U64: np.concatenate(v).astype(t) if v else np.empty(0, t)
            columns = [(*x.whole(), *x.halves()) for x in got]
            none = cat([x.last - x.first < near for x in got], bool)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(np.repeat(np.arange(len(got)), n))), pa.array(cat([x.number for x in got], np.int32)),
                 *[pa.array(signed(cat([c[i] for c in columns])), mask=none if i > 1 else None) for i in range(5)]],
                ["id", "line", "h1", "h2", "k1", "k2", "k3"])
    return run


def _words(least: int):
    """(id, text, lines) -> the word hashes of those lines."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for id_, data, chosen in zip(b.column(0).to_pylist(), lowered(b.column(1)), b.column(2).to_pylist()):
                x = Lines(data, least)
                at = np.flatnonzero(np.isin(x.number, chosen))
                if len(at):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), id_, dtype=np.int64)), pa.array(x.number[at].astype(np.int32)),
                         list_array(signed(np.concatenate([x.words[x.first[i]:x.last[i]] for i in at])), x.last[at] - x.first[at])],
                        ["id", "line", "words"])
    return run


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, line, words) -> a row for each variant: its hash and the place of the word left out."""
    for b in batches:
        if not b.num_rows:
            continue
        found = [variants(w.values.to_numpy().view(U64)) for w in b.column(2)]
        n = np.array([len(v) for v in found])
        of = pa.array(np.repeat(np.arange(len(n)), n))
        yield pa.RecordBatch.from_arrays(
            [b.column(0).take(of), b.column(1).take(of), pa.array(signed(np.concatenate(found))),
             pa.array(np.concatenate([np.arange(k) for k in n]).astype(np.int32))], ["id", "line", "key", "out"])


def within_one(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two word sequences are at most one insertion, deletion or substitution apart."""
    if abs(len(x) - len(y)) > 1:
        return False
    n = min(len(x), len(y))
    differ = np.flatnonzero(x[:n] != y[:n])
    if len(x) == len(y):
        return len(differ) <= 1
    if not len(differ):
        return True
    x, y = sorted((x, y), key=len)
    return bool((x[differ[0]:] == y[differ[0] + 1:]).all())


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x, y = (b.column(i) for i in (2, 3))
        ok = [within_one(p.values.to_numpy(), q.values.to_numpy()) for p, q in zip(x, y)]
        yield pa.RecordBatch.from_arrays([b.column(i) for i in (0, 1)], ["id", "line"]).filter(pa.array(ok, pa.bool_()))


def _by_doc(places: DataFrame) -> DataFrame:
    """(id, line) -> (p, lines) per document, to be broadcast if there are few enough places."""
    few = places.limit(BROADCAST_PLACES + 1).count() <= BROADCAST_PLACES
    by_doc = places.groupBy("id").agg(F.array_sort(F.collect_set("line")).alias("lines")).withColumnRenamed("id", "p")
    return F.broadcast(by_doc) if few else by_doc


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                  exact_words: int | None = None) -> DataFrame:
    """(id, lines): per document that loses any, the ascending numbers (from 0) of the lines that go.

    Rows that repeat an id are taken as copies of one document: the same line of them has the same
    place, so they lose the same lines. Rows with a null id and null or blank texts have none.
    Equal lines go from ``exact_words`` words on (default: ``min_words``).
    """
    small_batches(docs.sparkSession)
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id is not null")
    place = F.struct("id", "line")
    lines = cut(d.mapInArrow(_lines(min_words if exact_words is None else exact_words, min_words), "id long, line int, h1 long, h2 long, k1 long, k2 long, k3 long"))
    long = F.col("k1").isNotNull()
    classes = lines.groupBy("h1", "h2").agg(F.min(place).alias("at"), F.max(place).alias("to"), F.max(long).alias("long"))
    classes = cut(classes.select("h1", "h2", "at", (F.col("at") < F.col("to")).alias("repeated"), "long"))
    # lines whose halves occur in no other distinct line have no neighbour
    halves = lines.where(long).select("h1", "h2", F.explode(F.array("k1", "k2", "k3")).alias("key"))
    shared = cut(halves.groupBy("key").agg(F.min("h1").alias("a"), F.max("h1").alias("b")).where("a < b").select("key"))
    able = halves.join(small(shared, BROADCAST_PLACES), "key", "left_semi").select("h1", "h2").distinct()
    able = cut(classes.join(small(able, BROADCAST_PLACES), ["h1", "h2"], "left_semi").select("at.id", "at.line"))
    words = d.join(_by_doc(able), F.col("id") == F.col("p")).select("id", "text", "lines").mapInArrow(
        _words(min_words), "id long, line int, words array<long>").dropDuplicates(["id", "line"])
    words = cut(words)
    variant = words.mapInArrow(_variants, "id long, line int, key long, out int")
    # the same word position left out: one substitution apart
    first = variant.groupBy("key", "out").agg(F.min(place).alias("keep"), F.max(place).alias("to")).where("keep < to").drop("to")
    substituted = variant.join(first, ["key", "out"]).select(place.alias("at"), "keep").where("keep < at")
    # a variant that is itself a line: one insertion apart; the later of the two goes
    inserted = variant.join(classes.where("long").select(F.col("h1").alias("key"), F.col("at").alias("other")), "key").select(
        F.greatest(place, "other").alias("at"), F.least(place, "other").alias("keep")).where("keep < at")
    pairs = cut(substituted.unionByName(inserted).groupBy("at").agg(F.min("keep").alias("keep")))
    words = words.select(place.alias("w"), "words")
    near = (pairs.join(words.select(F.col("w").alias("at"), F.col("words").alias("x")), "at")
            .join(words.select(F.col("w").alias("keep"), F.col("words").alias("y")), "keep")
            .select("at.id", "at.line", "x", "y").mapInArrow(_verify, "id long, line int").select(place.alias("at"), F.lit(True).alias("near")))
    goes = classes.join(near, "at", "left").where("near or repeated").select("h1", "h2", "at", "near")
    gone = lines.join(goes, ["h1", "h2"]).where(F.col("near") | (place != F.col("at")))
    return _by_doc(cut(gone.select("id", "line"))).withColumnRenamed("p", "id")


def without_lines(docs: DataFrame, removed: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  out: str = "__lines") -> DataFrame:
    """All rows and columns of ``docs`` and ``out``: struct(text, n_lines, n_removed) less the lines."""
    lines = F.split(F.col(text_col), "\n")
    n_lines = F.char_length(text_col) - F.char_length(F.replace(F.col(text_col), F.lit("\n"), F.lit(""))) + 1
    gone = F.coalesce(F.col("__gone"), F.array().cast("array<int>"))
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone), lambda i: F.get(lines, i))
    r = removed.select(F.col("id").alias("__id"), F.col("lines").alias("__gone"))
    text = F.when(F.size(gone) > 0, F.array_join(kept, "\n")).otherwise(F.col(text_col))
    return (docs.join(r, F.col(id_col) == F.col("__id"), "left")
            .withColumn(out, F.struct(text.alias("text"), F.coalesce(n_lines, F.lit(0)).cast("long").alias("n_lines"),
                                      F.size(gone).cast("long").alias("n_removed"))).drop("__id", "__gone"))


def scrap(before: F.Column, after: F.Column, least: float = LEAST_LEFT) -> F.Column:
    """Whether a text that lost lines keeps less than ``least`` of its words (or had some and kept none): what it
    said stands in earlier documents, and the scrap is no document of its own. False for nulls."""
    words = lambda c: F.regexp_count(c, F.lit("[^\\x20\\x09-\\x0D]+"))
    return F.coalesce((F.char_length(after) < F.char_length(before)) & (words(after) < least * words(before)), F.lit(False))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                exact_words: int | None = None) -> DataFrame:
    """One row per input row: id, text without the repeated lines, n_lines, n_removed."""
    d = docs.select(id_col, text_col)
    return without_lines(d, removed_lines(d, id_col, text_col, min_words, exact_words), id_col, text_col).select(
        id_col, F.col("__lines.text").alias(text_col), "__lines.n_lines", "__lines.n_removed")
