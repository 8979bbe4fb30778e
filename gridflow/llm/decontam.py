"""Benchmark decontamination by spaced-seed hashing.

A seed is a fixed mask over a window of words; words under its zeros are ignored, so a hit
survives substitutions there. Seeds of the benchmark items form an index; the seeds at every word
of every document are looked up in it, and around each hit the document and the item are laid
over each other without gaps. The overlay is a contamination if any stretch of it has at least
``MIN_MATCHES`` equal words (or the whole of a shorter item) at a share of at least ``MIN_SHARE``.
What is reported is the best stretch (a match counts 1, a mismatch -2) if it is one of those,
otherwise the one of them with the most equal words.

The masks find every contamination at the default bounds: any overlay that qualifies holds a least
qualifying stretch (of at most 30 words), and each of those meets one of the masks
(tests/llm/test_decontam.py goes through all of them). With a lower ``MIN_SHARE`` or ``MIN_MATCHES`` some may be missed.

The benchmark is the stated query set: it is cut into blocks of a bounded number of words, each
block's index is broadcast and all documents pass it in one map without a shuffle. Words are
letters and digits with A-Z lower-cased; other ASCII characters separate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridflow.llm.common import U64, list_array, lowered, mix, signed, small_batches, words64

# fixed masks of 7 words each, chosen greedily until every least qualifying stretch meets one
MASKS = ("11101111", "11010010111", "11111010001", "11000101111", "11101100101", "11110111")
MIN_WORDS = 5           # shorter items are too common as word sequences to be looked for
MIN_MATCHES = 13
MIN_SHARE = 0.8
BLOCK_WORDS = 200_000   # words of one block of the benchmark; its index is 16 bytes a word and mask
PIECE_WORDS, OVERLAP = 8_192, 256
FILTER_BITS = 22
SHIFTS = 4_000_000      # overlays listed at once, before repeated ones go

_ALNUM = bytes(b if 97 <= b <= 122 or 48 <= b <= 57 or b >= 128 else 32 for b in range(256))
_BASE = U64(0x9FB21C651E98DF25)


def normal_words(data: bytes) -> np.ndarray:
    return words64(data.translate(_ALNUM))[0]


def seeds(w: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the words under the mask's ones, at every word where the mask fits."""
    n = len(w) - len(mask) + 1
    if n <= 0:
        return np.empty(0, dtype=U64)
    h = np.full(n, hash_of_mask(mask), dtype=U64)
    for i, c in enumerate(mask):
        if c == "1":
            h = h * _BASE + w[i:i + n]
    return mix(h)


def hash_of_mask(mask: str) -> int:
    return int("1" + mask, 2)


def longest(equal: np.ndarray, least: int, min_share: float) -> tuple[int, int]:
    """(equal words, length) of the stretch with the most equal words among those with at least
    ``least`` of them at a share of at least ``min_share``; zeros if there is none."""
    matches = np.concatenate([[0], np.cumsum(equal)])
    over = matches - min_share * np.arange(len(matches))  # a stretch qualifies if this doesn't fall from its start to its end
    lowest = np.minimum.accumulate(over)
    start = np.searchsorted(-lowest, -over - 1e-9)        # the first place that is no higher than each end
    n = matches - matches[start]
    end = int(n.argmax())
    return (int(n[end]), int(end - start[end])) if n[end] >= least else (0, 0)


def runs(h: np.ndarray, group: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, length) of the stretches of rows with equal seeds at consecutive places of one group."""
    if not len(h):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (group[1:] != group[:-1]) | (at[1:] != at[:-1] + 1)])
    first = np.flatnonzero(new)
    return first, np.diff(np.append(first, len(h)))


class SeedIndex:
    """Seeds of one block of benchmark pieces. An item shorter than every mask is one exact seed.

    A seed repeated at consecutive words is kept as one run, in the index as in the documents, and two
    runs give one range of overlays: a word said a hundred thousand times costs no pair of its places.
    """

    def __init__(self, pieces: list[tuple[int, np.ndarray]]):
        self.pieces = pieces
        self.longest = max((len(w) for _, w in pieces), default=0)
        span = min(map(len, MASKS))
        self.masks = list(MASKS) + ["1" * n for n in sorted({len(w) for _, w in pieces if len(w) < span})]
        self.tables = []
        for mask in self.masks:
            h, piece, at = [], [], []
            for k, (_, w) in enumerate(pieces):
                if len(w) >= len(mask) if len(mask) >= span else len(mask) == len(w):
                    s = seeds(w, mask)
                    h.append(s)
                    piece.append(np.full(len(s), k, dtype=np.int32))
                    at.append(np.arange(len(s), dtype=np.int32))
            h, piece, at = (np.concatenate(x) if x else np.empty(0, t) for x, t in ((h, U64), (piece, np.int32), (at, np.int32)))
            first, length = runs(h, piece, at)
            h, piece, at = h[first], piece[first], at[first]
            order = np.argsort(h, kind="stable")
            may = np.zeros(1 << FILTER_BITS, dtype=bool)
            may[(h >> U64(64 - FILTER_BITS)).astype(np.int64)] = True
            self.tables.append((h[order], piece[order], at[order], length[order].astype(np.int32), may))

    def shifts(self, w: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Distinct rows (document, piece, shift) of all hits; at most about ``SHIFTS`` are listed at once."""
        width, docs = len(w) + self.longest, len(first) - 1
        found = np.empty(0, np.int64)
        for mask, (keys, piece, at, size, may) in zip(self.masks, self.tables):
            h = seeds(w, mask)
            i = np.flatnonzero(may[(h >> U64(64 - FILTER_BITS)).astype(np.int64)])
            doc = np.searchsorted(first, i, "right") - 1
            start, length = runs(h[i], doc, i)
            i, doc = i[start], doc[start]
            lo, hi = np.searchsorted(keys, h[i], "left"), np.searchsorted(keys, h[i], "right")
            hit = np.flatnonzero(hi > lo)
            for part in _parts(hi[hit] - lo[hit], SHIFTS // 16):
                r = hit[part]
                n = hi[r] - lo[r]
                j = np.repeat(lo[r] - np.cumsum(n) + n, n) + np.arange(n.sum())
                r = np.repeat(r, n)
                least = (doc[r] * len(self.pieces) + piece[j]) * width + i[r] - at[j] - size[j] + 1 + self.longest
                many = length[r] + size[j] - 1
                for p in _parts(many, SHIFTS):
                    m = many[p]
                    found = np.union1d(found, np.repeat(least[p] - np.cumsum(m) + m, m) + np.arange(m.sum()))
        if not len(found):
            return np.empty((0, 3), np.int64)
        both, shift = np.divmod(found, width)
        return np.stack([both // len(self.pieces), both % len(self.pieces), shift - self.longest], axis=1)

    def overlaps(self, w: np.ndarray, first: np.ndarray, min_matches: int, min_share: float) -> Iterator[tuple]:
        """(document, piece, equal words, length) of all contaminations of documents whose words
        are ``w[first[d]:first[d + 1]]``."""
        for doc, k, shift in self.shifts(w, first):
            item = self.pieces[k][1]
            lo, hi = max(first[doc], shift), min(first[doc + 1], shift + len(item))
            equal = w[lo:hi] == item[lo - shift:hi - shift]
            least = min(min_matches, len(item))
            if np.count_nonzero(equal) < least:
                continue
            score = np.concatenate([[0], np.cumsum(np.where(equal, 1, -2))])
            gain = score - np.minimum.accumulate(score)
            end = int(gain.argmax())
            start = int(score[:end + 1].argmin())
            n, length = int(equal[start:end].sum()), end - start
            if n < least or n < min_share * length:
                n, length = longest(equal, least, min_share)
            if n:
                yield int(doc), int(k), n, length


def _parts(n: np.ndarray, most: int) -> Iterator[slice]:
    """Cuts rows that stand for ``n`` each into stretches of about ``most``."""
    total, a = np.cumsum(n), 0
    while a < len(n):
        b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + most, "right")))
        yield slice(a, b)
        a = b


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, words = [], []
        for item, data in zip(b.column(0).to_pylist(), lowered(b.column(1))):
            w = normal_words(data)
            for at in range(0, len(w) if len(w) >= MIN_WORDS else 0, PIECE_WORDS - OVERLAP):
                if at == 0 or len(w) - at > OVERLAP:
                    ids.append(item)
                    words.append(w[at:at + PIECE_WORDS])
        flat = np.concatenate(words) if words else np.empty(0, U64)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), list_array(signed(flat), [len(x) for x in words])],
                                         ["item", "words"])


def blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
           block_words: int = BLOCK_WORDS) -> Iterator[SeedIndex]:
    """The benchmark's indexes, block by block; the driver holds one bounded block at a time."""
    b = benchmark.select(F.col(id_col).cast("long").alias("item"), F.col(text_col).alias("text")).where("item is not null")
    pieces = b.mapInArrow(_pieces, "item long, words array<long>").dropDuplicates()
    total = pieces.agg(F.sum(F.size("words"))).first()[0] or 0
    n = -(-total // block_words)
    for k in range(n):
        rows = pieces.where(F.pmod(F.xxhash64("item", "words"), F.lit(n)) == k).toArrow()
        yield SeedIndex([(i, w.values.to_numpy().view(U64)) for i, w in sorted(
            zip(rows.column(0).to_pylist(), rows.column(1)), key=lambda x: (x[0], len(x[1])))])


def flagged(docs: DataFrame, index: SeedIndex, text_col: str, out: str, min_matches: int = MIN_MATCHES,
            min_share: float = MIN_SHARE) -> DataFrame:
    """Adds ``out``: array of struct(item_id, matches, length), the items found in each text, each
    with its longest overlap, by id. All rows and columns of ``docs`` stay."""
    shared = docs.sparkSession.sparkContext.broadcast(index)
    kind = pa.struct([("item_id", pa.int64()), ("matches", pa.int32()), ("length", pa.int32())])

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ix = shared.value
        for texts in batches:
            each = [normal_words(x) for x in lowered(texts)]
            first = np.concatenate([[0], np.cumsum([len(x) for x in each])]).astype(np.int64)
            found: list[dict] = [{} for _ in each]
            w = np.concatenate(each) if each else np.empty(0, U64)
            for doc, k, n, length in ix.overlaps(w, first, min_matches, min_share):
                item = ix.pieces[k][0]
                found[doc][item] = max(found[doc].get(item, (0, 0)), (n, length))
            yield pa.array([[{"item_id": i, "matches": n, "length": m} for i, (n, m) in sorted(x.items())] for x in found],
                           pa.list_(kind))

    udf = F.arrow_udf(run, "array<struct<item_id:long,matches:int,length:int>>")
    return docs.withColumn(out, udf(F.col(text_col)))


def contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", out: str = "__items",
                 block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with ``out``: the benchmark items each text holds (see ``flagged``), over all blocks.

    A null or empty text, and an empty benchmark, give an empty array; items with a null id or
    fewer than ``MIN_WORDS`` words are not looked for (a sequence of four words is no passage). Texts
    that repeat a word or a phrase without end are settled in bounded memory.
    """
    small_batches(docs.sparkSession)
    kind = "array<struct<item_id:long,matches:int,length:int>>"
    docs = docs.withColumn(out, F.array().cast(kind))
    for k, index in enumerate(blocks(benchmark, block_words=block_words)):
        docs = flagged(docs, index, text_col, "__block")
        # pieces of one item may lie in several blocks: keep its best overlap
        both = F.concat(F.col(out), F.col("__block")) if k else F.col("__block")
        docs = docs.withColumn(out, both).drop("__block")
    best = F.transform(F.array_sort(F.array_distinct(F.transform(F.col(out), lambda x: x["item_id"]))), lambda i: F.array_max(
        F.transform(F.filter(F.col(out), lambda x: x["item_id"] == i),
                    lambda x: F.struct(x["matches"].alias("matches"), x["length"].alias("length"), x["item_id"].alias("item_id")))))
    return docs.withColumn(out, best)


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, contaminated, items (ids, ascending), matches (of the longest overlap, else 0)."""
    r = contaminated(docs.select(id_col, text_col), benchmark, text_col)
    return r.select(id_col, (F.size("__items") > 0).alias("contaminated"),
                    F.transform("__items", lambda x: x["item_id"]).alias("items"),
                    F.coalesce(F.array_max(F.transform("__items", lambda x: x["matches"])), F.lit(0)).alias("matches"))
