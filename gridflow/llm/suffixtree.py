"""Text scores from a probabilistic suffix tree over words, and from word frequencies.

A text is a sequence of words (see ``common``) and an end token; the end token also stands before
its first word. The tree's alphabet are the words with at least ``LEAST_SHARE`` of the training
tokens, the end token, and one symbol for all other words. From ``REFERENCE`` tokens on a share is
one of that many tokens, so the least counts stand still (50 and 5) and the tree grows with the corpus.

Contexts are the one to ``DEPTH`` symbols before a word, not across the end token. A context is
considered if it has the least count of a word and kept if its next-symbol distribution diverges
from that of the context without its oldest symbol: the Kullback-Leibler divergence is at least
``LEAST_DIVERGENCE`` nats and more than the sampling of that many kinds explains. With a context its
suffixes and prefixes are kept. In each context the next symbols with at least ``LEAST_ENTRY`` have
counts of their own; the rest is left to the suffix, to which all
distributions are smoothed (Witten-Bell). A word is predicted in the state of the longest kept suffix
of what precedes it; a word outside the alphabet is that symbol's probability times its own share
of such words, where all words never seen in training are one event with the weight of the words
seen once.

Training reads all training rows. Contexts and their next symbols are grams, named by 64-bit hashes and
counted level by level with partial sums into tables that are joined, never collected whole. As
the suffixes of a kept context are kept, log P(s | u) is a sum over the suffixes v of u: of the
weight v leaves to its own suffix and, if v counts s itself, of what that adds. So a
gram has two numbers, as an entry (``delta``) and as a context (``bow``), and a text's score is a
sum over its grams. The ``HEAD_GRAMS`` most frequent grams are broadcast; the texts' grams that may be
one of the others (by a bitmap of their keys), which have no hot key, are joined by a shuffle. Words of the alphabet beyond ``HEAD_WORDS`` go to the texts the same way.

Word frequencies: the most frequent words, at most ``HEAD_WORDS``, are broadcast with their
counts; a word outside that head is rare (at most one in HEAD_WORDS tokens), so the documents' rare
words are joined with their counts by a shuffle that has no hot key.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridflow.llm.common import U64, blanks, cut, lowered, mix, release, signed, small, small_batches, words64

DEPTH = 3
LEAST_SHARE = 5e-5
LEAST_ENTRY = 5e-6
REFERENCE = 1_000_000    # tokens; in a larger corpus the shares are of this many
LEAST_DIVERGENCE = 0.02
HEAD_WORDS = 1_000_000
HEAD_GRAMS = 2_000_000   # 24 bytes each
SUFFIX_GRAMS = 6_000_000  # 8 bytes each
FILTER_BITS = 1 << 27    # of the filter that tells which texts' grams are looked for among the infrequent ones
BROADCAST_ROWS = 500_000
ADD = 0.1                # added to every count of the word-frequency score
END = b"\n"              # the end token; no word contains it
FLUSH_BYTES = 1 << 26    # of counted words in a worker's memory at a time
FLUSH_TOKENS = 4_000_000
PART_TOKENS = 1_000_000  # of the training texts for one part of the grams, which a task sums in memory
# a word's symbol is its hash; these are the symbols of words outside the alphabet and of the end token
OTHER, END_SYMBOL = U64(0), U64(1)
_BASE = U64(0xD1342543DE82EF95)


def _words(data: bytes) -> pa.Array:
    """The words of ``data``, as views on its bytes without blanks."""
    a = np.frombuffer(data, dtype=np.uint8)
    blank, first, last = blanks(a)
    offsets = np.zeros(len(first) + 1, dtype=np.int32)
    np.cumsum(last - first, out=offsets[1:])
    return pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(a[~blank])])


def _added(counts: list[pa.Table]) -> pa.Table:
    """(word, n) -> (word, c): each word once."""
    return pa.concat_tables(counts).group_by("word", use_threads=False).aggregate([("n", "sum")]).rename_columns(["word", "c"])


def _count_words(parts: int):
    """(text) -> (part, words): the distinct words with their counts, packed and dealt over ``parts``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = 0

        def flush() -> pa.RecordBatch:
            counts = _added(held)
            held.clear()
            order = pc.array_sort_indices(counts["word"]).to_numpy()   # words with the same beginning take less room together
            words, n = counts["word"].to_numpy()[order], counts["c"].to_numpy()[order].astype(U64)
            part = np.zeros(len(n), dtype=U64)
            part[words != END] = words64(b" ".join(words.tolist()))[0] % U64(parts)
            order = np.argsort(part, kind="stable")
            part, words, n = part[order], words[order].tolist(), n[order]
            begin = np.flatnonzero(np.concatenate([[len(part) > 0], part[1:] != part[:-1]]))
            end = [*begin[1:].tolist(), len(part)]
            return pa.RecordBatch.from_arrays([pa.array(part[begin].astype(np.int64)), pa.array(
                [_squeezed(_numbers(n[i:j]) + b" ".join(words[i:j])) for i, j in zip(begin.tolist(), end)], pa.binary()),
                pa.array(np.diff(begin, append=len(part)))], ["part", "words", "n"])
        for b in batches:
            texts = lowered(b.column(0))
            if texts:
                counts = _words(b" ".join(texts)).value_counts()
                held += [pa.table(counts.flatten(), ["word", "n"]), pa.table([pa.array([END]), pa.array([len(texts)])], ["word", "n"])]
                size += counts.nbytes
            if size >= FLUSH_BYTES:
                yield flush()
                size = 0
        if held:
            yield flush()
    return run


def _sum_words(table: pa.Table) -> pa.Table:
    """All (part, words, n) of a part -> (word, c)"""
    counts = []
    for data, size in zip(table["words"].to_pylist(), table["n"].to_pylist()):
        data = _loosened(data)
        width = data[0]
        n = _number(data[1:1 + size * width], size, width)
        counts.append(pa.table([pa.array(data[1 + size * width:].split(b" "), pa.binary()), pa.array(signed(n))], ["word", "n"]))
    return _added(counts)


def word_counts(texts: DataFrame) -> DataFrame:
    """(text) -> (word binary, c): every distinct token with its number of occurrences."""
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = texts.mapInArrow(_count_words(parts), "part long, words binary, n long")
    return packed.groupBy("part").applyInArrow(_sum_words, "word binary, c long")


def _find(keys: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Index of each x in the sorted keys, -1 if it isn't there."""
    if not len(keys):
        return np.full(len(x), -1, dtype=np.int64)
    at = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
    return np.where(keys[at] == x, at, -1)


class Keys:
    """Many sorted keys. As they are hashes, a key's high bits lead to a place that is at most a few before its own."""

    def __init__(self, keys: np.ndarray):
        bits = max(1, len(keys).bit_length())
        self.keys, self.shift = keys, U64(64 - bits)
        self.begin = np.zeros(1 << bits, dtype=np.int32)   # of the keys with these high bits
        np.cumsum(np.bincount((keys >> self.shift).astype(np.int64), minlength=1 << bits)[:-1], out=self.begin[1:])

    def find(self, x: np.ndarray) -> np.ndarray:
        """Index of each x in the keys, -1 if it isn't there."""
        n = len(self.keys)
        if not n:
            return np.full(len(x), -1, dtype=np.int64)
        at = np.minimum(self.begin[x >> self.shift], n - 1).astype(np.int64)
        key = self.keys[at]
        on = np.flatnonzero(key < x)
        for _ in range(8):
            on = on[at[on] < n - 1]
            if not len(on):
                break
            at[on] += 1
            key[on] = next_ = self.keys[at[on]]
            on = on[next_ < x[on]]
        if len(on):   # many keys with the same high bits
            at[on] = np.minimum(np.searchsorted(self.keys, x[on]), n - 1)
            key[on] = self.keys[at[on]]
        return np.where(key == x, at, -1)


class Stream:
    """The symbols of a batch of texts in a row, with an end token before and after each text."""

    def __init__(self, texts: list[bytes], alphabet: Keys, extra: np.ndarray):
        self.data = b"\n".join(texts)
        self.hashes, self.first, self.last = words64(self.data)
        starts = np.cumsum([0] + [len(t) + 1 for t in texts])[:-1]
        self.doc = np.searchsorted(starts, self.first, side="right") - 1   # of each word
        n = len(texts)
        order = np.argsort(self.hashes)
        ordered = self.hashes[order]
        first = np.concatenate([[True], ordered[1:] != ordered[:-1]])[:len(ordered)]
        self.unique, self.index, self.of = ordered[first], order[first], np.empty(len(order), dtype=np.int64)
        self.of[order] = np.cumsum(first) - 1
        self.alphabet_at = alphabet.find(self.unique)
        self.known = (self.alphabet_at >= 0) | (_find(extra, self.unique) >= 0)
        ends = np.searchsorted(self.doc, np.arange(n), side="right") + np.arange(n) + 1
        self.place = np.arange(len(self.doc)) + self.doc + 1                # of each word in the row
        self.symbols = np.full(len(self.doc) + n + 1, END_SYMBOL, dtype=U64)
        self.symbols[self.place] = np.where(self.known, self.unique, OTHER)[self.of]
        self.owner = np.zeros(len(self.symbols), dtype=np.int64)            # text of each predicted symbol
        self.owner[self.place], self.owner[ends] = self.doc, np.arange(n)
        at_end = np.where(self.symbols == END_SYMBOL, np.arange(len(self.symbols)), 0)
        self.since = np.zeros(len(self.symbols), dtype=np.int64)            # symbols of context there are
        self.since[1:] = np.arange(1, len(self.symbols)) - np.maximum.accumulate(at_end)[:-1]


def _longer(ctx: np.ndarray, suf: np.ndarray, size: int) -> np.ndarray:
    """The gram of ``size`` symbols, given it less its newest and less its oldest symbol."""
    return mix(ctx * _BASE + suf + U64(size))


def _extra(column: pa.Array) -> np.ndarray:
    return np.unique(column.flatten().to_numpy().view(U64))


def _numbers(x: np.ndarray) -> bytes:
    """Unsigned numbers in as many bytes each as the largest needs, byte by byte of all."""
    width = max(1, (int(x.max()).bit_length() + 7) // 8)
    return bytes([width]) + np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _number(data: bytes, size: int, width: int) -> np.ndarray:
    x = np.zeros((size, 8), dtype=np.uint8)
    x[:, :width] = np.frombuffer(data, np.uint8, size * width).reshape(width, size).T
    return x.view("<u8").ravel().astype(U64, copy=False)


def _squeezed(data: bytes) -> bytes:
    return len(data).to_bytes(4, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _loosened(data: bytes) -> bytes:
    return pa.decompress(data[4:], int.from_bytes(data[:4], "little"), codec="zstd", asbytes=True)


def _packed(first: np.ndarray, second: np.ndarray, n: np.ndarray) -> bytes:
    """Grams as two numbers and a count each, ascending by the first."""
    return _squeezed(len(first).to_bytes(4, "little") + _numbers(np.diff(first, prepend=U64(0))) + _numbers(second) + _numbers(n))


def _unpacked(data: bytes) -> list[np.ndarray]:
    data = _loosened(data)
    size, at, out = int.from_bytes(data[:4], "little"), 4, []
    for _ in range(3):
        width = data[at]
        out.append(_number(data[at + 1:at + 1 + size * width], size, width))
        at += 1 + size * width
    out[0] = np.cumsum(out[0], dtype=U64)
    return out


def _sums(first: np.ndarray, second: np.ndarray, n: np.ndarray | None, paired: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs, ascending by the first, with their summed counts (without counts: one each);
    ``paired``: both numbers are below 2^32."""
    if not len(first):
        return first, second, np.empty(0, U64)
    if paired:
        code = (first << U64(32)) | second
        order = None if n is None else np.argsort(code)
        code = np.sort(code) if n is None else code[order]
        begin = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
        first, second = code[begin] >> U64(32), code[begin] & U64((1 << 32) - 1)
    else:
        order = np.lexsort((second, first))
        a, b = first[order], second[order]
        begin = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
        first, second = a[begin], b[begin]
    size = len(code) if paired else len(a)
    return first, second, np.diff(begin, append=size).astype(U64) if n is None else np.add.reduceat(n[order], begin)


def _count_grams(size: int, alphabet, contexts, suffixes, names: list, parts: int):
    """(text, extra) -> (part, grams): the grams of ``size`` symbols with their counts, packed and dealt over
    ``parts``, each as the grams less its newest and less its oldest symbol; of ``contexts`` and ``suffixes`` only,
    where given. A gram is named by its place in ``names`` (of contexts, of suffixes), where given, otherwise by its key."""
    paired = names[0] is not None and names[1] is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        symbols, *tables = (None if x is None else Keys(x.value) for x in (alphabet, contexts, suffixes))

        def flush() -> pa.RecordBatch:
            ctx, suf = (np.concatenate([x[i] for x in held]) if held else np.empty(0, U64) for i in range(2))
            held.clear()
            ctx, suf, n = _sums(ctx, suf, None, paired)
            part = (mix(ctx * _BASE + suf) % U64(parts)).astype(np.uint16 if parts <= 1 << 16 else np.int64)
            order = np.argsort(part, kind="stable")
            part, ctx, suf, n = part[order], ctx[order], suf[order], n[order]
            begin = np.flatnonzero(np.concatenate([[len(part) > 0], part[1:] != part[:-1]]))
            end = [*begin[1:].tolist(), len(part)]
            return pa.RecordBatch.from_arrays([pa.array(part[begin].astype(np.int64)), pa.array(
                [_packed(ctx[i:j], suf[i:j], n[i:j]) for i, j in zip(begin.tolist(), end)], pa.binary())], ["part", "grams"])
        for b in batches:
            if b.num_rows:
                s = Stream(lowered(b.column(0)), symbols, _extra(b.column(1)))
                less = s.symbols         # the gram one symbol shorter that ends at each place
                for k in range(2, size):
                    older, less = less, np.zeros_like(less)
                    less[1:] = _longer(older[:-1], older[1:], k)
                on = np.flatnonzero(s.since >= size - 1)
                if size == 2 and paired:  # the places of symbols: other words, the end, then the alphabet
                    place = np.ones(len(less), dtype=U64)
                    place[s.place] = np.where(s.known, s.alphabet_at + 2, 0).astype(U64)[s.of]
                    ctx, suf = place[on - 1], place[on]
                else:
                    ctx, suf = less[on - 1], less[on]
                    if contexts is not None:
                        at = tables[0].find(ctx)
                        there = at >= 0
                        on, suf = on[there], suf[there]
                        ctx = at[there].astype(U64) if names[0] is not None else ctx[there]
                    if suffixes is not None:
                        at = tables[1].find(suf)
                        there = at >= 0
                        ctx = ctx[there]
                        suf = at[there].astype(U64) if names[1] is not None else suf[there]
                held.append((ctx, suf))
            if sum(len(x[0]) for x in held) >= FLUSH_TOKENS:
                yield flush()
        yield flush()
    return run


def _sum_grams(size: int, names: list, least: float):
    """All (part, grams) of a part -> (key, ctx, suf, n) of the grams with at least ``least``."""
    paired = names[0] is not None and names[1] is not None

    def run(table: pa.Table) -> pa.Table:
        pieces = [_unpacked(x) for x in table["grams"].to_pylist()]
        ctx, suf, n = _sums(*(np.concatenate([x[i] for x in pieces]) for i in range(3)), paired)
        enough = n >= least
        ctx, suf, n = ctx[enough], suf[enough], n[enough]
        ctx, suf = (x if name is None else name.value[x.astype(np.int64)] for x, name in zip((ctx, suf), names))
        return pa.table([pa.array(signed(x)) for x in (_longer(ctx, suf, size), ctx, suf, n)], ["key", "ctx", "suf", "n"])
    return run


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, c) -> (key, n)"""
    for b in batches:
        h = words64(b" ".join(b.column(0).to_pylist()))[0]
        yield pa.RecordBatch.from_arrays([pa.array(signed(h)), b.column(1)], ["key", "n"])


def _outside(head):
    """(row, text) -> (row, key): each text's distinct words outside the head."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, data in zip(b.column(0).to_pylist(), lowered(b.column(1))):
                h = np.unique(words64(data)[0])
                h = h[_find(head.value, h) < 0]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), row)), pa.array(signed(h))], ["row", "key"])
    return run


def _shared_keys(keys: DataFrame):
    return keys.sparkSession.sparkContext.broadcast(np.sort(keys.toArrow().column(0).to_numpy().view(U64)))


def least_counts(n: int) -> tuple[float, float]:
    """The least count of a word or context and of a next symbol, given the number of tokens."""
    m = min(n, REFERENCE)
    return m * LEAST_SHARE, max(2, m * LEAST_ENTRY)


def grow(texts: DataFrame, words: DataFrame, n: int, once: int, alphabet, extras: bool = True) -> DataFrame:
    """(key, n, delta, bow): all considered grams of the training texts (text, extra) with ``n`` tokens, whose
    distinct ones are in ``words`` and of which ``alphabet`` and the texts' ``extra`` (if ``extras``) are symbols."""
    spark = texts.sparkSession
    least, least_entry = least_counts(n)
    is_end = F.col("word") == F.lit(END)
    frequent = words.where((F.col("c") >= least) & ~is_end)
    inside = frequent.agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    ends = max(1, words.where(is_end).agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0])
    other = max(0, n - inside - ends)
    both = spark.range(2).select(F.col("id").alias("key"), F.when(F.col("id") == int(OTHER), other).otherwise(ends).cast("long").alias("n"))
    p = (F.col("n") + F.when(F.col("key") == int(OTHER), once).otherwise(0)) / F.lit(float(inside + ends + other + once))
    grams = [cut(frequent.mapInArrow(_keyed, "key long, n long").unionByName(both).select("key", "n", p.alias("p"), F.log10(p).alias("delta"),
                                                                                              (F.col("key") == int(END_SYMBOL)).alias("ends")))]
    states: list[DataFrame] = []
    contexts, shared, suffixes = None, None, None
    symbols = spark.sparkContext.broadcast(np.concatenate([np.array([OTHER, END_SYMBOL]), alphabet.value])) if not extras else None
    for size in range(2, DEPTH + 2):
        names = [symbols, symbols] if size == 2 else [shared, suffixes]
        e = texts.mapInArrow(_count_grams(size, alphabet, shared, suffixes, names, 1 + n // PART_TOKENS), "part long, grams binary")
        e = e.groupBy("part").applyInArrow(_sum_grams(size, names, least_entry), "key long, ctx long, suf long, n long")
        if contexts is not None and shared is None:
            e = e.join(contexts.withColumnRenamed("key", "ctx"), "ctx", "left_semi")
        lower = grams[-1].select(F.col("key").alias("suf"), F.col("p").alias("lower"), "ends")
        e = cut(e.join(small(lower, BROADCAST_ROWS), "suf"))
        s = e.groupBy("ctx").agg(F.sum("n").alias("own"), F.count("*").alias("kinds"), F.sum("lower").alias("theirs"),
                                 F.sum(F.col("n") * F.log(F.col("n") / F.col("lower"))).alias("nats"))
        s = s.join(grams[-1].select(F.col("key").alias("ctx"), F.col("n").alias("total")), "ctx")
        rest = F.col("total") - F.col("own")
        mine = rest / F.col("total")
        theirs = F.greatest(1 - F.col("theirs"), F.lit(1e-12))   # all other symbols together
        nats = F.col("nats") / F.col("total") - F.col("own") / F.col("total") * F.log("total") + F.when(
            rest > 0, mine * F.log(mine / theirs)).otherwise(0.0)
        s = s.select("ctx", "total", rest.alias("rest"), nats.alias("nats"), (F.col("kinds") + (rest > 0).cast("long")).alias("kinds"))
        kept = ((F.col("total") >= least) & (F.col("nats") >= LEAST_DIVERGENCE)
                & (F.col("nats") * F.col("total") > F.col("kinds") * F.log(F.greatest(F.col("total"), F.lit(2)))))
        whole = F.col("total") + F.col("kinds")
        s = cut(s.select("ctx", whole.alias("whole"), ((F.col("kinds") + F.col("rest")) / whole).alias("left"), kept.alias("kept")))
        p = F.col("n") / F.col("whole") + F.col("left") * F.col("lower")  # Witten-Bell
        e = e.join(small(s.select("ctx", "whole", "left"), BROADCAST_ROWS), "ctx").select(
            "key", "n", "ctx", "suf", "ends", p.alias("p"), F.log10(p / (F.col("left") * F.col("lower"))).alias("delta"))
        grams.append(cut(e))
        states.append(s)
        # contexts of the next depth: a frequent enough context and next symbol, not beyond the end
        contexts = grams[-1].where((F.col("n") >= least) & ~F.col("ends")).select("key")
        few = contexts.limit(HEAD_GRAMS + 1).count() <= HEAD_GRAMS
        shared = _shared_keys(contexts) if few else None
        # a gram is no more frequent than the gram less its oldest symbol: if that has no entry, neither has it
        suffixes = _shared_keys(grams[-1].select("key")) if grams[-1].count() <= SUFFIX_GRAMS else None
        del e, s
        release(spark)
    # with a kept context its suffixes and prefixes are kept
    bows: list[DataFrame] = []
    more = None
    for depth in range(DEPTH, 0, -1):
        s = states[depth - 1]
        keys = s.where("kept").select(F.col("ctx").alias("key"))
        keys = keys if more is None else keys.unionByName(more).distinct()
        bows.insert(0, cut(s.join(keys.withColumnRenamed("key", "ctx"), "ctx", "left_semi").select(
            F.col("ctx").alias("key"), F.log10("left").alias("bow"))))
        if depth > 1:
            more = grams[depth - 1].join(small(bows[0].select("key"), BROADCAST_ROWS), "key", "left_semi").select(
                F.explode(F.array("ctx", "suf")).alias("key"))
    zero, out = F.lit(0.0), []
    for size, g in enumerate(grams, 1):
        if size > 1:
            on = bows[size - 2].select(F.col("key").alias("ctx"), F.lit(True).alias("on"))
            g = g.join(small(on, BROADCAST_ROWS), "ctx", "left").withColumn("delta", F.when(F.col("on"), F.col("delta")).otherwise(zero))
        if size <= DEPTH:
            g = g.join(small(bows[size - 1], BROADCAST_ROWS), "key", "left")
        else:
            g = g.withColumn("bow", zero)
        out.append(g.select("key", "n", "delta", F.coalesce("bow", zero).alias("bow")))
    model = out[0]
    for x in out[1:]:
        model = model.unionByName(x)
    return cut(model)


@dataclass
class Scorer:
    """What the executors get: the frequent words' hashes (sorted) and counts, and the frequent grams."""

    alphabet: np.ndarray  # of the frequent words, those that are symbols (sorted)
    keys: np.ndarray
    counts: np.ndarray
    grams: np.ndarray     # sorted
    delta: np.ndarray
    bow: np.ndarray
    whole: bool           # whether no other gram has a delta or bow
    others_bits: np.ndarray  # of the keys of those other grams, see _bitmap
    end_count: int
    others: int           # tokens of training words outside the alphabet, and once more those seen once
    scale: float          # log10 of what the counts of the word-frequency score are divided by

    def maybe(self, keys: np.ndarray) -> np.ndarray:
        """False for keys that are certainly none of the infrequent grams."""
        word = self.others_bits[(keys & U64(FILTER_BITS - 1)) >> U64(6)]
        return (word >> (keys & U64(63))) & (word >> (keys >> U64(58))) & U64(1) == 1

    @cached_property
    def gram_keys(self) -> Keys:
        return Keys(self.grams)

    @cached_property
    def word_keys(self) -> Keys:
        return Keys(self.keys)

    @cached_property
    def symbols(self) -> Keys:
        return Keys(self.alphabet)

    def walk(self, s: Stream, n: int) -> tuple[np.ndarray, list[tuple]]:
        """Per text the sum over the frequent grams, and the others as (text, key, uses as entry, uses as context)."""
        size = len(s.symbols)
        score, rest = np.zeros(n), []
        gram, at = s.symbols, np.empty(size, dtype=np.int64)
        at[:] = self.gram_keys.find(np.array([END_SYMBOL]))[0]
        at[s.place] = self.gram_keys.find(np.where(s.known, s.unique, OTHER))[s.of]
        on = np.arange(size)                 # positions whose gram may be in the model
        for k in range(1, DEPTH + 2):
            found = at >= 0
            hit, entry = at[found], on[found]
            later = on[found & (on < size - 1)] if k == 1 else entry[s.symbols[entry] != END_SYMBOL]
            first = entry > 0                # the end token before all texts is not predicted
            score += np.bincount(s.owner[entry[first]], weights=self.delta[hit[first]], minlength=n)
            bow = np.zeros(size)
            bow[entry] = self.bow[hit]
            score += np.bincount(s.owner[later + 1], weights=bow[later], minlength=n)
            alive = bow != 0
            if not self.whole:
                lost = on[~found]
                lost = lost[self.maybe(gram[lost])]
                alive[lost] = True
                x = lost[lost > 0]
                rest.append((s.owner[x], gram[x], np.ones(len(x), np.int64), np.zeros(len(x), np.int64)))
                if k <= DEPTH:
                    x = lost[lost < size - 1] if k == 1 else lost[s.symbols[lost] != END_SYMBOL]
                    rest.append((s.owner[x + 1], gram[x], np.zeros(len(x), np.int64), np.ones(len(x), np.int64)))
            if k > DEPTH:
                break
            # the entries of a context that is not kept, and its extensions, are not in the model
            # (the suffix of a kept context is kept, so there is a gram of k symbols at these places)
            there = np.zeros(size, dtype=bool)
            there[on] = True
            on = np.flatnonzero((s.since >= k) & there & np.concatenate([[False], alive[:-1]]))
            longer = np.zeros(size, dtype=U64)
            longer[on] = _longer(gram[on - 1], gram[on], k + 1)
            gram, at = longer, self.gram_keys.find(longer[on])
        return score, rest

    def batch(self, texts: list[bytes], extra: np.ndarray) -> tuple:
        """Per text: tokens, of them frequent, the word-frequency score of those, the tree's score
        (less what infrequent words and grams add), the infrequent words with their counts; the infrequent grams."""
        s = Stream(texts, self.symbols, extra)
        n = len(texts)
        u, index, of = s.unique, s.index, s.of
        at = self.word_keys.find(u)
        frequent = at >= 0
        c = np.where(frequent, self.counts[at] if len(self.counts) else 0, 0)
        base = np.where(frequent, np.log10(c + ADD) - self.scale, 0.0)
        own = np.where(~s.known, np.where(frequent, np.log10(np.maximum(c, 1)), 0.0) - np.log10(self.others), 0.0)
        per = lambda w: np.bincount(s.doc, weights=w[of], minlength=n)
        tokens = np.bincount(s.doc, minlength=n) + 1
        known = per(frequent.astype(float)).astype(np.int64) + (self.end_count > 0)
        score, rest = self.walk(s, n)
        rare = np.flatnonzero(~frequent[of])
        width = np.int64(max(len(u), 1))
        pair, times = np.unique(s.doc[rare] * width + of[rare], return_counts=True)
        k = pair % width
        first, last = s.first[index[k]].tolist(), s.last[index[k]].tolist()
        words = _lists(pair // width, n, [pa.array([s.data[i:j] for i, j in zip(first, last)], pa.binary()), pa.array(times), pa.array(~s.known[k])],
                       ["word", "n", "other"])
        return tokens, known, per(base) + np.log10(self.end_count + ADD) - self.scale, score + per(own), words, *_uses(rest, n)


def _bitmap(keys: DataFrame) -> np.ndarray:
    """Two bits per key, by its lowest and highest 6 bits, in one of the 64-bit words, by the bits above the lowest; at most
    ``FILTER_BITS`` bits reach the driver."""
    slot = F.col("key").bitwiseAND(F.lit(FILTER_BITS - 1))
    words = keys.groupBy(F.shiftright(slot, 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(key & 63 as int)) | shiftleft(1L, cast(shiftrightunsigned(key, 58) as int))")).alias("bits")).toArrow()
    out = np.zeros(FILTER_BITS // 64, dtype=U64)
    out[words.column(0).to_numpy()] = words.column(1).to_numpy().view(U64)
    return out


def _offsets(owner: np.ndarray, n: int) -> pa.Array:
    offsets = np.zeros(n + 1, dtype=np.int32)
    np.cumsum(np.bincount(owner, minlength=n), out=offsets[1:])
    return pa.array(offsets)


def _lists(owner: np.ndarray, n: int, values: list[pa.Array], names: list[str]) -> pa.ListArray:
    """Per text its values (ascending by ``owner``), a struct each."""
    return pa.ListArray.from_arrays(_offsets(owner, n), pa.StructArray.from_arrays(values, names))


def _uses(rest: list[tuple], n: int) -> tuple[pa.ListArray, pa.ListArray]:
    """Per text the keys of its infrequent grams, each once, and their uses: as entry in the upper and as context in the
    lower half of a number. (Two lists of numbers take a fifth of a list of structs.)"""
    owner, key, entry, context = (np.concatenate([x[i] for x in rest]) if rest else np.empty(0, np.int64) for i in range(4))
    key, use = key.view(np.int64), (entry << 32) | context
    order = np.lexsort((key, owner))
    owner, key = owner[order], key[order]
    if len(key):
        begin = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (key[1:] != key[:-1])]))
        owner, key, use = owner[begin], key[begin], np.add.reduceat(use[order], begin)
    offsets = _offsets(owner, n)
    return pa.ListArray.from_arrays(offsets, pa.array(key)), pa.ListArray.from_arrays(offsets, pa.array(use))


def _head(words: DataFrame, size: int) -> F.Column:
    """The condition of being among the most frequent words, which at most ``size`` words fulfil."""
    bins = words.groupBy(F.floor(F.log2("c") * 8).alias("bin")).agg(F.count("*").alias("n"), F.min("c").alias("c")).collect()
    least, total = 1 << 62, 0
    for r in sorted(bins, key=lambda r: -r.c):
        total += r.n
        if total > size:
            break
        least = r.c
    return F.col("c") >= least


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fold: F.Column | None = None) -> DataFrame:
    """One row per input row: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    The rows where ``fold`` (default: crc32 of the id as text, null as empty, modulo 10) is 0 are held
    out of training. ``base_score`` is the sum over tokens of log10((c + 0.1) / (N + 0.1 (V + 1))) with
    the training counts c, their sum N and the number of distinct tokens V; ``score`` is the tree's
    log10 probability of the tokens. A null text is empty: the end token alone. Without training rows
    all words are the one unknown event.
    """
    spark = docs.sparkSession
    small_batches(spark)
    fold = F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(10)) if fold is None else fold
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), (fold == 0).alias("held_out"))
    train = lambda c: d.where(~F.col("held_out")).select(*c)
    words = cut(word_counts(train(["text"])))
    release(spark)
    n, v, once = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*"), F.count(F.when(F.col("c") == 1, 1))).first()
    once, least = max(1, once), least_counts(n)[0]
    is_end, is_head = F.col("word") == F.lit(END), _head(words, HEAD_WORDS)
    # hashed in the tasks: the words themselves would take several times the driver's memory
    top = words.where(is_head & ~is_end).mapInArrow(_keyed, "key long, n long").toArrow()
    keys = top.column(0).to_numpy().view(U64)
    order = np.argsort(keys)
    keys, counts = keys[order], top.column(1).to_numpy()[order]
    del top, order
    alphabet = spark.sparkContext.broadcast(keys[counts >= least])
    beyond = words.where(~is_head & ~is_end & (F.col("c") >= least))
    extras = beyond.limit(1).count() > 0
    if extras:  # symbols that are not in the head go to the texts that have them
        d = cut(d.withColumn("row", F.monotonically_increasing_id()))
        outside = d.select("row", "text").mapInArrow(_outside(spark.sparkContext.broadcast(keys)), "row long, key long")
        extra = outside.join(beyond.mapInArrow(_keyed, "key long, n long"), "key").groupBy("row").agg(F.collect_list("key").alias("extra"))
        d = cut(d.join(extra, "row", "left").drop("row"))
    else:
        d = d.withColumn("extra", F.lit(None).cast("array<long>"))
    model = grow(train(["text", "extra"]), words, n, once, alphabet, extras)
    release(spark)
    live = model.where("delta != 0 or bow != 0")
    whole = live.limit(HEAD_GRAMS + 1).count() <= HEAD_GRAMS
    # grams without either number count for nothing, also as the frequent ones that are broadcast
    is_top = F.lit(True) if whole else _head(live.withColumnRenamed("n", "c"), HEAD_GRAMS)
    grams = live.withColumnRenamed("n", "c").where(is_top).select("key", "delta", "bow").toArrow()
    gram = grams.column(0).to_numpy().view(U64)
    order = np.argsort(gram)
    gram, delta, bow = gram[order], grams.column(1).to_numpy()[order], grams.column(2).to_numpy()[order]
    del grams, order
    release(spark)
    tail = live.withColumnRenamed("n", "c").where(~is_top).select("key", "delta", "bow")
    bits = np.empty(0, U64) if whole else _bitmap(tail)
    ends = words.where(is_end).collect()
    inside = words.where((F.col("c") >= least) | is_end).agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    scale = float(np.log10(n + ADD * (v + 1)))
    shared = spark.sparkContext.broadcast(Scorer(alphabet.value, keys, counts, gram, delta, bow, whole, bits,
                                                 ends[0].c if ends else 0, n - inside + once, scale))

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        scorer = shared.value
        for texts, extra in batches:
            *rows, rare, keys, uses = scorer.batch(lowered(texts), _extra(extra))
            yield pa.StructArray.from_arrays([*(pa.array(x) for x in rows), rare, keys, uses],
                                             ["n_tokens", "n_known", "base", "score", "rare", "grams", "uses"])

    udf = F.arrow_udf(run, "n_tokens long, n_known long, base double, score double, "
                           "rare array<struct<word:binary,n:long,other:boolean>>, grams array<long>, uses array<long>")
    scored = cut(d.select("id", "held_out", udf("text", "extra").alias("s"), F.monotonically_increasing_id().alias("row")))
    rare = scored.select("row", F.explode("s.rare").alias("w")).select("row", "w.word", "w.n", "w.other")
    c = F.coalesce("c", F.lit(0))
    seen = F.when(c > 0, c).otherwise(F.lit(once))
    found = rare.join(words.where(~is_head), "word", "left").groupBy("row").agg(
        F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("known"), F.sum(F.col("n") * (F.log10(c + F.lit(ADD)) - scale)).alias("more"),
        F.sum(F.when(F.col("other"), F.col("n") * F.log10(seen)).otherwise(0.0)).alias("more_score"))
    out = scored.select("id", "held_out", "s.n_tokens", "s.n_known", "s.base", "s.score", "row").join(found, "row", "left")
    zero = F.lit(0.0)
    more_grams = zero
    if not whole:
        uses = scored.select("row", F.explode(F.arrays_zip(F.col("s.grams").alias("key"), F.col("s.uses").alias("use"))).alias("g"))
        uses = uses.select("row", "g.key", "g.use").join(tail, "key")
        d, b = F.shiftright("use", 32), F.col("use").bitwiseAND(F.lit((1 << 32) - 1))
        out = out.join(uses.groupBy("row").agg(F.sum(d * F.col("delta") + b * F.col("bow")).alias("gram_score")), "row", "left")
        more_grams = F.coalesce("gram_score", zero)
    return out.select(
        F.col("id").alias(id_col), "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", zero)).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", zero) + more_grams).alias("score"))
