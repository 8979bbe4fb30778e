"""Document fingerprints by winnowing, in DataFrame expressions only.

A text is cut into words of at most 16 characters (longer runs are cut, so scripts without blanks
have several). Every k consecutive words give a hash; of every window of w consecutive hashes the
least is chosen, of equal ones the rightmost, and kept with its position. Two texts that share
k + w - 1 words in a row share a fingerprint; an edit changes fingerprints near it only.

All of it is a map: arrays of one text's words and hashes, bound once by ``let`` so that no
expression is evaluated twice.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil, sqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GRAM = 5       # k: words hashed together
WINDOW = 8     # w: hashes of which one is chosen
PIECE = r"[^\x20\x09-\x0D]{1,16}"
LAST = (1 << 31) - 1
BUCKETS_PER_PARTITION = 4


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def gram_hashes(text: Column, k: int = GRAM) -> Column:
    """Hashes of every k consecutive words in order; of all words as one if there are fewer; none without words."""
    words = F.regexp_extract_all(F.lower(text), F.lit(PIECE), F.lit(0))

    def grams(h: Column) -> Column:
        n = F.size(h)
        rolled = F.transform(F.sequence(F.lit(0), n - k), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(k)]))
        return F.when(n >= k, rolled).when(n > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))
    return let(F.transform(words, lambda w: F.xxhash64(w)), grams)


def winnowed(hashes: Column, w: int = WINDOW) -> Column:
    """array of struct(hash, pos): the chosen hashes by ascending position.

    Hashes are compared by their upper 32 bits. Those and the position counted from the end make
    one number, whose minimum over a window is the rightmost least; minima over w numbers come from
    minima over half as many.
    """
    def least_of(c: Column, size: int) -> Column:  # c: minima over ``size`` numbers from each place on
        if size >= w:
            return c
        step = min(size, w - size)
        return let(F.transform(c, lambda x, i: F.least(x, F.get(c, i + step))), lambda m: least_of(m, size + step))

    def choose(h: Column) -> Column:
        ranked = F.transform(h, lambda x, i: F.shiftleft(F.shiftrightunsigned(x, 32), 31).bitwiseOR(F.lit(LAST) - i.cast("bigint")))
        chosen = let(ranked, lambda c: F.array_distinct(F.slice(least_of(c, 1), F.lit(1), F.greatest(F.size(c) - (w - 1), F.least(F.size(c), F.lit(1))))))

        def place(x: Column) -> Column:
            return let((F.lit(LAST) - x.bitwiseAND(F.lit(LAST))).cast("int"), lambda p: F.struct(F.get(h, p).alias("hash"), p.alias("pos")))
        return F.transform(chosen, place)
    return let(hashes, choose)


def fingerprint(text: Column, k: int = GRAM, w: int = WINDOW) -> Column:
    """array of struct(hash, pos) of a text; null counts as empty."""
    return winnowed(gram_hashes(F.coalesce(text, F.lit("")), k), w)


def fingerprint_text(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda x: F.concat(F.hex(x["hash"]), F.lit(":"), x["pos"].cast("string"))), ",")


def hashes_of(found: Column) -> Column:
    return F.array_distinct(F.transform(found, lambda x: x["hash"]))


def likeness(a: Column, b: Column) -> Column:
    """Share of common ones among two arrays of distinct hashes (1 if both are empty)."""
    both = F.size(F.array_intersect(a, b))
    return let(both, lambda n: F.when(F.size(a) + F.size(b) == 0, F.lit(1.0)).otherwise(
        n.cast("double") / F.greatest(F.size(a) + F.size(b) - n, F.lit(1))))


def _bucket(bounds: list[int], id_: Column) -> Column:
    """How many of the ascending bounds are at most the id (null: -1), by a two-step search."""
    if not bounds:
        return F.when(id_.isNull(), F.lit(-1)).otherwise(F.lit(0))
    step = ceil(sqrt(len(bounds)))
    array = lambda x: F.array(*[F.lit(v) for v in x]).cast("array<bigint>")
    coarse = F.size(F.filter(array(bounds[::step]), lambda b: b <= id_))
    fine = let(coarse, lambda c: F.when(c == 0, F.lit(0)).otherwise(
        (c - 1) * step + F.size(F.filter(F.slice(array(bounds), (c - 1) * step + 1, F.lit(step)), lambda b: b <= id_))))
    return F.when(id_.isNull(), F.lit(-1)).otherwise(fine)


def with_next(docs: DataFrame, columns: dict[str, Callable[[Column], Column]], buckets: int | None = None) -> DataFrame:
    """docs (id, text) and, of each row's ``columns`` (functions of the text), the next row's as ``next_*``.

    The order is descending id, nulls last, ties by text; after the last comes the first. Rows are
    ranged into buckets by quantiles of the id, each text is shuffled once, and the first row of a
    bucket is also copied behind the preceding one, so that nothing else crosses buckets.
    """
    spark = docs.sparkSession
    buckets = buckets or BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = [i / buckets for i in range(1, buckets)]
    found = docs.agg(F.percentile_approx("id", cuts or [0.5], max(10_000, 10 * buckets))).first()[0] or []
    bounds = sorted(set(found)) if cuts else []
    ranged = docs.withColumn("bucket", _bucket(bounds, F.col("id")))
    tops = ranged.groupBy("bucket").agg(F.max("id").alias("top")).orderBy("bucket").collect()  # one row a bucket
    copies = [(tops[i - 1].top, tops[i].bucket) for i in range(len(tops))]  # the lowest bucket gets the very first row
    copied = F.broadcast(spark.createDataFrame(copies, "top long, target int"))
    places = F.filter(F.array(F.struct(F.col("bucket").alias("bucket"), F.lit(0).alias("copy")),
                              F.struct(F.col("target").alias("bucket"), F.lit(1).alias("copy"))), lambda x: x["bucket"].isNotNull())
    dealt = ranged.join(copied, F.col("id").eqNullSafe(F.col("top")), "left").select("id", "text", F.explode(places).alias("p"))
    dealt = dealt.select("id", "text", "p.bucket", "p.copy").repartition("bucket")
    dealt = dealt.withColumns({name: f(F.col("text")) for name, f in columns.items()})
    order = Window.partitionBy("bucket").orderBy("copy", F.col("id").desc_nulls_last(), F.col("text").asc_nulls_first())
    return dealt.withColumns({f"next_{c}": F.lead(c).over(order) for c in columns}).where("copy = 0").drop("bucket", "copy")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = GRAM, w: int = WINDOW) -> DataFrame:
    """One row per input row: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many of the
    next text (see ``with_next``; null counts as empty). Fingerprints are ``hash:pos`` lists; the
    likenesses compare sets of hashes. Of a single row the next row is itself.
    """
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    x = with_next(d, {"text_of": lambda t: t, "found": lambda t: fingerprint(t, k, w)})
    n = F.char_length("text")
    half = F.shiftright(n, 1)
    x = x.select("id", n.cast("long").alias("n_chars"), "found", "next_found",
                 F.concat(F.left("text", n - half), F.left("next_text_of", half)).alias("edited"))
    x = x.withColumn("edited_found", fingerprint(F.col("edited"), k, w))
    own = hashes_of(F.col("found"))
    return x.select(
        F.col("id").alias(id_col), "n_chars", F.sha2("edited", 256).alias("edited_sha256"), fingerprint_text(F.col("found")).alias("fingerprint"),
        fingerprint_text(F.col("edited_found")).alias("edited_fingerprint"),
        let(own, lambda a: likeness(a, hashes_of(F.col("edited_found")))).alias("near_edited"),
        let(own, lambda a: likeness(a, hashes_of(F.col("next_found")))).alias("near_next"))
