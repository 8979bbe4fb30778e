"""Near-duplicate documents by b-bit MinHash.

Per document: hashes of its distinct word shingles, 256 minima, 51 band keys over five minima
each, and a signature of the two low bits of every minimum packed into eight longs. Documents
with equal shingle sets form one class with one representative, so copies never meet in pairs.

Candidates come from the bands as stars: everyone in a bucket against the bucket's least
document, linear in the bucket. The packed signatures then estimate the similarity, corrected
for chance agreement of two bits, by counting bits; what could reach the threshold is confirmed
on the full shingle sets.

Buckets that still hold several components are settled exactly from the full sets of their
documents. A pair at the threshold whose least frequent common shingle is rare among them (in at
most ``RARE`` documents) has it among the first fifth of both sets by rising frequency, and is found
by joining those. Any other pair shares no rare shingle at all, which leaves too few to reach the
threshold for heavily edited copies and for documents that have just a passage in common. What
remains is paired across components within its bucket; a bucket too large for that is divided by
joining its key with the keys of each of the next bands (a similar pair agrees in a third of them),
and treated alike. Nothing is capped.

A pair at the threshold agrees in no band with probability (1 - 0.8^5)^51 < 2e-9; even if all its
buckets had to be divided it is missed with about 1e-8. The estimate, five deviations below the
threshold, loses about 1e-7.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridflow.llm.common import U64, compact, cut, grams64, list_array, lowered, mix, partitions_for, signed, small, small_batches, words64
from gridflow.llm.graph import components

SHINGLE_WORDS = 5
THRESHOLD = 80          # in hundredths: 100 * intersection >= 80 * union
LANES = 256             # minima per document
BITS = 2                # low bits kept of each
BAND_ROWS, BANDS = 5, 51
PAIRED_BUCKET = 1024    # larger unresolved buckets are divided before they are paired
RARE = 64               # shingles in at most so many unresolved documents are joined
DIVIDING_BANDS = 6      # a bucket is divided by each of so many other bands
PAIRED_ROWS = 20_000    # rows of a partition that are paired with each other by key
CHUNK_PARTNERS = 256    # documents compared in one run with one copy of their counterpart
BROADCAST_IDS = 1_000_000
LANE_MASK = 0x5555555555555555

_rng = np.random.default_rng(7)
_MUL = (_rng.integers(0, 1 << 32, LANES, dtype=np.uint64) | 1).astype(np.uint32)[:, None]
_ADD = _rng.integers(0, 1 << 32, LANES, dtype=np.uint64).astype(np.uint32)[:, None]


def minima(shingles: np.ndarray) -> np.ndarray:
    """The least value of each of the hash functions over the (distinct) shingle hashes."""
    x = (shingles >> U64(32)).astype(np.uint32)
    low = np.full(LANES, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(x), 2048):
        np.minimum(low, (_MUL * x[at:at + 2048] + _ADD).min(axis=1), out=low)
    return low


def packed(low: np.ndarray) -> np.ndarray:
    """Two (mixed) low bits of every minimum, 32 lanes to a long."""
    bits = mix(low.astype(U64)) & U64(3)
    return (bits.reshape(-1, 32) << (U64(2) * np.arange(32, dtype=U64))).sum(axis=1, dtype=U64)


def band_keys(low: np.ndarray) -> np.ndarray:
    h = np.arange(1, BANDS + 1, dtype=U64)
    rows = low[:BANDS * BAND_ROWS].reshape(BANDS, BAND_ROWS).astype(U64)
    for i in range(BAND_ROWS):
        h = mix(h * U64(0x9E3779B97F4A7C15) + rows[:, i])
    return h


def shingle_set(data: bytes, k: int) -> np.ndarray:
    return np.unique(grams64(words64(data)[0], k))


def _sign(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cls, n, sig, bands, counts = [], [], [], [], []
            for data in lowered(b.column(1)):
                s = shingle_set(data, k)
                n.append(len(s))
                counts.append(1 if len(s) else 0)
                cls.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                if len(s):
                    low = minima(s)
                    sig.append(packed(low))
                    bands.append(band_keys(low))
            c = np.array(counts, dtype=np.int64)
            join = lambda x: signed(np.concatenate(x)) if x else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(cls, pa.binary()), pa.array(n, pa.int64()),
                 list_array(join(sig), c * (LANES * BITS // 64)), list_array(join(bands), c * BANDS)],
                ["id", "cls", "n", "sig", "bands"])
    return run


def _agreement(a: str, b: str) -> F.Column:
    """Similarity estimated from two packed signatures: share of equal lanes, less chance."""
    x = [F.col(f"{a}")[i].bitwiseXOR(F.col(f"{b}")[i]) for i in range(LANES * BITS // 64)]
    differ = sum((F.bit_count(v.bitwiseOR(F.shiftrightunsigned(v, 1)).bitwiseAND(F.lit(LANE_MASK))) for v in x),
                 F.lit(0))
    chance = 1.0 / (1 << BITS)
    return ((1 - differ / F.lit(float(LANES))) - chance) / (1 - chance)


def _least_estimate(threshold: int) -> float:
    s, chance = threshold / 100, 1 / (1 << BITS)
    p = s + (1 - s) * chance
    return s - 5 * (p * (1 - p) / LANES) ** 0.5 / (1 - chance)


def _verify(k: int, threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, heads = None, []  # texts of the present run's counterpart (several only if its id repeats)
        for b in batches:
            out_a, out_b = [], []
            cols = [b.column(i).to_pylist() for i in range(4)]
            for key, chunk, flag, a, data in zip(*cols, lowered(b.column(4))):
                if at != (key, chunk):
                    at, heads = (key, chunk), []
                s = shingle_set(data, k)
                if flag == 0:
                    heads.append(s)
                    continue
                for h in heads:
                    if threshold * max(len(s), len(h)) > 100 * min(len(s), len(h)):
                        continue
                    both = len(np.intersect1d(s, h, assume_unique=True))
                    if 100 * both >= threshold * (len(s) + len(h) - both):
                        out_a.append(a)
                        out_b.append(key)
                        break
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], ["a", "b"])
    return run


def confirmed(pairs: DataFrame, docs: DataFrame, k: int, threshold: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the threshold. ``docs`` (id, text).

    The partners of one b are cut into runs of bounded size; b's text goes once to each run and
    the rows stream past it in sorted order, so no group is held in memory. The result is cut.
    """
    pairs, n = compact(pairs)
    if not n:
        return pairs
    runs = pairs.groupBy("b").agg(F.ceil(F.count("*") / CHUNK_PARTNERS).alias("runs"))
    dealt = pairs.join(runs, "b").select("a", "b", F.pmod(F.xxhash64("a"), F.col("runs")).alias("run"))
    heads = dealt.select(F.col("b").alias("i"), "b", "run", F.lit(0).alias("flag"), F.lit(None).cast("long").alias("a")).distinct()
    roles = compact(dealt.select(F.col("a").alias("i"), "b", "run", F.lit(1).alias("flag"), "a").unionByName(heads))[0]
    texts = docs.join(_broadcast(roles, 2 * n), F.col("id") == F.col("i")).select("b", "run", "flag", "a", "text")
    return compact(texts.repartition("b", "run").sortWithinPartitions("b", "run", "flag")
                   .mapInArrow(_verify(k, threshold), "a long, b long"))[0]


def _broadcast(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast a table whose number of (narrow) rows is known to be small enough."""
    return F.broadcast(df) if rows <= BROADCAST_IDS else df


def _likely(pairs: DataFrame, sigs: DataFrame, threshold: int) -> DataFrame:
    """Those of the distinct pairs (a, b) whose signatures allow the threshold."""
    pairs, n = compact(pairs)
    if not n:
        return pairs
    if 2 * n <= BROADCAST_IDS:  # few pairs: their signatures alone
        ids = pairs.select(F.col("a").alias("i")).unionByName(pairs.select(F.col("b").alias("i"))).coalesce(partitions_for(2 * n)).distinct()
        sigs = compact(sigs.join(F.broadcast(ids), F.col("node") == F.col("i"), "left_semi"))[0]
    sa = sigs.select(F.col("node").alias("a"), F.col("sig").alias("sa"))
    sb = sigs.select(F.col("node").alias("b"), F.col("sig").alias("sb"))
    return pairs.join(sa, "a").join(sb, "b").where(_agreement("sa", "sb") >= _least_estimate(threshold)).select("a", "b")


def _shingles(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingle_set(data, k) for data in lowered(b.column(1))]
            n = [len(s) for s in sets]
            flat = np.concatenate(sets) if sets else np.empty(0, U64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) for s in sets], pa.int64()),
                 pa.array(n, pa.int64()), list_array(signed(flat), n)], ["node", "text", "n", "shingles"])
    return run


def _sets(rest: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """(node, text, n, shingles): the full sets of the nodes; text tells several texts of one id apart."""
    ids = rest.select(F.col("node").alias("i")).distinct()
    texts = docs.join(small(ids, BROADCAST_IDS), F.col("id") == F.col("i"), "left_semi").select("id", "text")
    return texts.mapInArrow(_shingles(k), "node long, text long, n long, shingles array<long>").distinct()


def _rare(sets: DataFrame) -> DataFrame:
    """(node, text, n, shingle, m, rank) of the shingles that at most RARE sets hold: ranked by m, the
    number of sets, then by the shingle."""
    each = sets.select("node", "text", "n", F.explode("shingles").alias("shingle"))
    often = each.groupBy("shingle").agg(F.count("*").alias("m"))
    by = Window.partitionBy("node", "text").orderBy("m", "shingle")
    return each.join(often.where(F.col("m") <= RARE), "shingle").withColumn("rank", F.row_number().over(by))


def _sharing_rare(rare: DataFrame, rest: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b) across components that share a rare shingle of the first part of both sets: two
    sets at the threshold have their least common shingle among the first n - ceil(n t) + 1."""
    first = F.col("n") - F.ceil(F.col("n") * threshold / 100) + 1
    nodes, n = compact(rest.select("node", "component").distinct())
    head = compact(rare.where((F.col("m") > 1) & (F.col("rank") <= first)).join(_broadcast(nodes, n), "node"), PAIRED_ROWS)[0]
    ends = [head.select("shingle", *[F.col(c).alias(c + x) for c in ("node", "component", "n")]) for x in "ab"]
    return ends[0].join(ends[1], "shingle").where(
        (F.col("nodea") < F.col("nodeb")) & (F.col("componenta") != F.col("componentb"))
        & (100 * F.least("na", "nb") >= threshold * F.greatest("na", "nb"))).select(
        F.col("nodea").alias("a"), F.col("nodeb").alias("b")).distinct()


def _unresolved(rest: DataFrame) -> tuple[DataFrame, int]:
    """The rows of keys with several components, and the key's number of rows; cut, with their count."""
    state, n = compact(rest.groupBy("key").agg(F.min("component").alias("c0"), F.max("component").alias("c1"),
                                               F.count("*").alias("size")).where("c0 < c1").select("key", "size"))
    return compact(rest.join(_broadcast(state, n), "key"))


def _able(rest: DataFrame, sets: DataFrame, rare: DataFrame, threshold: int) -> DataFrame:
    """``rest`` with n, the size of the set, and common, how many of its shingles are not rare; without
    the nodes that cannot reach the threshold with any partner of their key by those alone. (Of
    several texts of one id the least size and the most common ones.)"""
    rare = compact(rare.groupBy("node", "text").agg(F.count("*").alias("rare")))[0]
    sizes = compact(sets.select("node", "text", "n"))[0]
    each = sizes.join(rare, ["node", "text"], "left").groupBy("node").agg(
        F.min("n").alias("n"), F.max(F.col("n") - F.coalesce("rare", F.lit(0))).alias("common"))
    with_sizes = rest.join(each, "node")
    least = with_sizes.groupBy("key").agg(F.min("n").alias("least"))
    return with_sizes.join(least, "key").where(_reaches(F.col("common"), F.col("n"), F.col("least"), threshold)).drop("least", "size")


def _reaches(common: Column, x: Column, y: Column, threshold: int) -> Column:
    """Whether sets of x and y elements with so many in common reach the threshold."""
    return (100 + threshold) * common >= threshold * (x + y)


def _with_pivot(keyed: DataFrame) -> DataFrame:
    """(key, band, node, component) with the key's least node and its component, for keys that
    hold several components."""
    pivots = keyed.groupBy("key").agg(F.min(F.struct("node", "component")).alias("pivot"), F.min("component").alias("c0"),
                                      F.max("component").alias("c1")).where("c0 < c1")
    return keyed.join(pivots.select("key", "pivot"), "key")


def _relabelled(keyed: DataFrame, comp: DataFrame) -> DataFrame:
    comp, n = compact(comp)
    return keyed.drop("component").join(_broadcast(comp, n), "node", "left").withColumn("component", F.coalesce("component", "node"))


def links(nodes: DataFrame, docs: DataFrame, k: int, threshold: int) -> DataFrame:
    """Confirmed links (a, b) that connect whatever the full set of links connects.

    ``nodes`` (node, sig, bands), ``docs`` (id, text) with the nodes' texts.
    """
    sigs = nodes.select("node", "sig")
    keyed = cut(_with_pivot(nodes.select("node", F.col("node").alias("component"), F.posexplode("bands").alias("band", "key"))))
    found, level = None, 0
    while True:
        stars = keyed.where("component <> pivot.component").select(
            F.col("node").alias("a"), F.col("pivot.node").alias("b")).distinct()
        new = confirmed(_likely(stars, sigs, threshold), docs, k, threshold)
        found = new if found is None else found.unionByName(new)
        comp = components(found)
        # pairs with the pivot are done; what is left are the others of keys with several components
        rest, n = _unresolved(_relabelled(keyed.where("node <> pivot.node").drop("pivot"), comp))
        if not n:
            return found
        sets = cut(_sets(rest, docs, k))
        rare = cut(_rare(sets))
        found = found.unionByName(confirmed(_likely(_sharing_rare(rare, rest, threshold), sigs, threshold), docs, k, threshold))
        rest, n = _unresolved(_able(rest, sets, rare, threshold))
        if not n:
            return found
        level += 1
        last = level * DIVIDING_BANDS >= BANDS  # keys of so many minima are as good as equal signatures
        pair = rest if last else rest.where(F.col("size") <= PAIRED_BUCKET)
        side = compact(sigs.join(_broadcast(pair, n), "node"), PAIRED_ROWS)[0]
        ends = [side.select("key", *[F.col(c).alias(c + x) for c in ("node", "component", "sig", "n", "common")]) for x in "ab"]
        across = ends[0].join(ends[1], "key").where(
            (F.col("nodea") < F.col("nodeb")) & (F.col("componenta") != F.col("componentb"))
            & _reaches(F.least("commona", "commonb"), F.col("na"), F.col("nb"), threshold)
            & (_agreement("siga", "sigb") >= _least_estimate(threshold)))
        across = across.select(F.col("nodea").alias("a"), F.col("nodeb").alias("b")).distinct()
        found = found.unionByName(confirmed(across, docs, k, threshold))
        big = rest.where(F.col("size") > PAIRED_BUCKET)
        if last or big.isEmpty():
            return found
        other = (F.col("band") + level * DIVIDING_BANDS - F.col("i")) % BANDS
        divided = _relabelled(big, components(found)).join(nodes.select("node", "bands"), "node").withColumn(
            "i", F.explode(F.sequence(F.lit(0), F.lit(DIVIDING_BANDS - 1)))).select(
            "node", "component", "band", F.xxhash64("key", other, F.col("bands")[other]).alias("key"))
        keyed = cut(_with_pivot(divided))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = SHINGLE_WORDS, threshold: int = THRESHOLD) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept.

    Two documents are linked if the Jaccard similarity of their sets of distinct word shingles is
    at least ``threshold`` / 100; fewer words than a shingle form one shingle. ``component_id`` is
    the least id reachable over links, ``kept`` marks the row that carries it. A null or blank text
    has no shingles and no links. A repeated id is one document: its rows share the component that
    links of any of them reach. A row with a null id is linked with nothing (component null, kept
    null). Other columns of ``docs`` are ignored.
    """
    small_batches(docs.sparkSession)
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    signed_rows = cut(d.mapInArrow(_sign(shingle_words),
                                   "id long, cls binary, n long, sig array<long>, bands array<long>"))
    with_id = signed_rows.where("id is not null and n > 0")
    classes = with_id.groupBy("cls").agg(F.min("id").alias("node"), F.min_by(F.struct("sig", "bands"), "id").alias("s"))
    classes = cut(classes.select("cls", "node", "s.sig", "s.bands"))
    found = links(classes.select("node", "sig", "bands"), d.where("id is not null"), shingle_words, threshold)
    # an id with several texts ties their classes together
    repeated, n = compact(with_id.groupBy("id").agg(F.min("cls").alias("c0"), F.max("cls").alias("c1")).where("c0 < c1").select("id"))
    if n:
        member = with_id.join(_broadcast(repeated, n), "id").join(classes.select("cls", "node"), "cls")
        found = found.unionByName(member.select(F.col("id").alias("a"), F.col("node").alias("b")).distinct())
    comp = components(found)
    labels = _relabelled(classes.select("cls", "node"), comp).select("cls", "component")
    out = signed_rows.select("id", "cls", "n").join(labels, "cls", "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                      F.when(F.col("id").isNotNull(), component).alias("component_id"),
                      (F.col("id") == component).alias("kept"))
