"""Vector code compression: product quantisation in exact integers.

A component x becomes the integer floor(1024 * x); a vector is cut into equal consecutive parts and
each part is replaced by the number of the nearest entry of its part's codebook. Codebooks start
from the vectors with the least ids and are refined by a fixed number of rounds: assign every part
to its nearest entry, replace each used entry by the componentwise floor of the mean.

All arithmetic is exact, so neither the order of rows nor their partitioning changes a result. Dot
products come from float64 matrix products of limbs: integers are broken into limbs so narrow that
every sum of limb products stays below 2^53, and the products are recombined in int64 (as Python
integers where the bound says that int64 could overflow). Sums of members are split in two limbs too.

A round is one map over the table against broadcast codebooks; tasks emit sums per entry, which
Spark adds up. The driver receives the codebooks only (entries x components numbers).

Defined cases: vectors that are null or hold null or non-finite components are dropped, and so are
those of another length than most (ties: the longer), which cannot be cut alike. Parts of a
length that 4 does not divide differ by one. A null id sorts last among the seeds; rows that repeat
an id are rows of their own (ties by the vector). With fewer rows than entries the codebooks are as
short. Integers saturate at +-2^62 and errors at 2^63 - 1. Null labels form one group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridflow.llm.common import cut, small_batches

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
LIMIT = 1 << 62
LONG_MAX = (1 << 63) - 1
LABEL_BYTES = 64 << 20  # labels broadcast at once, at most
LABEL_ROWS = 1 << 20


def integers(x: np.ndarray) -> np.ndarray:
    """floor(SCALE * x), saturated."""
    return np.clip(np.floor(x.astype(np.float64) * SCALE), -LIMIT, LIMIT).astype(np.int64)


def _largest(x: np.ndarray) -> int:
    return int(np.abs(x).max(initial=0))


def limb_bits(d: int) -> int:
    """Width at which ``d`` products of two limbs sum to less than 2^53."""
    return (53 - max(1, d).bit_length()) // 2


def limbs(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """float64 arrays with x = sum of limb[i] * 2^(bits * i); only the last limb has a sign."""
    out = []
    while _largest(x) >= 1 << bits:
        out.append((x & ((1 << bits) - 1)).astype(np.float64))
        x = x >> bits
    return [*out, x.astype(np.float64)]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact dot products of the int64 rows of ``a`` with those of ``b``: int64, or Python integers
    if the largest components allow a sum of 2^62 and more."""
    bits = limb_bits(a.shape[1])
    wide = a.shape[1] * _largest(a) * _largest(b) >= LIMIT
    total = np.zeros((len(a), len(b)), dtype=object if wide else np.int64)
    right = limbs(b, bits)
    for i, x in enumerate(limbs(a, bits)):
        for j, y in enumerate(right):
            part = (x @ y.T).astype(np.int64)  # exact: below 2^53
            # int64 wraps around in between, but the sum is below 2^62
            total += part.astype(object) * (1 << bits * (i + j)) if wide else part << (bits * (i + j))
    return total


def _squares(x: np.ndarray, wide: bool) -> np.ndarray:
    y = x.astype(object) if wide else x
    return (y * y).sum(axis=1) if x.shape[1] else np.zeros(len(x), dtype=y.dtype)


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest entry (ties: the lowest) of every row, and the squared distance."""
    wide = 4 * x.shape[1] * max(_largest(x), _largest(entries)) ** 2 >= LIMIT
    dots = products(x, entries)
    if wide:
        dots = dots.astype(object)
    score = _squares(entries, wide)[None, :] - 2 * dots
    best = np.argmin(score, axis=1)
    return best, score[np.arange(len(x)), best] + _squares(x, wide)


@dataclass
class Codebooks:
    """One array of entries per part, each in int64; ``bounds`` are the parts' first components."""

    bounds: list[int]
    entries: list[np.ndarray]

    @property
    def width(self) -> int:
        return self.bounds[-1]

    def part(self, x: np.ndarray, p: int) -> np.ndarray:
        return x[:, self.bounds[p]:self.bounds[p + 1]]

    def codes(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry numbers (rows x parts) and the error of each row."""
        found = [nearest(self.part(x, p), e) for p, e in enumerate(self.entries)]
        if all(e.dtype != object and _largest(e) < LIMIT // len(found) for _, e in found):
            error = np.sum([e for _, e in found], axis=0)
        else:
            error = np.array([min(LONG_MAX, sum(map(int, es))) for es in zip(*(e for _, e in found))], dtype=np.int64)
        return np.stack([c for c, _ in found], axis=1), error

    def decoded(self, codes: np.ndarray) -> np.ndarray:
        """The vectors that codes stand for: the entries' components divided by SCALE."""
        return np.hstack([e[codes[:, p]] for p, e in enumerate(self.entries)]) / SCALE

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(int(v)) for e in self.entries for v in e.ravel()).encode()).hexdigest()


def kept(vectors: DataFrame, vector_col: str = "embedding") -> DataFrame:
    """Rows whose vector is there and finite in all components, of the most common length."""
    v = F.col(vector_col)
    fine = vectors.where(v.isNotNull() & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))))
    sizes = fine.groupBy(F.size(v).alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    return fine.where(F.size(v) == (sizes["size"] if sizes else 0))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return integers(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width))


def _member_sums(shared) -> object:
    """Sums of each entry's members over a task: part, entry, position, count and two limbs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books: Codebooks = shared.value
        n = [np.zeros(len(e), dtype=np.int64) for e in books.entries]
        high, low = ([np.zeros(e.shape, dtype=np.int64) for e in books.entries] for _ in range(2))
        for b in batches:
            x = _matrix(b.column(0), books.width)
            if not len(x):
                continue
            for p, e in enumerate(books.entries):
                y = books.part(x, p)
                code = nearest(y, e)[0]
                order = np.argsort(code, kind="stable")
                used, first, count = np.unique(code[order], return_index=True, return_counts=True)
                n[p][used] += count
                if y.shape[1]:
                    high[p][used] += np.add.reduceat(y[order] >> 31, first, axis=0)
                    low[p][used] += np.add.reduceat(y[order] & 0x7FFFFFFF, first, axis=0)
        for p, e in enumerate(books.entries):
            entry, pos = (g.ravel() for g in np.indices(e.shape))
            members = n[p][entry]
            some = members > 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(some.sum(), p, dtype=np.int32)), pa.array(entry[some].astype(np.int32)), pa.array(pos[some].astype(np.int32)),
                 pa.array(members[some]), pa.array(high[p].ravel()[some]), pa.array(low[p].ravel()[some])],
                ["part", "entry", "pos", "n", "high", "low"])

    return run


def train(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", parts: int = PARTS,
          entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks of ``vectors`` (rows as ``kept`` returns them)."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    seeds = rows.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
    width = len(seeds[0].v) if seeds else 0
    x = integers(np.array([r.v for r in seeds], dtype=np.float64).reshape(len(seeds), width))
    bounds = [width * p // parts for p in range(parts + 1)]
    books = Codebooks(bounds, [x[:, a:b].copy() for a, b in zip(bounds, bounds[1:])])
    if not seeds:
        return books
    context = rows.sparkSession.sparkContext
    small_batches(rows.sparkSession)
    for _ in range(rounds):
        shared = context.broadcast(books)
        sums = rows.select("v").mapInArrow(_member_sums(shared), "part int, entry int, pos int, n long, high long, low long")
        total = sums.groupBy("part", "entry", "pos").agg(
            *[F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("n", "high", "low")])
        books = Codebooks(bounds, [e.copy() for e in books.entries])
        for r in total.collect():  # at most one row per component of an entry
            books.entries[r.part][r.entry, r.pos] = ((int(r.high) << 31) + int(r.low)) // int(r.n)
    return books


def encoded(vectors: DataFrame, books: Codebooks, vector_col: str = "embedding", out: str = "vector_code") -> DataFrame:
    """Adds ``out``: struct(code, error) with two hex digits per part. Rows must be as ``kept`` returns
    them; all other columns stay."""
    small_batches(vectors.sparkSession)
    shared = vectors.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        b: Codebooks = shared.value
        digits = 2 * len(b.entries)
        for column in batches:
            if not len(column):
                yield pa.array([], pa.struct([("code", pa.string()), ("error", pa.int64())]))
                continue
            codes, error = b.codes(_matrix(column, b.width))
            text = codes.astype(np.uint8).tobytes().hex()
            yield pa.StructArray.from_arrays(
                [pa.array([text[i:i + digits] for i in range(0, len(text), digits)]), pa.array(error.astype(np.int64))], ["code", "error"])

    return vectors.withColumn(out, F.arrow_udf(run, "struct<code:string,error:bigint>")(F.col(vector_col)))


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per kept row: id, code, error, label_error (errors summed over equal labels),
    codebooks_sha256. Errors of a label are added up before they go back to its rows, so a label
    with a third of all rows is never one task's group."""
    rows = kept(vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"), F.col(label_col).alias("label")), "v")
    books = train(rows, "id", "v")
    codes = cut(encoded(rows, books, "v", "c").select("id", "label", "c.code", "c.error"))
    totals = codes.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("total")).select(
        F.col("label").alias("of"), F.least("total", F.lit(LONG_MAX).cast("decimal(38,0)")).cast("long").alias("label_error"))
    bound = totals.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(F.col("of").cast("string"))), F.lit(0))).first()
    if bound[0] <= LABEL_ROWS and bound[1] <= LABEL_BYTES:
        totals = F.broadcast(totals)
    return codes.join(totals, F.col("label").eqNullSafe(F.col("of"))).select(
        F.col("id").alias(id_col), "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def oracle_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The same result as SQL over ``embeddings``; ids must be unique and components within 2^24."""
    sql = f"""WITH kept AS (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) - 1 AS r, len(embedding) AS width,
         [CAST(floor(CAST(x AS DOUBLE) * {SCALE}) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
part AS (
  SELECT vec_id, label, r, p, v[width * p // {parts} + 1 : width * (p + 1) // {parts}] AS x
  FROM kept, (SELECT unnest(range({parts})) AS p)),
c0 AS (SELECT p, r AS k, x AS c FROM part WHERE r < {entries})"""
    for i in range(rounds + 1):
        sql += f""",
a{i} AS (
  SELECT part.vec_id, part.label, part.p, any_value(part.x) AS x,
         min(list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(part.x, c{i}.c)]) * {entries} + c{i}.k) AS best
  FROM part JOIN c{i} ON part.p = c{i}.p GROUP BY part.vec_id, part.label, part.p)"""
        if i < rounds:
            sql += f""",
s{i} AS (
  SELECT p, k, i, sum(x[i]) AS s, count(*) AS n
  FROM (SELECT p, best % {entries} AS k, x, unnest(range(1, len(x) + 1)) AS i FROM a{i}) GROUP BY p, k, i),
n{i} AS (SELECT p, k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM s{i} GROUP BY p, k),
c{i + 1} AS (SELECT c{i}.p, c{i}.k, coalesce(n{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN n{i} ON c{i}.p = n{i}.p AND c{i}.k = n{i}.k)"""
    return sql + f""",
coded AS (
  SELECT vec_id, label, string_agg(lower(printf('%02x', CAST(best % {entries} AS INTEGER))), '' ORDER BY p) AS code,
         CAST(sum(best // {entries}) AS BIGINT) AS error
  FROM a{rounds} GROUP BY vec_id, label),
digest AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, k)) AS codebooks_sha256 FROM c{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded, digest"""
