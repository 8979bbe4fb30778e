"""Helpers shared by the operators: word hashing on bytes, checkpoints, checked broadcasts.

Words are the runs matching ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased. On UTF-8
bytes that is exactly ``bytes.lower()`` (ASCII only) and a split at the six ASCII blanks, so the
hot loops work on bytes and never decode.
"""

from __future__ import annotations

import gc

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridflow.session import checkpoint_dir

U64 = np.uint64
# rows per Arrow batch sent to Python: some texts are very long, so batches stay small
ARROW_ROWS = 512
# bytes hashed at once; longer texts are hashed piece by piece, cut at blanks
CHUNK = 1 << 20
PARTITION_ROWS = 500_000  # of small (narrow) rows in a partition
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, 9, 10, 11, 12, 13]] = True
_POWERS: dict[int, np.ndarray] = {}


def small_batches(spark: SparkSession) -> None:
    """Bound the rows of an Arrow batch (memory of a Python worker) for this session."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and cut its lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle and checkpoint files that no live DataFrame needs: it does so when the
    driver collects its garbage, which a long job with several large shuffles had better not wait for."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    spark.sparkContext._jvm.System.gc()


def partitions_for(rows: int, each: int = PARTITION_ROWS) -> int:
    return max(1, -(-rows // each))


def compact(df: DataFrame, each: int = PARTITION_ROWS) -> tuple[DataFrame, int]:
    """``cut`` with the row count, in as few partitions as so many rows need: the jobs that follow on
    a small table then have few tasks and shuffle files."""
    df = cut(df)
    n = df.count()
    return df.coalesce(partitions_for(n, each)), n


def small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast ``df`` if it has at most ``rows`` rows (of fixed width); otherwise leave the join
    strategy to the planner, which shuffles both sides."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(1 << 14, 1 << (n - 1).bit_length())
        have = np.full(size, base, dtype=U64)
        have[0] = 1
        with np.errstate(over="ignore"):
            np.multiply.accumulate(have, out=have)
        _POWERS[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that all bits depend on all input bits."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def blanks(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each byte whether it is a blank; start and end byte of every word."""
    blank = _BLANK[a]
    edge = np.diff(blank.view(np.int8), prepend=1, append=1)
    return blank, np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def _hash_piece(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    a = np.frombuffer(data, dtype=np.uint8)
    _, start, end = blanks(a)
    total = np.empty(len(a) + 1, dtype=U64)
    total[0] = 0
    np.cumsum((a.astype(U64) + U64(1)) * _powers(_BASE, len(a)), out=total[1:])
    return mix((total[end] - total[start]) * _powers(_INVERSE, len(a))[start]), start, end


def words64(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hash, start and end byte of every word of ``data`` (already lower-cased)."""
    if not data:
        none = np.empty(0, dtype=np.int64)
        return np.empty(0, dtype=U64), none, none
    if len(data) <= CHUNK:
        return _hash_piece(data)
    parts, at = [], 0
    while at < len(data):
        to = min(len(data), at + CHUNK)
        while to < len(data) and not _BLANK[data[to]]:
            to += 1
        h, s, e = _hash_piece(data[at:to])
        parts.append((h, s + at, e + at))
        at = to
    return tuple(np.concatenate(x) for x in zip(*parts))  # type: ignore[return-value]


def lowered(texts: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text with A-Z lower-cased; a null text counts as empty."""
    return [b"" if x is None else x.lower() for x in texts.cast(pa.binary()).to_pylist()]


def grams64(w: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all ``k`` consecutive words; of all words as one if there are fewer."""
    if len(w) == 0:
        return w
    k = min(k, len(w))
    n = len(w) - k + 1
    h = w[:n].copy()
    for i in range(1, k):
        h = h * U64(_BASE) + w[i:i + n]
    return mix(h + U64(k))


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def list_array(values: np.ndarray, counts: list[int] | np.ndarray) -> pa.ListArray:
    """Arrow list column from concatenated values and each row's count."""
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
