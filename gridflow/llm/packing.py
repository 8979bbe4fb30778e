"""Packing of tokenized documents into fixed-length training sequences, online by sum of squares.

Each partition packs its own documents as they stream by. A document's whole windows go out as
sequences of their own; the rest is placed into that fill level (or an empty window) which
minimises the sum of the squared counts of partially filled windows by level, kept in a level
array, ties to the fullest. A window goes out once it is full. The windows still open at the end
of a partition are merged by cutting the pieces of the emptiest into the gaps of the fullest, so
a partition pads one sequence at most. The same merge takes place whenever the open windows hold more
than ``MOST_OPEN`` ids, which bounds the memory of a task whatever its documents; there is no shuffle.

Sequence ids hold the partition's number, so they are unique, and a task that is run again numbers
alike. Ids of texts come from the ``tokenizers`` library; texts of Latin letters without a special
token's string take the same vocabulary through ``tiktoken``, which gives the same ids faster.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridflow.llm.common import list_array, small_batches

WINDOW = 1024
MOST_OPEN = 8_000_000   # ids in open windows, four bytes each
END_ID = 0
VOCABULARY = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
PARTITION_SHIFT = 40
# UTF-8 bytes from here on start characters beyond U+027F
_BEYOND_LATIN = 0xCA
_ENCODERS: dict[tuple[str, str], Callable[[bytes], np.ndarray]] = {}


def encoder(vocabulary: str = VOCABULARY, ranks: str = RANKS) -> Callable[[bytes], np.ndarray]:
    """UTF-8 text -> ids. A bare name means a file of the installed public tokenizers."""
    if (vocabulary, ranks) in _ENCODERS:
        return _ENCODERS[vocabulary, ranks]
    import base64

    import public_tokenizers
    import tiktoken
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    path = lambda x: x if os.sep in x else public_tokenizers.path(x)
    exact = Tokenizer.from_file(path(vocabulary))
    special = [x.content.encode() for x in exact.get_added_tokens_decoder().values()]
    with open(path(ranks), "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    def encode(data: bytes) -> np.ndarray:
        text = data.decode()
        plain = data.isascii() or np.frombuffer(data, np.uint8).max() < _BEYOND_LATIN
        if plain and not any(s in data for s in special):
            return np.array(fast.encode_ordinary(text), dtype=np.uint32)
        return np.array(exact.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    _ENCODERS[vocabulary, ranks] = encode
    return encode


class Packer:
    """Places pieces (key, start, ids) into windows of ``size`` ids, of which the open ones hold ``most`` at most."""

    def __init__(self, size: int = WINDOW, most: int = MOST_OPEN):
        self.size, self.most, self.held = size, most, 0
        self.counts = np.zeros(size + 1, dtype=np.int64)  # open windows by fill level
        self.open: list[list[list]] = [[] for _ in range(size)]

    def level(self, n: int) -> int:
        """The fill level, 0 for an empty window, that takes ``n`` < size ids at the least sum of squares."""
        c = self.counts
        cost = 2 * (c[n:] - c[:self.size - n + 1]) + 2   # a window moves from level h to h + n
        cost[c[:self.size - n + 1] == 0] = np.iinfo(np.int64).max
        cost[0] = 2 * c[n] + 1                           # a new one appears at n
        if c[self.size - n]:
            cost[-1] -= 1                                # a full one disappears
        return int(len(cost) - 1 - cost[::-1].argmin())

    def add(self, key, ids: np.ndarray) -> Iterator[list]:
        """Yields the windows that this document fills; each is a list of pieces."""
        whole = len(ids) // self.size * self.size
        for at in range(0, whole, self.size):
            yield [(key, at, ids[at:at + self.size])]
        n = len(ids) - whole
        if not n:
            return
        h = self.level(n)
        window = self.open[h].pop() if h else []
        self.counts[h] -= h > 0
        window.append((key, whole, ids[whole:].copy() if whole else ids))
        self.held += n
        if h + n == self.size:
            self.held -= self.size
            yield window
            return
        self.counts[h + n] += 1
        self.open[h + n].append(window)
        if self.held > self.most:
            yield from self.merge()

    def merge(self) -> Iterator[list]:
        """Sends out the open windows, merged by cutting, and keeps the one that is not full."""
        left = list(self.rest())
        last = left.pop() if sum(len(p[2]) for p in left[-1]) < self.size else []
        self.held = fill = sum(len(p[2]) for p in last)
        self.counts[:] = 0
        self.open = [[] for _ in range(self.size)]
        if fill:
            self.counts[fill] = 1
            # a copy: a cut piece is a view that would keep its whole document alive
            self.open[fill].append([(key, start, ids.copy()) for key, start, ids in last])
        yield from left

    def rest(self) -> Iterator[list]:
        """The remaining windows: the emptiest cut into the gaps of the fullest, all full but one."""
        left = [[size, w] for size, ws in enumerate(self.open) for w in ws]  # by fill
        at, end = 0, len(left) - 1
        while at < end:
            gap = self.size - left[end][0]
            key, start, ids = left[at][1].pop()
            if len(ids) > gap:
                left[at][1].append((key, start, ids[:-gap]))
                start, ids = start + len(ids) - gap, ids[-gap:]
            left[at][0] -= len(ids)
            left[end][0] += len(ids)
            left[end][1].append((key, start, ids))
            if left[end][0] == self.size:
                yield left[end][1]
                end -= 1
            if left[at][0] == 0:
                at += 1
        if at == end and left[at][0]:
            yield left[at][1]


def _pack(size: int, vocabulary: str, ranks: str, with_ids: bool):
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, ranks)
        packer, sequence = Packer(size), TaskContext.get().partitionId() << PARTITION_SHIFT
        rows: list[tuple] = []

        def out(windows) -> None:
            nonlocal sequence
            for w in windows:
                offset = 0
                for (id_, total), start, ids in w:
                    rows.append((id_, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, sequence, offset, ids))
                    offset += len(ids)
                sequence += 1

        def flush() -> pa.RecordBatch:
            cols = list(zip(*rows)) if rows else [()] * 8
            arrays = [pa.array(c, pa.int64()) for c in cols[:7]]
            if with_ids:
                flat = np.concatenate(cols[7]).astype(np.int32) if rows else np.empty(0, np.int32)
                arrays.append(list_array(flat, [len(x) for x in cols[7]]))
            rows.clear()
            return pa.RecordBatch.from_arrays(arrays, names)

        for b in batches:
            for id_, data in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
                ids = np.append(encode(data or b""), np.uint32(END_ID))
                out(packer.add((id_, len(ids)), ids))
            yield flush()
        out(packer.rest())
        yield flush()
    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW,
         vocabulary: str = VOCABULARY, ranks: str = RANKS, with_ids: bool = True) -> DataFrame:
    """One row per piece: id, start (ids of its document before it), length, ids_crc32 (of its ids as
    little-endian unsigned 32-bit), doc_tokens (with the end id), sequence_id, offset and, if asked
    for, ids.

    Every row of ``docs`` is a document of its own, also with a null or repeated id; a null or
    empty text is the end id alone. An empty table gives no rows. Other columns are ignored.
    """
    small_batches(docs.sparkSession)
    schema = "id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return d.mapInArrow(_pack(size, vocabulary, ranks, with_ids), schema + ", ids array<int>" * with_ids).withColumnRenamed("id", id_col)
