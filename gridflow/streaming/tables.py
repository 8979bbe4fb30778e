"""Keyed tables that micro-batches upsert into, and runners over bounded input.

A keyed table holds the current row of each key as folders of changed rows, one per micro-batch,
and every ``COMPACT_EVERY`` batches a base with the current row of every key. Reading it is one
grouped ``max_by`` over the base and the changes behind it (partially aggregated, so a key that
changes in every batch is no hot key). Nothing depends on listing: which base belongs to a batch
follows from its number.

A micro-batch step reads tables as they were before its batch and overwrites its own folders, so
a batch that is run again -- because a step failed behind a write, or the driver was lost before
the commit -- reads the same state and leaves the same rows: output and state are exactly-once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from gridflow.streaming.sinks import finish, stream_location

COMPACT_EVERY = 16
GONE = "gone"
# input rows of one micro-batch when a table is landed in parts; there are at least LEAST_PARTS
PART_ROWS = 25_000_000
LEAST_PARTS = 3


class KeyedTable:
    """Current rows by ``keys`` under ``path``; ``schema`` (DDL) names all columns. Null keys are keys.

    A changed row replaces the key's row; a row with ``gone`` true removes the key."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], schema: str, compact_every: int = COMPACT_EVERY):
        self.spark, self.path, self.keys, self.every = spark, path, list(keys), compact_every
        self.schema = spark.createDataFrame([], schema).schema
        self.stored = StructType([*self.schema.fields, StructField(GONE, BooleanType())])
        self.changed = StructType([*self.stored.fields, StructField("batch_id", LongType())])

    def _changes(self, first: int, below: int) -> DataFrame | None:
        if first >= below:
            return None
        folders = [f"{self.path}/changes/batch_id={i}" for i in range(first, below)]
        return self.spark.read.schema(self.changed).option("basePath", f"{self.path}/changes").parquet(*folders)

    def _latest(self, base: DataFrame | None, changes: DataFrame | None) -> DataFrame:
        rows = None if base is None else base.withColumn("batch_id", F.lit(-1).cast("long"))
        if changes is not None:
            rows = changes if rows is None else rows.unionByName(changes)
        if rows is None:
            return self.spark.createDataFrame([], self.schema)
        values = [c for c in self.stored.names if c not in self.keys]
        last = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*values), "batch_id").alias("_last"))
        return last.where(~F.coalesce(F.col(f"_last.{GONE}"), F.lit(False))).select(
            *[F.col(c) if c in self.keys else F.col(f"_last.{c}").alias(c) for c in self.schema.names])

    def _base(self, below: int) -> DataFrame:
        return self.spark.read.schema(self.stored).parquet(f"{self.path}/base/below={below}")

    def before(self, batch_id: int) -> DataFrame:
        """The table as it was before the batch."""
        begin = batch_id - batch_id % self.every
        if begin == batch_id and begin:  # the first reader at such a batch writes its base
            old = begin - self.every
            rows = self._latest(self._base(old) if old else None, self._changes(old, begin))
            rows.withColumn(GONE, F.lit(False)).write.mode("overwrite").parquet(f"{self.path}/base/below={begin}")
        return self._latest(self._base(begin) if begin else None, self._changes(begin, batch_id))

    def write(self, batch_id: int, changed: DataFrame) -> None:
        """The batch's changed rows, one per key; each batch writes once, if only no rows."""
        if GONE not in changed.columns:
            changed = changed.withColumn(GONE, F.lit(False))
        changed.select(*[F.col(c.name).cast(c.dataType) for c in self.stored.fields]).write.mode("overwrite").parquet(
            f"{self.path}/changes/batch_id={batch_id}")

    def current(self) -> DataFrame:
        """The table behind all batches written so far."""
        try:
            last = self.spark.read.schema(self.changed).parquet(f"{self.path}/changes").agg(F.max("batch_id")).first()[0]
        except Exception as ex:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(ex):
                raise
            return self.spark.createDataFrame([], self.schema)
        if last is None:  # batches without any row have no partition value to read
            return self.spark.createDataFrame([], self.schema)
        begin = last + 1 - (last + 1) % self.every
        while begin > last:  # the base that the next batch would write
            begin -= self.every
        begin = max(begin, 0)
        return self._latest(self._base(begin) if begin else None, self._changes(begin, last + 1))


def append(rows: DataFrame, path: str, batch_id: int) -> None:
    """The rows that a batch emits; a batch that runs again replaces its own."""
    rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def run_steps(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str, name: str = "",
              timeout_s: float | None = None) -> None:
    """Run ``step(rows, batch_id)`` over the micro-batches of everything available now."""
    w = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    finish((w.queryName(name) if name else w).start(), timeout_s)


def parts_of(rows: DataFrame, order: str) -> tuple[int, int]:
    """(number of parts, span): row with order value x (from 0) belongs to part x * parts // span."""
    span = (rows.agg(F.max(order)).first()[0] or 0) + 1
    return max(LEAST_PARTS, -(-span // PART_ROWS)), span


# the same number of parts in SQL, of positions up to ``last``
PARTS_SQL = f"greatest({LEAST_PARTS}, (last + {PART_ROWS}) // {PART_ROWS})"


def in_parts(rows: DataFrame, order: str, name: str, run: Callable[[DataFrame, str], None], each: int | None = None,
             end: DataFrame | None = None) -> str:
    """Land ``rows`` as files part by part in order, and after each part run a stream over what is new.

    ``run(stream, base)`` starts its query on a checkpoint under ``base`` and waits for it. A part is written
    by as many tasks as hold its rows; ``each``: files a micro-batch takes at most (their order within a part
    is not the rows'); ``end``: rows landed as a part of their own behind the others. Returns the base folder, which is shared and fresh."""
    spark = rows.sparkSession
    base = stream_location(spark, name)[0].rsplit("/", 1)[0]
    parts, span = parts_of(rows, order)
    source = spark.readStream.schema(rows.schema).option("recursiveFileLookup", "true")
    if each:
        source = source.option("maxFilesPerTrigger", each)
    for k in range(parts):
        # the bounds of a part reach the scan as a filter
        low, high = -(-k * span // parts), -(-(k + 1) * span // parts)
        rows.where((F.col(order) >= low) & (F.col(order) < high)).write.parquet(f"{base}/in/part-{k}")
        run(source.parquet(f"{base}/in"), base)
    if end is not None:
        end.write.parquet(f"{base}/in/part-{parts}")
        run(source.parquet(f"{base}/in"), base)
    return base
