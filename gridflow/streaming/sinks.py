"""Sinks: keyed logs, per-batch update tables, and stream runners.

Outputs and checkpoints live under the session's shared checkpoint folder
(``spark.checkpoint.dir``), never on a machine-local path, so a restarted
driver or a lost executor resumes from committed offsets and state.
"""

from __future__ import annotations

import os
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridflow.session import checkpoint_dir


def write_keyed_log(log: DataFrame, path: str, batch: str | int = 0) -> None:
    """Write keyed records (topic, off, key, value) as JSON lines to the log folder's part for
    ``batch`` (the file stand-in for publishing to a topic with all-replica acknowledgement). A
    batch that is written again, as a retry does, replaces its own records only."""
    log.select("topic", "off", "key", "value").write.mode("overwrite").json(f"{path}/batch_id={batch}")


def stream_location(spark: SparkSession, name: str) -> tuple[str, str]:
    """Fresh (output, checkpoint) folders for a named query in the shared folder."""
    base = checkpoint_dir(spark, os.path.join("streams", f"{name}-{uuid.uuid4().hex[:12]}"))
    return os.path.join(base, "out"), os.path.join(base, "checkpoint")


def update_sink(df: DataFrame, name: str, out: str, checkpoint: str, output_mode: str = "update",
                trigger: dict | None = None):
    """Start a query whose emitted rows of every micro-batch land in
    ``out/batch_id=<id>`` (update mode: ``latest_per_key`` reads the current
    state back). Each batch overwrites its own folder, so a batch replayed after
    a failure does not duplicate rows; offsets and state commit with the
    checkpoint, which together give exactly-once output."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(os.path.join(out, f"batch_id={batch_id}"))

    w = df.writeStream.outputMode(output_mode).foreachBatch(write).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


def latest_per_key(spark: SparkSession, out: str, keys: list[str]) -> DataFrame:
    """Last emitted row per key from an update-mode output table."""
    return latest_of(spark.read.parquet(out), keys)


def latest_of(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with a ``batch_id`` -> the last one per key."""
    values = [c for c in df.columns if c not in keys and c != "batch_id"]
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("_last"))
    return last.select(*[F.col(c) if c in keys else F.col(f"_last.{c}").alias(c) for c in df.columns if c != "batch_id"])


def stream_session(spark: SparkSession, **settings: str) -> SparkSession:
    """A session of its own for a bounded stream run, so that the caller's settings stay as they are.

    It takes over the caller's time zone, checkpoint folder and batch settings; state partitions,
    which a checkpoint fixes at its first start, are the cluster's parallelism. Under Spark Connect
    the caller's session is returned.
    """
    try:
        s, cores = spark.newSession(), spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001  (Spark Connect has neither)
        return spark
    for key in ("spark.sql.session.timeZone", "spark.checkpoint.dir", "spark.sql.ansi.enabled"):
        value = spark.conf.get(key, None)
        if value is not None and value != s.conf.get(key, None):
            s.conf.set(key, value)
    s.conf.set("spark.sql.shuffle.partitions", str(max(1, cores)))
    for key, value in settings.items():
        s.conf.set(key.replace("__", "."), value)
    return s


def finish(query, timeout_s: float | None = None) -> None:
    """Wait for a query over bounded input. A failure is raised; if a time limit is given and not
    met, the query is stopped and ``TimeoutError`` raised: a partial result is never returned."""
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError(f"stream {query.name or query.id} was stopped after {timeout_s} s, before its input was read")
    if query.exception():
        raise query.exception()


def run_to_path(spark: SparkSession, df: DataFrame, name: str, output_mode: str = "append",
                timeout_s: float | None = None) -> str:
    """Run a stream over everything available now; return its output folder."""
    out, ck = stream_location(spark, name)
    finish(update_sink(df, name, out, ck, output_mode=output_mode), timeout_s)
    return out


def read_output(spark: SparkSession, out: str, schema: StructType) -> DataFrame:
    """The rows of all batches with their ``batch_id``; none if no batch ran. Any other failure to
    read is raised."""
    try:
        return spark.read.parquet(out)
    except AnalysisException as ex:
        if ex.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema).withColumn("batch_id", F.lit(0))


def run_to_table(spark: SparkSession, df: DataFrame, name: str, output_mode: str = "append",
                 keys: list[str] | None = None, timeout_s: float | None = None) -> DataFrame:
    """Run a stream over everything available now and read its result back.

    Append mode: all emitted rows. Update mode: the latest row per ``keys``.
    """
    out = run_to_path(spark, df, name, output_mode, timeout_s)
    rows = read_output(spark, out, df.schema)
    return latest_of(rows, keys) if output_mode == "update" and keys else rows.drop("batch_id")


def concurrent_queries(spark: SparkSession, queries: dict[str, tuple[DataFrame, str, list[str] | None]],
                       timeout_s: float | None = None, wait: str = "all") -> dict[str, str]:
    """Start several queries over one parsed stream (each reads the source
    independently, as separate queries do). ``wait="all"`` waits for every query
    (bounded inputs); ``wait="any"`` returns when the first one ends, as a
    long-running service does with ``awaitAnyTermination``."""
    started = {}
    for name, (df, mode, _keys) in queries.items():
        out, ck = stream_location(spark, name)
        started[name] = (update_sink(df, name, out, ck, output_mode=mode), out)
    try:
        if wait == "any":
            ended = spark.streams.awaitAnyTermination(*([] if timeout_s is None else [timeout_s]))
            if ended is False:
                raise TimeoutError(f"no stream ended within {timeout_s} s")
        else:
            for q, _out in started.values():
                finish(q, timeout_s)
    except Exception:
        for q, _out in started.values():
            q.stop()
        raise
    return {name: out for name, (_q, out) in started.items()}
