"""Stream and log sources.

Files stand in for the message broker here: a folder (or glob) of parquet /
JSON-lines files is read with ``readStream`` and ``maxFilesPerTrigger``. The
broker connector is used when its package is on the classpath.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridflow.operators.parse import parse_measurement, typed_projection
from gridflow.plans.joins import checked_broadcast
from gridflow.session import checkpoint_dir
from gridflow.sources.tables import table_path

LOG_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType()), T.StructField("off", T.LongType()),
    T.StructField("key", T.StringType()), T.StructField("value", T.StringType()),
])


TAB = "\t"  # between a node's id and its line in files that many nodes share


def _glob(path: str) -> str:
    """A streaming file source needs a folder or a glob; a single file becomes a glob."""
    if os.path.isdir(path):
        return path
    d, b = os.path.split(path)
    return os.path.join(d, f"[{b[0]}]{b[1:]}") if b else path


def table_stream(spark: SparkSession, sf_dir: str, name: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A driver table as a file stream (schema taken from the table)."""
    path = table_path(sf_dir, name)
    schema = spark.read.parquet(path).schema
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(_glob(path))


def log_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = 1) -> DataFrame:
    """Keyed log records (topic, off, key, value) landed as JSON-lines files."""
    r = spark.readStream.schema(LOG_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.json(_glob(path))


def broker_stream(spark: SparkSession, servers: str, topic: str, starting: str = "earliest") -> DataFrame:
    """Subscribe to a broker topic from ``starting`` offsets (needs the connector package).

    Output columns follow the connector: key, value (binary), topic, partition,
    offset, timestamp; ``offset`` is exposed as ``off``.
    """
    try:
        df = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
                   .option("subscribe", topic).option("startingOffsets", starting).load())
    except Exception as ex:  # noqa: BLE001
        raise RuntimeError("the broker connector is not on the classpath; land the topic as files "
                           "and use log_stream() instead") from ex
    return df.withColumn("off", F.col("offset")).withColumn("value", F.col("value").cast("string"))


def measurement_stream(records: DataFrame, exact: bool = False) -> DataFrame:
    """Readings from keyed log records: parse the JSON, keep well-formed typed rows."""
    return typed_projection(parse_measurement(records), exact)


def replay_log(spark: SparkSession, path: str, ends: DataFrame | None = None) -> DataFrame:
    """Bounded replay of a landed log, a batch read (order by ``off`` where order matters): every
    record, or, given ``ends`` (topic, end), those of these topics up to the recorded offsets."""
    log = spark.read.schema(LOG_SCHEMA).option("recursiveFileLookup", "true").json(path)
    if ends is None:
        return log
    return log.join(ends, "topic").where(F.col("off") <= F.col("end")).select(*LOG_SCHEMA.names)


def _lines(reader, root: str, shared: bool) -> DataFrame:
    path, value = F.col("_metadata.file_path"), F.col("value")
    node, line = F.element_at(F.split(path, "/"), -2), value
    if shared:
        tab = F.instr(value, TAB)
        node, line = F.when(tab > 0, F.substring_index(value, TAB, 1)), F.substr(value, tab + 1)
    return reader.text(f"{root}/*/*").select(node.alias("node_id"), line.alias("line"),
                                             path.alias("file"), F.col("_metadata.file_modification_time").alias("time"),
                                             F.col("_metadata.file_block_start").alias("block"))


def numbered_lines(lines: DataFrame, before: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Lines (node_id, line, file, time, block) of a batch of files -> (node_id, line, off), and the lines per node
    (node_id, lines) behind them. ``off`` is the line's place among its node's: behind the ``lines`` of ``before``, by
    time and name of the file, block of the file, and line within the block. A node's files land one after
    the other and do not grow.

    Several nodes may share a file. Lines are counted within a node's part of the block of a file that a task reads; only one
    row per node and block is ordered per node, so a node with a third of all lines is no hot key."""
    checkpoint_dir(lines.sparkSession)
    place = Window.partitionBy("node_id", "file", "block").orderBy("_row")
    # read once: what a task reads is in the order of the file
    at = lines.withColumn("_row", F.monotonically_increasing_id()).withColumn("_line", F.row_number().over(place)).drop("_row").checkpoint()
    blocks = at.groupBy("node_id", "time", "file", "block").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("node_id").orderBy("time", "file", "block")
    start = F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = blocks.select("node_id", "file", "block", "n", start.alias("start"))
    totals = blocks.groupBy("node_id").agg(F.sum("n").alias("lines"))
    if before is not None:
        had = before.select(F.col("node_id").alias("_n"), F.col("lines").alias("_had"))
        known = F.col("node_id").eqNullSafe(F.col("_n"))
        blocks = blocks.join(had, known, "left").withColumn("start", F.col("start") + F.coalesce("_had", F.lit(0))).drop("_n", "_had")
        totals = totals.join(had, known, "left").select("node_id", (F.col("lines") + F.coalesce("_had", F.lit(0))).alias("lines"))
    start = checked_broadcast(blocks.select(F.col("node_id").alias("_n"), F.col("file").alias("_f"), F.col("block").alias("_b"), "start"))
    out = at.join(start, F.col("node_id").eqNullSafe(F.col("_n")) & (F.col("file") == F.col("_f")) & (F.col("block") == F.col("_b")))
    return out.select("node_id", "line", (F.col("start") + F.col("_line")).cast("long").alias("off")), totals


def serial_line_source(spark: SparkSession, root: str, shared: bool = False) -> DataFrame:
    """Device console logs landed one folder per node (``root/<node_id>/*``): one row per line, the
    node id from the folder name, ``off`` its place among its node's lines (see ``numbered_lines``).

    ``shared``: many nodes share a file of ``root/<any>/*``, each line led by its node's id and a tab; the number of
    files then does not follow the number of nodes."""
    return numbered_lines(_lines(spark.read, root, shared))[0]


def serial_line_stream(spark: SparkSession, root: str, max_files_per_trigger: int | None = None, shared: bool = False) -> DataFrame:
    """The same logs as a stream of new files; ``continuous.serial_lines`` numbers its lines."""
    r = spark.readStream
    return _lines(r.option("maxFilesPerTrigger", max_files_per_trigger) if max_files_per_trigger else r, root, shared)


def node_list(spark: SparkSession, path: str) -> DataFrame:
    """Device list with one JSON object (pos, nodeId, ipv6) a line, for lists beyond one document."""
    return spark.read.schema("pos int, nodeId string, ipv6 string").json(path).select("pos", F.col("nodeId").alias("node_id"), "ipv6")


def node_dimension(spark: SparkSession, path: str, keep: list[str] | None = None) -> DataFrame:
    """Device list from a JSON config ``{"nodes": [{"nodeId", "ipv6", ...}]}`` ->
    (pos, node_id, ipv6); ``pos`` keeps file order for first-match lookups. ``keep``: partition columns of a
    folder of such documents, kept in front."""
    keep = keep or []
    cfg = spark.read.option("multiLine", True).json(path)
    e = cfg.select(*keep, F.posexplode("nodes").alias("pos", "n"))
    return e.select(*keep, F.col("pos").cast("int").alias("pos"), F.col("n.nodeId").cast("string").alias("node_id"),
                    F.col("n.ipv6").alias("ipv6"))
