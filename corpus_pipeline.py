"""From raw documents to packed training sequences.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and read again as the next one's ``docs``. All stages but the
last return the columns of ``documents``. Rows with a null ``doc_id`` cannot be told apart: they
pass line and near-duplicate removal as they are and are judged by their text elsewhere.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridflow.llm import decontam, linededup, minhash, packing, toxicity
from gridflow.llm.common import cut
from gridflow.session import checkpoint_dir
from gridflow.sources.tables import read_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those that the ordinal model, trained on ``labels``, finds toxic."""
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels", ["doc_id", "toxic"]))
    return toxicity.scored(docs, model, out="__toxicity").where(~F.col("__toxicity.toxic")).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines, be they of one word (``text`` and ``n_chars`` follow). One that keeps
    less than a fifth of its words goes: a near copy of what stands in earlier documents would live
    on as a scrap that no later stage could know for one."""
    left = linededup.without_lines(docs, linededup.removed_lines(docs, exact_words=linededup.EXACT_WORDS))
    changed = F.col("__lines.n_removed") > 0
    text = F.col("__lines.text")
    new = {"text": text, "n_chars": F.when(changed, F.char_length(text).cast("long")).otherwise(F.col("n_chars"))}
    return left.where(~changed | ~linededup.scrap(F.col("text"), text)).select(
        *[new.get(c, F.col(c)).alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the least id. Of rows that repeat
    an id the least by all columns stays."""
    groups = cut(minhash.near_duplicates(docs).where("doc_id is not null").select(F.col("doc_id").alias("__id"), "kept"))
    state = groups.groupBy("__id").agg(F.min("kept").alias("kept"), F.count("*").alias("rows"))
    several = state.where("kept and rows > 1")
    once = docs.join(state.where("not kept or rows > 1"), F.col("doc_id") == F.col("__id"), "left_anti")
    if several.isEmpty():
        return once
    again = docs.join(several, F.col("doc_id") == F.col("__id"), "left_semi")
    least = again.groupBy("doc_id").agg(F.min(F.struct(*docs.columns)).alias("row"))
    return once.unionByName(least.select("row.*"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those that hold a passage of the benchmark."""
    bench = read_table(spark, sf_dir, "benchmark", ["item_id", "text"])
    return decontam.contaminated(docs, bench, out="__items").where(F.size("__items") == 0).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 1024 ids: one row per piece with its ids."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

# learned models, hashing with verification and tokenizers have no SQL form; see tests/llm/test_pipeline.py
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what lies between them is written under ``spark.checkpoint.dir``."""
    folder = f"{checkpoint_dir(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
