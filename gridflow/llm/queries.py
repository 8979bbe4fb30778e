"""The operators applied to the driver tables: one query ``opN_<name>`` each, and the pipeline.

``QUERIES[name](spark, sf_dir)`` reads whole tables with production parameters; ``ORACLE`` holds
the SQL of those that SQL can express.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridflow.llm import (
    decontam, html, linededup, minhash, packing, privacy, privacy_examples, quality, secrets, suffixtree, toxicity, variants, vectorcodes,
    winnow,
)
from gridflow.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), shingle_words=4)


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read_table(spark, sf_dir, "documents", ["doc_id", "text"]),
                             read_table(spark, sf_dir, "labels", ["doc_id", "toxic"]))


@query
def op9_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), exact_words=linededup.EXACT_WORDS)


@query
def op10_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(read_table(spark, sf_dir, "documents", ["doc_id", "text"]),
                                  read_table(spark, sf_dir, "benchmark", ["item_id", "text"]))


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), with_ids=False)


@query
def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


@query
def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(read_table(spark, sf_dir, "pages", ["page_id", "url", "html"]))


@query
def op7_suffixtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixtree.score_texts(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_texts(read_table(spark, sf_dir, "documents", ["doc_id", "text"]),
                               read_table(spark, sf_dir, "labels", ["doc_id", "quality"]))


@query
def op1_winnow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.edited_fingerprints(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


@query
def op12_limbcodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectorcodes.compress(read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"]))


ORACLE["op12_limbcodes"] = vectorcodes.oracle_sql()


@query
def op11_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


@query
def op13_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy.digest(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), privacy_examples.labelled_table(spark))
