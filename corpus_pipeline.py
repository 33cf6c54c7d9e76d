"""The corpus pipeline: quality rules, line dedup, near-dedup, decontamination, packing. Also hands on all llm queries.

Every stage takes (spark, docs, sf_dir); its result is written as Parquet and read again for the next one.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabwright.llm.catalog import QUERIES as OPERATOR_QUERIES, SQL, WORD_TOKENIZER, table
from tabwright.llm.decontaminate import decontaminate
from tabwright.llm.line_dedup import dedup_lines
from tabwright.llm.packing import pack_documents
from tabwright.llm.quality import keep_good
from tabwright.llm.similarity import one_of_each_group
from tabwright.llm.staging import free_names, staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the limits or lie outside the perplexity band of their language go."""
    return keep_good(docs)


def with_length(docs: DataFrame, columns: list[str], changed: Column) -> DataFrame:
    """The given columns, with ``n_chars``, where there is one, counted again for texts that changed."""
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return docs.select([F.col(f"`{c}`") for c in columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of line runs of 50 words and more are cut; documents of which nothing is left go."""
    lines, removed, runs = free_names(docs.columns, ["n_lines", "n_removed", "n_runs"])
    cut = dedup_lines(docs, counts=(lines, removed, runs)).where((F.col(lines) == 0) | (F.col(removed) < F.col(lines)))
    return with_length(cut, docs.columns, F.col(removed) > 0)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with 0.8 of their five-word shingles in common stays.

    Candidates come from the SimHash anchors, but most pairs at 0.8 differ in more bits than a covering code reaches: those
    come from bands of minimum hashes. Every pair that joins a group is checked exactly.
    """
    return one_of_each_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents that are mostly benchmark text go."""
    before, = free_names(docs.columns, ["before"])
    clean = decontaminate(docs.withColumn(before, F.col("text")), table(spark, sf_dir, "benchmark"))
    return with_length(clean, docs.columns, ~F.col(before).eqNullSafe(F.col("text")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens."""
    return pack_documents(docs, public_tokenizers.path(WORD_TOKENIZER))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]
ORACLE_SQL = None  # language models and tokens are beyond SQL: tests hold each stage against a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


QUERIES = OPERATOR_QUERIES | {"pipeline": run}
