"""Registered queries of the operators in this folder."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tabwright.llm.collisions import near_vectors, near_vectors_sql
from tabwright.llm.collocations import collocations, collocations_sql
from tabwright.llm.decontaminate import find_contamination
from tabwright.llm.lexical import search, search_sql
from tabwright.llm.licenses import scan_licenses, scan_sql
from tabwright.llm.line_dedup import dedup_lines
from tabwright.llm.packing import pack_documents
from tabwright.llm.pii import KINDS, find_personal_data
from tabwright.llm.quality import judge
from tabwright.llm.rans import read_token_files, write_token_files
from tabwright.llm.simhash import near_duplicates
from tabwright.llm.suffix_dedup import dedup_substrings
from tabwright.llm.toxicity import score_toxicity

WORD_TOKENIZER = "word_bpe_49k.json"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return near_duplicates(table(spark, folder, "documents")).select("doc_id", "fingerprint", "component_id")


def op2_contamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark words in every document, and which items they come from."""
    found = find_contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
        F.size("spans").cast("long").alias("n_spans"))


def op3_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """Known licence sentences and the licences they make up, for every document."""
    return scan_licenses(table(spark, folder, "documents"))


def op4_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes removed from every document because a string of 200 bytes around them occurs elsewhere."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return dedup_substrings(table(spark, folder, "documents")).select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Lines removed from every document as later copies of repeated runs of 50 words and more."""
    return dedup_lines(table(spark, folder, "documents")).select(
        "doc_id", "n_lines", "n_removed", "n_runs", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op6_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Spans of personal data in every document, as counts, a digest of the base kinds and a list of all spans."""
    found = find_personal_data(table(spark, folder, "documents"))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["kind"] != "iban")

    def number(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [number(kind) for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
                        F.coalesce(F.array_min(F.transform("spans", lambda s: s["score"])), F.lit(1.0)).alias("least_score"))


def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """All documents written as token files in document order, and what reading them back gives."""
    written = write_token_files(table(spark, folder, "documents"), public_tokenizers.path(WORD_TOKENIZER))
    return read_token_files(spark, written).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document, learned from the labelled rows that are not held out."""
    return score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into windows of 2048 tokens: one row per piece."""
    pieces = pack_documents(table(spark, folder, "documents"), public_tokenizers.path(WORD_TOKENIZER))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality measures of every document, and whether it is kept."""
    return judge(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        *(F.round(c, 4).alias(c) for c in ("perplexity", "upper", "single_perplexity", "single_lower", "single_upper")))


def op11_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Links and components of vectors of equal label with a cosine of 0.98 and more."""
    return near_vectors(table(spark, folder, "embeddings"))


def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    return search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The 2,000 strongest phrases of two and three words of each language."""
    return collocations(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_contamination": op2_contamination,
    "op3_licenses": op3_licenses,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_line_dedup": op5_line_dedup,
    "op6_personal_data": op6_personal_data,
    "op7_token_files": op7_token_files,
    "op8_toxicity": op8_toxicity,
    "op9_packing": op9_packing,
    "op10_quality": op10_quality,
    "op11_embedding_dedup": op11_embedding_dedup,
    "op12_lexical_search": op12_lexical_search,
    "op13_collocations": op13_collocations,
}
SQL: dict[str, str] = {
    "op3_licenses": scan_sql(),
    "op11_embedding_dedup": near_vectors_sql(),
    "op12_lexical_search": search_sql(),
    "op13_collocations": collocations_sql(),
}
