"""The corpus pipeline: quality rules, near-dedup, secret scans, source mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the
last return the columns of documents; the last returns the packed pieces.

Defined cases: null and empty texts fail the quality rules; texts of any length are worked on whole;
repeated rows are one group of copies, and one of them stays; rows that share a null or repeated
doc_id but no text are documents of their own; a null source is a source; an empty table stays
empty; further columns, whatever their names, are carried to the last stage, which returns its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gondola.llm import mixing, near_copies, packing, quality, secret_scan
from gondola.llm.common import materialise


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a rule rejects go."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word Jaccard similarity of 0.8 or more), the document with the smallest doc_id stays."""
    return near_copies.drop_near_copies(docs)


def secret_scan_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Owner-specific credentials are masked; the documents stay."""
    return secret_scan.redact(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it."""
    return mixing.mix(docs)


def lexical_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of windows of 2048 tokens, with their ids; a small cache, for executors that have run all stages before."""
    return packing.pack(docs, with_ids=True, cache_chunks=200_000)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan_redaction),
    ("source_mixing", source_mixing),
    ("lexical_packing", lexical_packing),
]

#: SQL cannot hash shingles or tokenise; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs, f"pipeline-{name}")
    return docs
