"""Stages from raw documents to packed sequences, each written as Parquet and read by the next.

quality rules   documents that the standard policy rejects go
line dedup      of a line template in several documents the first line stays
near-dedup      of documents linked by fingerprints at most two bits apart, or by 0.8 or more of
                their five-word shingles, one stays
secret scans    secrets become a mark
packing         what is left, as token pieces with their places in sequences
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfcast.durable import settle
from shelfcast.llm import (
    anchor_simhash,
    line_templates,
    quality_ledger,
    secret_lexer,
    shingle_overlap,
    swap_packing,
)
from shelfcast.llm.queries import VOCABULARY, vocabulary


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_ledger.keep_documents(docs, quality_ledger.STANDARD)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_templates.dedup_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shingle_overlap.keep_one(docs, max_bits=anchor_simhash.MAX_BITS)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_lexer.redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return swap_packing.pack_documents(docs, vocabulary(VOCABULARY))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near-dedup", near_dedup),
    ("secret scans", secret_scans),
    ("packing", best_fit_packing),
]

#: Hashes of shingles, lexing and token ids are not expressible in DuckDB SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
