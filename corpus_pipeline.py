"""Training-corpus pipeline: the stages in order, each reading what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerwright.llm import bpe, decontaminate, near_dedup, quality_rules, secrets
from ledgerwright.llm.common import Tables, read_table
from ledgerwright.llm.queries import RANKS, VOCABULARY


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_accepted(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (five-word shingles, similarity 0.8 or more)."""
    return near_dedup.keep_one_of_each_group(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts; every document stays."""
    return secrets.mask_secrets(docs, RANKS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left."""
    return bpe.encode_documents(docs, VOCABULARY, keep=("ids",))


STAGES = [
    ("quality_rules", accept_quality),
    ("minhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_leaks),
    ("secret_scan", mask_secrets),
    ("bpe_encoding", encode),
]

#: Several stages are iterative or use a tokenizer, which SQL cannot express; a brute-force test holds run().
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; every stage is written and read again."""
    tables = Tables(spark, "corpus-pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = tables.put(stage(spark, docs, sf_dir), f"{k}-{name}")
        if k:
            tables.drop(f"{k - 1}-{STAGES[k - 1][0]}")
    return docs
