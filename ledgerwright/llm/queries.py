"""Registered queries of the text-corpus operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, decontaminate, fingerprints, hard_negatives, language_id, licenses, near_dedup, quality_classifier,
               quality_rules, secrets, suffix_dedup, warc, whitening)
from .common import read_table

VOCABULARY = "byte_bpe_50k.json"  # found by each task where it runs
RANKS = "byte_bpe_50k.tiktoken"


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items whose words they hold to four fifths or more."""
    return decontaminate.find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to WARC archives and read back; repeated payloads are revisits."""
    return warc.page_archive(read_table(spark, sf_dir, "pages"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and robust outliers per language and source."""
    return quality_rules.quality_verdicts(read_table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of documents, learned from labels of rows that are not held out."""
    return quality_classifier.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of documents, learned from rows that are not held out."""
    return language_id.identify(read_table(spark, sf_dir, "documents"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of encoded and decoded documents."""
    return bpe.encode_documents(read_table(spark, sf_dir, "documents"), VOCABULARY, keep=())


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses of documents, taken as files below their source, own or inherited."""
    files = licenses.document_files(read_table(spark, sf_dir, "documents"))
    return licenses.scan_licenses(files).withColumnRenamed("file_id", "doc_id")


def op8_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of documents: three-word shingles, similarity 0.85 or more."""
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, percent=85)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of documents: pattern spans and strings that the tokenizer cannot shorten."""
    docs = read_table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text")
    return secrets.scan(docs, RANKS).drop("text")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of documents that remain once every repeated 400-byte string is removed."""
    return suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents")).drop("kept")


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings whitened along their four components of largest variance."""
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"), "embedding", 4)


def op12_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of documents and of their edited texts, with the likeness of both and of the next document."""
    return fingerprints.edited_likeness(read_table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth embedding, for each of its first positives."""
    return hard_negatives.mine(read_table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_benchmark_decontamination, op2_warc, op3_quality_rules, op4_quality_classifier, op5_language_id, op6_bpe,
    op7_license_scan, op8_minhash_forest, op9_secret_scan, op10_suffix_dedup,
    op11_embedding_whitening, op12_document_fingerprints, op13_hard_negatives)}

SQL: dict[str, str] = {
    # 40 hexadecimal digits of SHA-1 are eight groups of 20 bits, so of four base32 characters
    "op2_warc": """
        WITH records AS (
            SELECT CAST(page_id AS BIGINT) AS page_id, encode(coalesce(html, '')) AS payload FROM pages),
        digests AS (
            SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS hex,
                   max(page_id) OVER (PARTITION BY sha1(payload)) AS newest
            FROM records)
        SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
               array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
                   (CAST('0x' || substr(hex, 5 * CAST(k // 4 AS INTEGER) + 1, 5) AS BIGINT)
                    >> CAST(15 - 5 * (k % 4) AS INTEGER)) & 31 AS INTEGER) + 1, 1)), '') AS payload_digest,
               CASE WHEN page_id = newest THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id = newest THEN NULL ELSE newest END AS refers_to
        FROM digests""",
    "op13_hard_negatives": """
        WITH whole AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(
                embedding, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0),
        scores AS (
            SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS alike,
                   CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
            FROM whole a JOIN whole b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
        positives AS (
            SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE alike
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
        ranked AS (
            SELECT p.anchor_id, p.positive_id, s.other_id AS negative_id, p.positive_score, s.score AS negative_score,
                   row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS rank
            FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.alike
                AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score)
        SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
        FROM ranked WHERE rank <= 5""",
}
