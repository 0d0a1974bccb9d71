"""Queries of this package: thin callers over the operators, on whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers
from boxstar.llm import (
    chatpairs, chunkreuse, filteraudit, fim, hilbert, imatch, packing, pll, pq, quality, secrets, simhash, tokencount,
)
from boxstar.llm.common import documents


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masked pseudo-likelihood of every document."""
    return pll.pseudo_likelihood(documents(spark, sf_dir))


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preference pairs of all conversations: shared prompt and masked completions."""
    return chatpairs.preference_pairs(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings at cosine 0.95."""
    return pq.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weak-label quality scores and decisions for all documents."""
    return quality.classify(documents(spark, sf_dir))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE token counts of all documents."""
    return tokencount.token_counts(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op6_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and the decoded texts of all documents."""
    return chunkreuse.encode_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I-Match fingerprints of all documents and their edited texts."""
    return imatch.fingerprint_documents(documents(spark, sf_dir))


def op8_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents."""
    return secrets.scan_documents(documents(spark, sf_dir))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints and components of all documents."""
    return simhash.near_duplicates(documents(spark, sf_dir))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cutting-stock packing of all documents into sequences of 4096 tokens."""
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill-in-middle transformation of all documents."""
    return fim.transform_documents(documents(spark, sf_dir))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders of the five filters over all documents, by source."""
    return filteraudit.audit_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents along a Hilbert curve, in 24 shards."""
    return hilbert.shard_documents(documents(spark, sf_dir))


QUERIES = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_chat_formatting": op2_chat_formatting,
    "op3_embedding_near_dedup": op3_embedding_near_dedup,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_token_counts": op5_token_counts,
    "op6_bpe_encoding": op6_bpe_encoding,
    "op7_fingerprints": op7_fingerprints,
    "op8_secret_scans": op8_secret_scans,
    "op9_simhash": op9_simhash,
    "op10_packing": op10_packing,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_filter_audit": op12_filter_audit,
    "op13_sharding": op13_sharding,
}

#: The others are held against brute force in the tests: they need a tokenizer, a
#: trained model, XXH64, a curve or a regular-expression scan with positions.
ORACLE: dict[str, str] = {
    "op2_chat_formatting": chatpairs.ORACLE_SQL,
    "op11_fill_in_middle": fim.ORACLE_SQL,
    "op12_filter_audit": filteraudit.ORACLE_SQL,
}
