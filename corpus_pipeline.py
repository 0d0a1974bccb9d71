"""Training-data pipeline over ``documents``: stages of ``boxstar.llm`` in order.

1. quality classifier: documents that it rejects go.
2. simhash near-dedup: of each group of near-duplicates the document with the
   smallest doc_id stays (one row of it, where rows repeat).
3. secret scans: secrets in the texts are put out of sight.
4. packing: what is left is packed into training sequences.

Every stage takes and returns whole tables; all but the last return the columns
that they were given. NULL and empty texts are rejected by the first stage. A
document with a NULL id is a group of its own. An empty table passes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers
from boxstar.llm import packing, quality, secrets, simhash
from boxstar.llm.common import documents, land


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the weak-label classifier keeps."""
    return quality.keep_good(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group (4-word shingles, 4 bits): the smallest doc_id."""
    return simhash.keep_one(docs)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents without the secrets that the scan finds."""
    return secrets.redact_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the documents that are left."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", drop_low_quality),
    ("simhash near-dedup", drop_near_duplicates),
    ("secret scans", hide_secrets),
    ("packing", pack_sequences),
]

#: A learnt classifier and a tokenizer are beyond SQL; the tests hold the
#: pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = land(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
