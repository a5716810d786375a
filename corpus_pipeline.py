"""From raw documents to packed training sequences, stage by stage.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept; all but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.llm import mixing, packing, quality, simhash, surrogates
from tallybrook.llm.common import read, stored

TOKENIZER = "byte_bpe_50k.json"


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, and so do documents that the quality rules reject."""
    return quality.kept_documents(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.one_per_group(docs, shingle=3, max_bits=2)


def protect(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by surrogates."""
    return surrogates.with_surrogates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix uses them, in the order of training."""
    return mixing.training_order(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes among the training sequences, in the order of the mix."""
    import public_tokenizers

    ranked, order = mixing.with_rank(docs)
    pieces = packing.tokenized(ranked, public_tokenizers.path(TOKENIZER), carried=order)
    pieces = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack_in_order(pieces, [*order, "piece"]).drop(*order)


STAGES = [
    ("quality rules", clean),
    ("SimHash near-dedup", deduplicate),
    ("PII surrogates", protect),
    ("curriculum mixing", mix),
    ("sum-of-squares packing", pack),
]

# Fingerprints, surrogates and token ids have no SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)
