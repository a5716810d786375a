"""The text operators as queries over the test tables, and the same in SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.llm import (
    alignment,
    archive,
    dialogue,
    hamming,
    language_model,
    mixing,
    packing,
    quality,
    quoting,
    secret_scan,
    simhash,
    surrogates,
    token_count,
)
from tallybrook.llm.common import read
from tallybrook.llm.oracle import ORACLE
from tallybrook.session import work_path


def _vocabulary(name: str) -> str:
    """The path of a public tokenizer file; the package is installed on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a hidden Markov model."""
    return language_model.scored(read(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents and the sequences they are packed into."""
    pieces = packing.tokenized(read(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"))
    digest = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(digest)


def op3_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages without quotes, linked to what they answer."""
    return quoting.linked(read(spark, sf_dir, "conversations"))


def op4_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their personal data replaced."""
    return surrogates.with_surrogates(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every fiftieth one, by the signs of their values."""
    rows = read(spark, sf_dir, "embeddings")
    return hamming.top_k(rows, rows.where("vec_id % 50 = 0"), "vec_id", "embedding")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of each document, counted by kind and listed."""
    found = secret_scan.scan(read(spark, sf_dir, "documents"))

    def of(*kinds: str):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    return found.select(
        "doc_id",
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in secret_scan.BASE],
        F.sha2(secret_scan.listed(of(*secret_scan.BASE)), 256).alias("base_sha256"),
        secret_scan.listed(F.col("spans")).alias("spans"),
    )


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of each document."""
    docs = read(spark, sf_dir, "documents")
    return token_count.token_counts(docs, _vocabulary("word_bpe_49k.json"))


def op8_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of each document."""
    return mixing.mixed(read(spark, sf_dir, "documents")).drop("uses")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of each document."""
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of each document."""
    judged = quality.judge(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "quality.*").drop("cleaned")


def op11_dialogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cheapest repair of each conversation, after repeatable damage."""
    rows = dialogue.damaged(read(spark, sf_dir, "conversations"))
    return dialogue.repairs(rows, dropped=F.col("dropped"))


def op12_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages archived, and the records read back."""
    pages = read(spark, sf_dir, "pages")
    path = work_path(spark, "archive")
    archive.write_archive(pages, path)
    kind = pages.schema["page_id"].dataType
    return archive.read_index(spark, path).select(
        F.col("page_id").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How two tokenizers' tokens line up in each document."""
    docs = read(spark, sf_dir, "documents")
    files = _vocabulary("byte_bpe_50k.json"), _vocabulary("piece_bpe_32k.model")
    return alignment.aligned(docs, *files)[0]


QUERIES = {
    "op1_hmm": op1_hmm,
    "op2_packing": op2_packing,
    "op3_quotes": op3_quotes,
    "op4_surrogates": op4_surrogates,
    "op5_hamming": op5_hamming,
    "op6_secrets": op6_secrets,
    "op7_token_counts": op7_token_counts,
    "op8_curriculum": op8_curriculum,
    "op9_simhash": op9_simhash,
    "op10_quality": op10_quality,
    "op11_dialogue": op11_dialogue,
    "op12_archive": op12_archive,
    "op13_alignment": op13_alignment,
}

__all__ = ["ORACLE", "QUERIES"]
