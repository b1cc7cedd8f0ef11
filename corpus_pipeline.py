"""From raw documents to token ids: classify, deduplicate, redact, mix, encode.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept and returns a frame that is written as
Parquet and read again as the next stage's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyhouse.llm import mixing, piece_bpe, quadratic, secrets, simhash
from tallyhouse.llm.common import prepare, table
from tallyhouse.session import shared_folder

#: SQL cannot express the stages; tests/llm/test_pipeline.py holds them against brute force.
ORACLE_SQL = None

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the discriminant rejects go; it learns from the labels outside the held-out fold."""
    prepare(spark)
    return quadratic.accepted(docs, table(spark, sf_dir, "labels"))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the document of the smallest id stays: 4-word shingles, 4 bits."""
    prepare(spark)
    return simhash.deduplicated(docs)


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Findings in the texts are replaced; every document stays."""
    prepare(spark)
    return secrets.redacted(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in an order that interleaves the sources by their target weights."""
    prepare(spark)
    return mixing.mixed(docs)


def piece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, the ids of the whole text, their number, and whether decoding gives the text back."""
    prepare(spark)
    return piece_bpe.encoded_columns(docs, public_tokenizers.path("piece_bpe_32k.model"), ["doc_id", "source"])


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("simhash_dedup", simhash_dedup),
    ("secret_redaction", secret_redaction),
    ("source_mix", source_mix),
    ("piece_encoding", piece_encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    root = shared_folder(spark, "corpus-pipeline")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{root}/{number}-{name}"
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return docs
