"""Each operator over its whole table, by query name."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyhouse.llm import (
    compression,
    decontamination,
    hnsw,
    interpolation,
    mixing,
    negatives,
    passages,
    piece_bpe,
    quadratic,
    rules,
    secrets,
    sharding,
    simhash,
)
from tallyhouse.llm.common import table


def op1_hnsw(spark: SparkSession, folder: str) -> DataFrame:
    return hnsw.nearest_neighbours(table(spark, folder, "embeddings"))


def op2_compact_windows(spark: SparkSession, folder: str) -> DataFrame:
    return passages.repeated_passages(table(spark, folder, "documents"))


def op3_linked_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.digests(secrets.scan(table(spark, folder, "documents")))


def op4_lpt_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(table(spark, folder, "documents"))


def op5_pfair_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


def op6_simhash_anchors(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op7_piece_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return piece_bpe.digests(piece_bpe.encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model")))


def op8_deleted_interpolation(spark: SparkSession, folder: str) -> DataFrame:
    return interpolation.score_documents(table(spark, folder, "documents"))


def op9_risk_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rules.verdicts(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_quadratic(spark: SparkSession, folder: str) -> DataFrame:
    return quadratic.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op11_hilbert_codes(spark: SparkSession, folder: str) -> DataFrame:
    return compression.compress(table(spark, folder, "embeddings")).drop("label")


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return negatives.hard_negatives(table(spark, folder, "embeddings"))


def op13_suffix_arrays(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return decontamination.digests(found)


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    operators = (
        op1_hnsw,
        op2_compact_windows,
        op3_linked_secrets,
        op4_lpt_shards,
        op5_pfair_mix,
        op6_simhash_anchors,
        op7_piece_bpe,
        op8_deleted_interpolation,
        op9_risk_rules,
        op10_quadratic,
        op11_hilbert_codes,
        op12_hard_negatives,
        op13_suffix_arrays,
        pipeline,
    )
    return {f.__name__: f for f in operators}
