"""The registered queries of the training-data operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quire.llm import (
    alignment,
    chat_formatting,
    collocations,
    decontamination,
    embedding_dedup,
    language_id,
    license_scan,
    line_dedup,
    lm_scoring,
    packing,
    sharding,
    simhash_dedup,
    token_quality,
)
from quire.llm.batches import keep_batches_small


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    keep_batches_small(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op5_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed_pieces(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.sharded_documents(_table(spark, folder, "documents"))


def op1_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm_scoring.score_documents(_table(spark, folder, "documents"))


def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.deduped_lines(_table(spark, folder, "documents"))


def op3_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    return chat_formatting.formatted_conversations(_table(spark, folder, "conversations"))


def op4_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_dedup.component_rows(_table(spark, folder, "documents"))


def op6_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.license_rows(_table(spark, folder, "documents"))


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.language_rows(_table(spark, folder, "documents"))


def op8_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contamination_rows(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op9_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_vectors(_table(spark, folder, "embeddings"))


def op11_tokenizer_fertility(spark: SparkSession, folder: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return token_quality.quality_rows(_table(spark, folder, "documents"), *paths)


def op12_cross_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.alignment_rows(_table(spark, folder, "documents"), *paths)


def op13_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(_table(spark, folder, "documents"))


QUERIES = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_line_dedup": op2_line_dedup,
    "op3_chat_formatting": op3_chat_formatting,
    "op4_simhash_dedup": op4_simhash_dedup,
    "op6_license_scan": op6_license_scan,
    "op7_language_id": op7_language_id,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op10_sharding": op10_sharding,
    "op11_tokenizer_fertility": op11_tokenizer_fertility,
    "op12_cross_tokenizer_alignment": op12_cross_tokenizer_alignment,
    "op13_phrase_collocations": op13_phrase_collocations,
}
ORACLES: dict[str, str] = {
    "op3_chat_formatting": chat_formatting.ORACLE,
    "op6_license_scan": license_scan.ORACLE,
    "op8_benchmark_decontamination": decontamination.ORACLE,
    "op9_embedding_dedup": embedding_dedup.ORACLE,
    "op13_phrase_collocations": collocations.ORACLE,
}
