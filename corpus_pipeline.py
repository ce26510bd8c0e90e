"""The corpus pipeline: from documents to packed token pieces.

Language identification, line dedup, near-dedup, benchmark decontamination, best-fit packing.
Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one before kept. Column ``n_chars``, if
there is one, follows the text. Empty tables and repeated rows pass as the operators define.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import decontamination, language_id, line_dedup, packing, simhash_dedup
from quire.llm.batches import keep_batches_small
from quire.session import ship_package
from quire.staging import stage

#: Mean probability of the best language below which a document is rejected.
MIN_LANGUAGE_SCORE = 0.35


def _ready(spark: SparkSession) -> None:
    ship_package(spark)
    keep_batches_small(spark)


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters (or text), or of no learned language, go."""
    _ready(spark)
    known = (F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE)
    return language_id.identify(docs).filter(known).select("row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near-equal lines stay in one place; a document of which nothing but blanks is left goes."""
    _ready(spark)
    left = line_dedup.dedup_lines(docs)
    some = F.col("text").rlike(r"(?U)\S")
    left = left.filter(F.col("text").isNull() | (F.col("n_removed") == 0) | some)
    return left.select(*_with_text(docs, F.col("text"), F.col("n_removed") > 0))


def keep_one_near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of SimHash fingerprints of three-word shingles within two bits stays."""
    _ready(spark)
    return simhash_dedup.one_of_each(docs)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of test items are cut out; a document that is mostly such passages goes."""
    _ready(spark)
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their place in sequences."""
    _ready(spark)
    return packing.packed_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"))


def _with_text(docs: DataFrame, text, changed) -> list:
    values = {c: F.col(f"row.`{c}`") for c in docs.columns}
    if "n_chars" in values:
        kind = docs.schema["n_chars"].dataType
        values["n_chars"] = F.when(changed, F.length(text).cast(kind)).otherwise(values["n_chars"])
    return [(text if c == "text" else v).alias(c) for c, v in values.items()]


STAGES = [
    ("language_id", keep_known_languages),
    ("line_dedup", drop_repeated_lines),
    ("simhash_dedup", keep_one_near_duplicate),
    ("decontamination", cut_benchmark),
    ("packing", pack),
]

#: A trained network, a graph search and a packing plan are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
