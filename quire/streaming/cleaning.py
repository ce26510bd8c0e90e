"""Cleaning over a growing folder or table.

Decoding, cleaning and the gate look at one document at a time, so the same expressions run on a
stream, and the stream's checkpoint makes a restarted job go on where it stopped.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quire.fixed_values import MIN_LENGTH, TEXT_FILE_GLOB
from quire.operators.cleaning import gate
from quire.sources.texts import BINARY_SCHEMA, decoded


def read_texts_stream(spark: SparkSession, path: str, files_per_batch: int = 10_000) -> DataFrame:
    """New ``*.txt`` files of a folder as a stream of ``(doc_id, text)``."""
    files = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_SCHEMA)
        .option("pathGlobFilter", TEXT_FILE_GLOB)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(path)
    )
    return decoded(files)


def read_documents_stream(
    spark: SparkSession, path: str, schema, glob: str = "*.parquet", files_per_batch: int = 1_000
) -> DataFrame:
    """New Parquet files of a document table: a folder of them, or a table that is a single file.

    A stream follows folders only, so of a single file it follows the folder, for files of that name.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).isFile():
        path, glob = place.getParent().toString(), re.sub(r"([\\{}\[\]*?])", r"\\\1", place.getName())
    files = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return files.option("pathGlobFilter", glob).parquet(path)


def clean_available(
    documents: DataFrame, path: str, checkpoint: str, min_length: int = MIN_LENGTH
) -> StreamingQuery:
    """Clean what has arrived since the last run and append it, with its status, to ``path``."""
    return (
        gate(documents, min_length)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
