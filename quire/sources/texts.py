"""Folders of text files, and text inside ZIP payloads."""

from __future__ import annotations

import io
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.fixed_values import TEXT_FILE_GLOB, TEXT_SUFFIX
from quire.functions.catalog import file_key
from quire.functions.text import decode_lossy, universal_newlines
from quire.operators.tokens import stories
from quire.staging import stage

BINARY_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def file_name_key(path: Column) -> Column:
    """Name of a text file without its folder and suffix."""
    return file_key(F.element_at(F.split(path, "/"), -1), r"^(.+)\.txt$")


def _key() -> Column:
    return file_name_key(F.col("path"))


def _text() -> Column:
    return universal_newlines(decode_lossy(F.col("content")))


def decoded(files: DataFrame) -> DataFrame:
    """``(doc_id, text)`` of a binary file table; also works on a stream."""
    return files.select(_key().alias("doc_id"), _text().alias("text"))


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """One row per ``*.txt`` file directly in a folder.

    Invalid UTF-8 is left out and all line ends become LF. A file that can not be read has a null
    text, which the gate reports as failed. Files are read once and their texts written; the listing
    is then compared with what was read.
    """
    source = spark.read.format("binaryFile").option("pathGlobFilter", TEXT_FILE_GLOB)
    listed = source.load(path).select("path")
    files = source.option("ignoreCorruptFiles", "true").load(path)
    read = stage(files.select(F.col("path").alias("_path"), _key().alias("doc_id"), _text().alias("text")), "texts")
    lost = listed.join(read.select(F.col("_path").alias("path")), "path", "left_anti")
    missing = lost.select(_key().alias("doc_id"), F.lit(None).cast("string").alias("text"))
    return read.select("doc_id", "text").unionByName(missing)


def read_stories(spark: SparkSession, path: str) -> DataFrame:
    """Non-blank texts of a folder, stripped."""
    return stories(read_texts(spark, path))


def _text_members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for row in batch.itertuples(index=False):
            found = []
            try:
                with zipfile.ZipFile(io.BytesIO(row.content)) as archive:
                    for i, name in enumerate(archive.namelist()):
                        if name.lower().endswith(TEXT_SUFFIX):
                            text = archive.read(name).decode("utf-8", errors="ignore")
                            found.append((row.book_id, row.priority, i, name, text))
            except (zipfile.BadZipFile, zlib.error):
                pass  # members read before the damage still count
            yield pd.DataFrame(found, columns=["book_id", "priority", "member_idx", "member", "body"])


def zip_members(archives: DataFrame) -> DataFrame:
    """Text members of ``(book_id, priority, content)`` ZIP payloads.

    A damaged archive gives the members before the damage, or none.
    """
    schema = "book_id string, priority int, member_idx int, member string, body string"
    payloads = archives.select(
        "book_id", F.col("priority").cast("int").alias("priority"), F.col("content")
    ).filter(F.col("content").isNotNull())
    return payloads.mapInPandas(_text_members, schema)
