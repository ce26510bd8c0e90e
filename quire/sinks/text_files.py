"""One text file per document, for readers that expect a folder of files."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.fixed_values import TEXT_SUFFIX


def write_text_files(documents: DataFrame, path: str, key: str = "doc_id", content: str = "text") -> int:
    """Write ``<key>.txt`` for every row and return their number.

    ``content`` is text or bytes; null gives an empty file. A file is written aside and then renamed, so it is
    whole or absent, and a task that is run again replaces its own files. Keys have to be different
    from each other and no paths: of equal keys one file stays, and a null key or one with a slash is an error.
    Large corpora are better kept in Parquet (``quire.sinks.tables``).
    """
    rows = documents.select(F.col(key).cast("string").alias("key"), F.col(content).cast("binary").alias("content"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = fs.FileSystem.from_uri(path)
        files.create_dir(folder, recursive=True)
        for batch in batches:
            for name, body in zip(batch["key"].to_pylist(), batch["content"]):
                if not name or "/" in name:
                    raise ValueError(f"not a file name: {name!r}")
                aside = f"{folder}/.{name}-{uuid.uuid4().hex}"
                with files.open_output_stream(aside) as out:
                    out.write(body.as_buffer() if body.is_valid else b"")
                files.move(aside, f"{folder}/{name}{TEXT_SUFFIX}")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    return rows.mapInArrow(write, "n bigint").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
