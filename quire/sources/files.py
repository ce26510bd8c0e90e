"""A folder of text files as a table with an outcome per file.

The folder is listed once, its files are dealt to tasks by bytes, and every file gives one row: its
content, or what kept it from being read. Nothing is written in between, and one bad file neither
ends the job nor goes missing. Files are opened by Arrow's file systems (local and mounted folders,
and those it has an address scheme for); where only Spark's readers reach a folder, use
``quire.sources.texts.read_texts``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fnmatch import fnmatchcase

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from quire.fixed_values import TEXT_FILE_GLOB
from quire.functions.text import decode_lossy, universal_newlines
from quire.sources.texts import file_name_key

SCHEMA = "path string, content binary, error string"
_ARROW = pa.schema([("path", pa.string()), ("content", pa.binary()), ("error", pa.string())])
TASK_BYTES = 128 << 20
# Opening a file counts as reading this many bytes, so tasks of tiny files stay short: a task has at most
# so many files. Starting a task takes as long as opening hundreds of files, so it should not be much fewer.
OPEN_BYTES = 128 << 10
TASK_FILES = 1024
BATCH_BYTES = 16 << 20
# A cell of a row can not hold more.
MAX_BYTES = 2_000_000_000


@dataclass
class Files(InputPartition):
    paths: list[str]


def _open(address: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(address)


class FileReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        options = {k.lower(): v for k, v in options.items()}  # as Spark compares them
        self.folder = options["path"]
        self.glob = options.get("glob", TEXT_FILE_GLOB)
        self.task_bytes = int(options.get("taskbytes", TASK_BYTES))
        self.max_bytes = int(options.get("maxbytes", MAX_BYTES))

    def partitions(self) -> list[InputPartition]:
        """Files in the order of their names, cut into runs of about ``task_bytes``."""
        files, folder = _open(self.folder)
        found = [
            f for f in files.get_file_info(fs.FileSelector(folder))
            if f.type == fs.FileType.File and f.base_name[0] not in "._" and fnmatchcase(f.base_name, self.glob)
        ]
        runs, room = [], 0
        for file in sorted(found, key=lambda f: f.path):
            cost = (file.size or 0) + min(OPEN_BYTES, -(-self.task_bytes // TASK_FILES))
            if cost > room or not runs:
                runs.append([])
                room = self.task_bytes
            runs[-1].append(file.path)
            room -= cost
        return [Files(run) for run in runs] or [Files([])]

    def _content(self, files: fs.FileSystem, path: str) -> tuple[bytes | None, str | None]:
        try:
            with files.open_input_file(path) as file:
                size = file.size()
                if size > self.max_bytes:
                    return None, f"too large ({size} bytes)"
                return file.read(), None
        except (OSError, pa.ArrowException) as problem:
            return None, f"{type(problem).__name__}: {problem}"

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        files, _ = _open(self.folder)
        rows, held = [], 0
        for path in partition.paths:
            content, error = self._content(files, path)
            size = len(content or b"")
            if rows and held + size > BATCH_BYTES:
                yield _batch(rows)
                rows, held = [], 0
            rows.append((path, content, error))
            held += size
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _ARROW.types)], schema=_ARROW)


class FileSource(DataSource):
    """Options: ``path``, ``glob``, ``taskBytes``, ``maxBytes``."""

    @classmethod
    def name(cls) -> str:
        return "quire_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return FileReader(dict(self.options))


def read_files(spark: SparkSession, path: str, glob: str = TEXT_FILE_GLOB, task_bytes: int = TASK_BYTES, max_bytes: int = MAX_BYTES) -> DataFrame:
    """``(doc_id, text, error)``: one row per file of ``glob`` directly in the folder.

    Invalid UTF-8 is left out and all line ends become LF. A file that can not be read, or is larger
    than ``max_bytes``, has a null text and the reason. Hidden files are passed over. An empty folder gives no
    rows; a missing one is an error.
    """
    spark.dataSource.register(FileSource)
    options = {"glob": glob, "taskBytes": str(task_bytes), "maxBytes": str(max_bytes)}
    files = spark.read.format(FileSource.name()).options(**options).load(path)
    text = universal_newlines(decode_lossy(F.col("content")))
    return files.select(file_name_key(F.col("path")).alias("doc_id"), text.alias("text"), "error")
