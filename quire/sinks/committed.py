"""Folders whose content counts once a mark says so."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

_MARKS = "_committed"


class Committed:
    """Numbered generations of a folder: the mark of one is created last and at once.

    What has no mark was left by a failed job, is ignored by readers and replaced by the next writer.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _files(self, path: str):
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop, hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def generations(self) -> list[dict]:
        """What the marks say of each committed generation, in order."""
        folder, files = self._files(f"{self.path}/{_MARKS}")
        if not files.exists(folder):
            return []
        names = sorted(int(f.getPath().getName()) for f in files.listStatus(folder) if f.getPath().getName().isdigit())
        marks = []
        for name in names:
            rows = self.spark.read.text(f"{self.path}/{_MARKS}/{name}", wholetext=True).collect()
            marks.append(json.loads(rows[0].value))
        return marks

    def _mark(self, number: int, **facts) -> None:
        # Written aside and renamed, so that a mark is whole or absent; names of digits only are marks.
        whole, files = self._files(f"{self.path}/{_MARKS}/{number}")
        aside, _ = self._files(f"{self.path}/{_MARKS}/{number}.new")
        out = files.create(aside, True)
        out.write(json.dumps({"generation": number, **facts}).encode())
        out.close()
        if files.exists(whole) or not files.rename(aside, whole):
            raise RuntimeError(f"generation {number} has been committed by another writer")
