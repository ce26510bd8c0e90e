"""A table that is replaced as a whole or not at all.

Every replacement is written to a folder of its own and counts once its mark is there, so readers see the
old rows until all new ones are written, and a job that fails half way changes nothing. Versions have a
batch name: writing a batch again does nothing, so a job may be repeated without asking how far it came.
One writer at a time; of two, the later one is refused.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from quire.sinks.committed import Committed


class ReplacedTable(Committed):
    def _version(self, number: int) -> str:
        return f"{self.path}/versions/{number}"

    def replace(self, rows: DataFrame, batch: str, partition_by: tuple[str, ...] = ()) -> bool:
        """Make ``rows`` the content; False if ``batch`` was written before."""
        marks = self.generations()
        if any(m["batch"] == batch for m in marks):
            return False
        number = len(marks)
        rows.write.mode("overwrite").partitionBy(*partition_by).parquet(self._version(number))
        self._mark(number, batch=batch, schema=rows.schema.json())
        return True

    def read(self) -> DataFrame:
        """Rows of the last version."""
        marks = self.generations()
        if not marks:
            raise ValueError(f"nothing has been written to {self.path}")
        schema = StructType.fromJson(json.loads(marks[-1]["schema"]))
        rows = self.spark.read.schema(schema).parquet(self._version(marks[-1]["generation"]))
        # Columns that name folders come last from the reader.
        return rows.select(*[rows[f"`{name}`"] for name in schema.names])

    def drop_old(self) -> None:
        """Remove the rows of all versions but the last; readers of older ones must have ended."""
        for mark in self.generations()[:-1]:
            folder, files = self._files(self._version(mark["generation"]))
            files.delete(folder, True)
