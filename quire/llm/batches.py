"""How many documents go to a Python worker at once."""

from __future__ import annotations

from pyspark.sql import SparkSession

MOST_ROWS = 512
_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def keep_batches_small(spark: SparkSession) -> None:
    """Rows are whole texts: a batch of Spark's 10,000 is held twice by the JVM and once by the worker."""
    now = int(spark.conf.get(_SETTING))
    if not 0 < now <= MOST_ROWS:
        spark.conf.set(_SETTING, str(MOST_ROWS))
