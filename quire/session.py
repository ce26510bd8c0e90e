"""Session settings the library is tuned for."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Join token arrays to their small offset rows by hash: no sort of wide rows.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
    # Rows are whole documents and books are large: keep batches of rows small.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.parquet.columnarReaderBatchSize": "512",
}


_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_shipped: set[str] = set()


def keep_batches_small(spark: SparkSession) -> None:
    """Rows are whole texts: a batch of Spark's 10,000 is held twice by the JVM and several times by the worker."""
    most = int(SETTINGS[_BATCH_ROWS])
    if not 0 < int(spark.conf.get(_BATCH_ROWS)) <= most:
        spark.conf.set(_BATCH_ROWS, str(most))


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers (as ``--py-files`` would)."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="quire-package-"), "quire")
    root, name = os.path.split(package)
    context.addPyFile(shutil.make_archive(target, "zip", root, name))
    _shipped.add(context.applicationId)


def local_session(cores: int | str = "*", memory: str = "8g", partitions: int = 8) -> SparkSession:
    """Single-machine session for tests and measurements."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("quire")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark
