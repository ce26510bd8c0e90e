"""Written intermediate tables in the cluster's shared folder.

A few operators read an intermediate result more than once, or depend on where a range shuffle
put each row. They write it as Parquet: the table survives the loss of any executor, and
later reads prune columns, which a row checkpoint can not do.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="quire-")
    return _local_folders[context.applicationId]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, grouped by application so it is easy to retire."""
    application = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/quire/{application}/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once and return the written table; ``compression`` is for columns of bytes that Spark's own does not shrink."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    # What the write has shuffled is of no use once the table is there; else it stays on the executors' disks.
    before = spark.conf.get(_CLEAN_UP, "false")
    spark.conf.set(_CLEAN_UP, "true")
    try:
        df.write.parquet(path, compression=compression)
    finally:
        spark.conf.set(_CLEAN_UP, before)
    table = spark.read.schema(df.schema).parquet(path)
    table.staged_path = path
    return table


def drop(*tables: DataFrame) -> None:
    """Remove tables that ``stage`` returned, once what was made of them has been written itself."""
    for table in tables:
        _remove(table.sparkSession, table.staged_path)


def retire(spark: SparkSession) -> None:
    """Remove all written intermediate tables of this application.

    Results that still read them must have been written before.
    """
    _remove(spark, f"{shared_folder(spark)}/quire/{spark.sparkContext.applicationId}")


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
