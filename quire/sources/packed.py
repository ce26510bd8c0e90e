"""Packed datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_packed(spark: SparkSession, path: str) -> DataFrame:
    """A packed dataset; a filter on ``split`` reads only that part."""
    return spark.read.parquet(path)


def split_counts(packed: DataFrame) -> DataFrame:
    return packed.groupBy("split").agg(F.count("*").alias("n_chunks"))
