"""Lists of book ids in text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.fixed_values import COMMENT_MARK
from quire.functions.text import strip


def parse_ids(lines: DataFrame, column: str = "value") -> DataFrame:
    """Distinct ids in a table of lines; blank lines and comments are left out."""
    return (
        lines.select(strip(F.col(column)).alias("book_id"))
        .filter((F.col("book_id") != "") & ~F.startswith("book_id", F.lit(COMMENT_MARK)))
        .distinct()
    )


def numeric_order(ids: DataFrame) -> DataFrame:
    """By number, then by text (``007`` before ``7``)."""
    return ids.orderBy(F.col("book_id").cast("decimal(38,0)"), "book_id")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Distinct ids of a file in numeric order.

    Raises ValueError when there is none or when one is not a number.
    """
    ids = parse_ids(spark.read.text(path))
    not_numeric = F.min(F.when(~F.col("book_id").rlike("^[0-9]+$"), F.col("book_id")))
    checks = ids.agg(F.count("*").alias("n"), not_numeric.alias("bad")).first()
    if checks.n == 0:
        raise ValueError(f"no ids in {path}")
    if checks.bad is not None:
        raise ValueError(f"not a number: {checks.bad!r} in {path}")
    return numeric_order(ids)
