"""Cleaning with a length gate, and its report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.fixed_values import MIN_LENGTH, TOO_SHORT
from quire.functions.cleaning import clean


def evaluated_once(df: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """Add costly columns that later filters and projections must not compute again.

    A filter on a computed column is normally pushed below the projection, which then computes
    it twice. A one-row generator keeps the value where it is. It works on streams as well.
    """
    row = F.struct(*[expression.alias(name) for name, expression in columns.items()])
    return df.select(*keep, F.inline(F.array(row)))


def gate(
    df: DataFrame, min_length: int = MIN_LENGTH, text: str = "text", key: str = "doc_id", error: str | None = None
) -> DataFrame:
    """Clean every document and say what became of it.

    Returns ``(key, status, n_chars, message, text)``. ``status`` is ``success``, ``skipped``
    (shorter than ``min_length``) or ``failed`` (no readable text). ``error`` names a column with the reason of
    a missing text, which becomes the message.
    """
    cleaned = evaluated_once(df, [key] if error is None else [key, error], cleaned=clean(F.col(text)))
    unreadable = F.lit("unreadable text")
    reason = unreadable if error is None else F.coalesce(F.col(error), unreadable)
    n_chars = F.length("cleaned").cast("bigint")
    status = (
        F.when(F.col("cleaned").isNull(), "failed")
        .when(n_chars < min_length, "skipped")
        .otherwise("success")
    )
    message = F.when(F.col("cleaned").isNull(), reason).when(
        n_chars < min_length, F.format_string(TOO_SHORT, n_chars)
    )
    return cleaned.select(
        key,
        status.alias("status"),
        n_chars.alias("n_chars"),
        message.alias("message"),
        F.col("cleaned").alias("text"),
    )


def accepted(gated: DataFrame, key: str = "doc_id") -> DataFrame:
    """The cleaned documents themselves."""
    return gated.filter(F.col("status") == "success").select(key, "text")


def report(gated: DataFrame) -> DataFrame:
    """Number of documents and characters per status."""
    return gated.groupBy("status").agg(
        F.count("*").alias("n_docs"),
        F.sum(F.when(F.col("status") == "success", F.col("n_chars"))).alias("n_chars"),
    )


def rejected(gated: DataFrame, key: str = "doc_id") -> DataFrame:
    """The documents that did not pass, with the reason."""
    return gated.filter(F.col("status") != "success").select(key, "status", "message")
