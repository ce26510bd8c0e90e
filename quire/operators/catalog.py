"""Catalog questions: categories, reading-ease histogram, qualified books.

``ebooks`` is ``(book_id, lang, shelves, marc908)``. The curated categories are a list of names, or a
table with a column ``shelf`` of any size; they are joined, and Spark decides from their size how.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire import fixed_values as V
from quire.functions.catalog import (
    is_english,
    score,
    score_band,
)

Curated = Sequence[str] | DataFrame


def _shelves(df: DataFrame, curated: Curated) -> DataFrame:
    """Distinct curated ``(shelf, position)``."""
    if isinstance(curated, DataFrame):
        return curated.select("shelf").distinct().withColumn("position", F.lit(None).cast("int"))
    return _names(df, "shelf", list(dict.fromkeys(curated)))


def _names(df: DataFrame, column: str, names: Sequence[str]) -> DataFrame:
    rows = [(name, i) for i, name in enumerate(names)]
    return df.sparkSession.createDataFrame(rows, f"{column} string, position int")


def english(ebooks: DataFrame) -> DataFrame:
    return ebooks.filter(is_english(F.col("lang")))


def english_total(ebooks: DataFrame) -> DataFrame:
    return english(ebooks).agg(F.count("*").alias("n_books"))


def shelf_counts(ebooks: DataFrame) -> DataFrame:
    """Occurrences of every shelf among English books."""
    shelf = english(ebooks).select(F.explode("shelves").alias("shelf"))
    return shelf.groupBy("shelf").agg(F.count("*").alias("n"))


def by_name(shelves: DataFrame) -> DataFrame:
    """Report order: ignoring case, then exact."""
    return shelves.orderBy(F.lower("shelf"), "shelf")


def first_shelves(ebooks: DataFrame, k: int = V.FIRST_SHELVES) -> DataFrame:
    """The first ``k`` shelves in exact (case-sensitive) order."""
    return shelf_counts(ebooks).orderBy("shelf").limit(k)


def distinct_shelves(ebooks: DataFrame) -> DataFrame:
    return shelf_counts(ebooks).agg(F.count("*").alias("n_shelves"))


def _zero_filled(counts: DataFrame, column: str, wanted: DataFrame, value: str) -> DataFrame:
    """Every name with its count. Both sides have one row per name."""
    return wanted.join(counts, column, "left").select(
        column, "position", F.coalesce(value, F.lit(0)).alias(value)
    )


def on_curated_shelves(ebooks: DataFrame, curated: Curated) -> DataFrame:
    """Entries on a curated shelf, with only the curated ones among their shelves, each once."""
    kept = [c for c in ebooks.columns if c != "shelves"]
    rows = ebooks.withColumn("_row", F.monotonically_increasing_id())
    each = rows.select("_row", *kept, F.posexplode(F.array_distinct("shelves")).alias("_at", "shelf"))
    found = each.join(_shelves(ebooks, curated).select("shelf"), "shelf")
    # An entry has few shelves, so this brings no group together that is large.
    shelves = F.array_sort(F.collect_list(F.struct("_at", "shelf")))["shelf"].alias("shelves")
    return found.groupBy("_row", *kept).agg(shelves).select(*ebooks.columns)


def books_per_shelf(ebooks: DataFrame, curated: Curated = V.CURATED_SHELVES) -> DataFrame:
    """Distinct English books per curated shelf, also for shelves without any."""
    wanted = _shelves(ebooks, curated)
    counts = (
        english(ebooks)
        .select("book_id", F.explode("shelves").alias("shelf"))
        .join(wanted.select("shelf"), "shelf")
        .groupBy("shelf")
        .agg(F.count_distinct("book_id").alias("n_books"))
    )
    return _zero_filled(counts, "shelf", wanted, "n_books").drop("position")


def scored(ebooks: DataFrame, exact: bool = False) -> DataFrame:
    """Add ``score`` and ``band``."""
    return ebooks.withColumn("score", score(F.col("marc908"), exact)).withColumn(
        "band", score_band(F.col("score"))
    )


def score_histogram(ebooks: DataFrame, curated: Curated = V.CURATED_SHELVES) -> DataFrame:
    """Books per reading-ease band among English books on a curated shelf.

    All bands are listed; ``position`` is their order in a report.
    """
    chosen = on_curated_shelves(english(ebooks), curated)
    counts = scored(chosen).groupBy("band").agg(F.count("*").alias("n_books"))
    return _zero_filled(counts, "band", _names(ebooks, "band", V.ALL_BANDS), "n_books")


def qualified(
    ebooks: DataFrame,
    curated: Curated = V.CURATED_SHELVES,
    min_score: float = V.MIN_SCORE,
    exact: bool = False,
) -> DataFrame:
    """English books on a curated shelf that score above ``min_score``.

    Returns ``(book_id, shelves, score, band)`` with only the curated shelves.
    """
    return (
        scored(on_curated_shelves(english(ebooks), curated), exact)
        .filter(F.col("score") > min_score)
        .select("book_id", "shelves", "score", "band")
    )


def qualified_per_band(books: DataFrame) -> DataFrame:
    """Entries per band, and their total in the row without a band."""
    return books.rollup("band").agg(F.count("*").alias("n_books"))


def qualified_per_shelf(
    books: DataFrame, curated: Curated = V.CURATED_SHELVES
) -> DataFrame:
    """Distinct qualified books per curated shelf, also for shelves without any."""
    counts = (
        books.select("book_id", F.explode("shelves").alias("shelf"))
        .groupBy("shelf")
        .agg(F.count_distinct("book_id").alias("n_books"))
    )
    return _zero_filled(counts, "shelf", _shelves(books, curated), "n_books").drop("position")


def qualified_ids(books: DataFrame) -> DataFrame:
    return books.select("book_id").distinct()


def union_of_bands(books: DataFrame, bands: Sequence[str]) -> DataFrame:
    """Ids of the given bands, each once."""
    return qualified_ids(books.filter(F.col("band").isin(*bands)))


def top_ids(books: DataFrame, k: int = V.IDS_PER_BAND) -> DataFrame:
    """The first ``k`` ids of every band in numeric order; ids that are no numbers come last, as texts.

    Spark cuts each group to ``k`` rows before the shuffle, so a band with most of the
    books is no bottleneck.
    """
    order = Window.partitionBy("band").orderBy(
        F.col("book_id").try_cast("bigint").asc_nulls_last(), "book_id"
    )
    return (
        books.select("band", "book_id")
        .withColumn("position", F.row_number().over(order))
        .filter(F.col("position") <= k)
    )
