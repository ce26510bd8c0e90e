"""Acquisition as tables: candidate addresses, resume, first valid result, report.

Fetching itself is done outside Spark; its results come in as a table.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire import fixed_values as V
from quire.staging import stage

TEXT = "text"
ZIP = "zip"
#: Places of winning rows that are sent to every task at once.
SHARED_PLACES = 200_000


def candidates(
    ids: DataFrame,
    texts: Sequence[str] = V.TEXT_ADDRESSES,
    zips: Sequence[str] = V.ZIP_ADDRESSES,
) -> DataFrame:
    """Every address to try for every id: ``(book_id, priority, kind, url)``.

    The templates are a fixed short list, so they are laid out per row without a join.
    """
    kinds = [(TEXT, t) for t in texts] + [(ZIP, t) for t in zips]
    options = F.array(
        *[
            F.struct(
                F.lit(i).alias("priority"),
                F.lit(kind).alias("kind"),
                F.replace(F.lit(template), F.lit("{id}"), F.col("book_id")).alias("url"),
            )
            for i, (kind, template) in enumerate(kinds)
        ]
    )
    return ids.select("book_id", F.inline(options))


def resume(ids: DataFrame, existing: DataFrame) -> DataFrame:
    """Ids that are not there yet."""
    return ids.join(existing.select("book_id"), "book_id", "left_anti")


def valid(fetched: DataFrame, marker: str = V.VALIDITY_MARK) -> DataFrame:
    """Results with status 200 whose text holds the marker; of ZIP members only text files."""
    readable = (F.col("kind") == TEXT) | F.endswith(F.lower("member"), F.lit(V.TEXT_SUFFIX))
    return fetched.filter(
        (F.col("status") == V.HTTP_OK) & readable & F.contains("body", F.lit(marker))
    )


def _order() -> Column:
    return F.struct((F.col("kind") != TEXT).cast("int"), "priority", F.coalesce("member_idx", F.lit(0)))


def first_valid(fetched: DataFrame, marker: str = V.VALIDITY_MARK) -> DataFrame:
    """Per id the valid result that comes first: texts, then ZIPs, then member order.

    ``fetched`` is ``(book_id, kind, priority, member_idx, member, status, body)``.
    Tasks keep one body per id before the shuffle. ``first_valid_stored`` moves no body at all.
    """
    best = F.min_by(F.struct("kind", "priority", "member_idx", "body"), _order())
    return (
        valid(fetched, marker)
        .groupBy("book_id")
        .agg(best.alias("best"))
        .select("book_id", "best.*")
    )


def winners(fetched: DataFrame, marker: str = V.VALIDITY_MARK) -> DataFrame:
    """``(book_id, file, at)``: where the first valid result of each id lies in a Parquet table.

    Of results that are equal in order the one that lies first is taken.
    """
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    placed = valid(fetched.select("*", place.alias("place")), marker)
    narrow = placed.select("book_id", _order().alias("rank"), "place")
    return narrow.groupBy("book_id").agg(F.min(F.struct("rank", "place")).alias("best")).select("book_id", "best.place.*")


def _file_ranges(places: DataFrame, most: int) -> Iterator[tuple[str, str, int]]:
    """``(first, last, places)`` of runs of files; a run has at most ``most`` places unless it is one file."""
    first = last = None
    held = 0
    for row in places.groupBy("file").count().orderBy("file").toLocalIterator():
        if first is not None and held + row["count"] > most:
            yield first, last, held
            first, held = None, 0
        first, last, held = first or row.file, row.file, held + row["count"]
    if first is not None:
        yield first, last, held


def first_valid_stored(
    spark: SparkSession, path: str, marker: str = V.VALIDITY_MARK, shared: int = SHARED_PLACES
) -> DataFrame:
    """``first_valid`` of a Parquet table of results: bodies are read where they lie and never shuffled.

    The first pass finds the place (file and row) of each id's result; only ids and places are
    shuffled. The second reads the files again, run of files by run, and keeps the rows at these places. Each file
    belongs to one run, files without a winner are not opened, and a run's places are few enough to be sent to every
    task. A single file with more than ``shared`` places is joined as Spark's own size checks decide.
    """
    fetched = spark.read.parquet(path)
    places = stage(winners(fetched, marker), "winners")
    file = F.col("_metadata.file_path")
    rows = fetched.select(
        "book_id", "kind", "priority", "member_idx", "body", file.alias("file"), F.col("_metadata.row_index").alias("at")
    )
    parts = []
    for first, last, held in _file_ranges(places, shared):
        here = places.filter(F.col("file").between(first, last)).select("file", "at")
        known = F.broadcast(here) if held <= shared else here
        parts.append(rows.filter(F.col("file").between(first, last)).join(known, ["file", "at"], "left_semi"))
    found = reduce(DataFrame.unionByName, parts) if parts else rows.limit(0)
    return found.drop("file", "at")


def failures(requested: DataFrame, resolved: DataFrame) -> DataFrame:
    """Requested ids without a valid result."""
    return requested.join(resolved.select("book_id"), "book_id", "left_anti").select("book_id")


def report(requested: DataFrame, resolved: DataFrame) -> DataFrame:
    """Ids per outcome: ``downloaded`` or ``failed``."""
    got = resolved.select("book_id", F.lit(True).alias("_got"))
    outcome = F.when(F.col("_got"), "downloaded").otherwise("failed")
    return (
        requested.join(got, "book_id", "left")
        .groupBy(outcome.alias("outcome"))
        .agg(F.count("*").alias("n_ids"))
    )
