"""Seeded train/validation split of exact size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.fixed_values import SEED, TRAIN_RATIO
from quire.operators.ranking import CELL_DIGITS, running_offsets, shuffle_key
from quire.staging import stage

TRAIN = "train"
VALIDATION = "val"
# A cell of the seeded order this small is fetched and sorted to find the cut.
_SMALL_CELL = 10_000
_HASH_DIGITS = 32


def train_size(n: int, ratio: float) -> int:
    """Double product, truncated."""
    return int(n * ratio)


def _order(seed: int, key: str, then_by: Sequence[str]) -> Column:
    """The seeded order as hash digits; a missing key is a key like any other."""
    first = shuffle_key(seed, key)
    return F.concat(first, shuffle_key(seed, *then_by)) if then_by else first


def _cut(order: DataFrame, digits: int, ratio: float) -> tuple[str, int, int] | None:
    """``(hash, taken, tied)``: the training rows are those before ``hash`` and ``taken`` of the ``tied`` rows with it.

    A selection, not a sort: count rows by the leading digits of their hash (at most 65,536
    groups), find the group with the cut, and look closer inside it only.
    """
    prefix, wanted, inside = "", None, None
    while inside is None or (inside > _SMALL_CELL and len(prefix) < digits):
        cell = F.substring("_h", 1, len(prefix) + CELL_DIGITS)
        counts = (
            order.filter(F.startswith("_h", F.lit(prefix)))
            .groupBy(cell.alias("cell"))
            .agg(F.count("*").alias("n"))
            .collect()
        )
        if wanted is None:
            wanted = train_size(sum(r.n for r in counts), ratio)
        if wanted == 0 and not prefix:
            return None
        for r in sorted(counts, key=lambda r: r.cell):
            if wanted <= r.n:
                prefix, inside = r.cell, r.n
                break
            wanted -= r.n
    members = order.filter(F.startswith("_h", F.lit(prefix))).groupBy("_h").agg(F.count("*").alias("n")).collect()
    for r in sorted(members, key=lambda r: r._h):
        if wanted <= r.n:
            return r._h, wanted, r.n
        wanted -= r.n


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` written, with ``_at`` from 0 in the order of the written table: counts per task, no shuffle."""
    marked = rows.select(F.struct(*rows.columns).alias("_row"), F.monotonically_increasing_id().alias("_id"))
    table = stage(marked, "tied-rows")
    task = F.shiftright("_id", 33)
    sizes = table.groupBy(task.alias("_task")).agg(F.count("*").alias("_n"))
    earlier = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_task", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_first"))
    placed = table.withColumn("_task", task).join(F.broadcast(starts), "_task")
    return placed.select("_row", (F.col("_first") + F.col("_id").bitwiseAND((1 << 33) - 1)).alias("_at"))


def exact_split(
    df: DataFrame, key: str = "doc_id", ratio: float = TRAIN_RATIO, seed: int = SEED, then_by: Sequence[str] = ()
) -> DataFrame:
    """``df`` with a ``split`` column: ``train`` for exactly ``int(n * ratio)`` rows.

    Only the key column is read to find the cut; documents are labelled where they are, without
    a shuffle. The result does not depend on the partitioning of ``df``. Store costly
    inputs first, since the key column is computed up to three times.

    Keys may repeat or be missing. Rows of one key follow each other in the order of a hash of
    ``then_by``. Only if the cut falls among rows that this order can not tell apart, these rows are written
    and numbered, and the first of them taken: equal rows, or any rows of one key without ``then_by``.
    """
    if not 0 < ratio < 1:
        raise ValueError(f"ratio must lie between 0 and 1, got {ratio}")
    h = _order(seed, key, then_by)
    digits = _HASH_DIGITS * (2 if then_by else 1)
    cut = _cut(df.select(h.alias("_h")), digits, ratio)
    if cut is None:
        return df.withColumn("split", F.lit(VALIDATION))
    last, taken, tied = cut
    label = lambda is_train: F.when(is_train, TRAIN).otherwise(VALIDATION).alias("split")
    if taken == tied:
        return df.select("*", label(h <= last))
    others = df.filter(h != last).select("*", label(h < last))
    return others.unionByName(_numbered(df.filter(h == last)).select("_row.*", label(F.col("_at") < taken)))


def split_sizes(split: DataFrame) -> DataFrame:
    return split.groupBy("split").agg(F.count("*").alias("n_docs"))


def attach_split(
    df: DataFrame, assignment: DataFrame, key: str = "doc_id", seed: int = SEED, then_by: Sequence[str] = ()
) -> DataFrame:
    """Join a stored ``(key, split)`` assignment, a row per document, back to documents.

    A missing key meets missing keys, and no document is repeated; one whose key was not assigned is left out. Of
    a key on both sides, which is at most one after ``exact_split``, as many documents are training
    documents as were assigned, in the order of the same ``seed`` and ``then_by``.
    """
    in_training = F.sum(F.when(F.col("split") == TRAIN, 1).otherwise(0))
    sides = assignment.groupBy(F.col(key).alias("_k")).agg(in_training.alias("_train"), F.count("*").alias("_n"))
    found = df.join(sides, df[key].eqNullSafe(sides["_k"])).drop("_k")
    whole = found.filter((F.col("_train") == 0) | (F.col("_train") == F.col("_n")))
    label = lambda is_train: F.when(is_train, TRAIN).otherwise(VALIDATION).alias("split")
    labelled = whole.select(*df.columns, label(F.col("_train") > 0))
    divided = sides.filter("_train > 0 and _train < _n")
    if divided.isEmpty():
        return labelled
    rows = df.join(divided, df[key].eqNullSafe(divided["_k"])).select(
        F.struct(*df.columns).alias("_row"), "_k", "_train", _order(seed, key, then_by).alias("_h")
    )
    # Rows that the hash does not tell apart are spread by where they lie.
    rows = rows.withColumn("_at", F.monotonically_increasing_id())
    placed = running_offsets(rows, [F.col("_h"), F.col("_at")], by="_k")
    return labelled.unionByName(placed.select("_row.*", label(F.col("offset") < F.col("_train"))))
