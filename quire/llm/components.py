"""Connected components of a distributed edge table.

Alternating large-star and small-star rounds: each is a minimum per node (combined before the
shuffle, so a hub with a third of all edges is one row per task) joined back to the edges. The
table never grows, links are never collected, and every round is a written table, so a lost
executor costs no more than the round it was in; a round's table goes when the next one is written. ``O(log n)`` rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.staging import drop, stage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))
    return both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` point from the larger to the smaller node."""
    low = edges.groupBy("a").agg(F.min("b").alias("low"))
    moved = edges.join(low, "a").filter("b != low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.unionByName(low.select("a", F.col("low").alias("b")))


def _state(edges: DataFrame) -> tuple:
    sums = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), sums).first())


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(id, component)`` for every node with an edge; ``component`` is its smallest node.

    ``edges`` is ``(a bigint, b bigint)`` in any direction. Null ends, self-links and repeats are
    ignored. No edges give no rows. The result reads a written table that ``drop`` removes.
    """
    oriented = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    oriented = oriented.filter("a is not null and b is not null and a != b")
    current = stage(oriented.distinct(), name)
    before = _state(current)
    while before[0]:
        last, current = current, stage(_small_star(_large_star(current).distinct()).distinct(), name)
        drop(last)
        after = _state(current)
        if after == before:
            break
        before = after
    roots = current.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    found = current.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)
    found.staged_path = current.staged_path
    return found
