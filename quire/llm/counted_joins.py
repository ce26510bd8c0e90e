"""Joining rows to a table of counts without a hot key and without an unbounded broadcast.

``counts`` says for every key how much there is of it. Keys that hold more than one part in ``shared`` of
all there is are fewer than ``shared``, whatever the data: these are broadcast. Any other key has few rows,
so an ordinary shuffle join is even.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARED_KEYS = 500_000


def join_counts(rows: DataFrame, counts: DataFrame, keys: list[str], weight: str, shared: int = SHARED_KEYS) -> DataFrame:
    """Inner join of ``rows`` to ``counts``, which has every key once, no null key, and is a written table."""
    known = counts.agg(F.count("*").alias("n"), F.sum(F.col(weight).cast("decimal(38,0)")).alias("total")).first()
    if known.n <= shared:
        return rows.join(F.broadcast(counts), keys)
    is_hot = F.col(weight).cast("decimal(38,0)") * shared > F.lit(known.total)
    hot = counts.filter(is_hot)
    others = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    return rows.join(F.broadcast(hot), keys).unionByName(others.join(counts.filter(~is_hot), keys))
