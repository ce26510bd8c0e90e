"""Shards of near-equal bytes by Karmarkar-Karp differencing.

Rows with equal texts are one indivisible group. A partial partition is a vector of ``shards``
sums, at first one group's size and zeros. The two with the largest spread are combined, the
largest sums of one with the smallest of the other, until one is left.

At scale this is done level by level. Groups are dealt into cells of about ``CELL`` by their
digest, and each cell is differenced in a task. A differenced cell is again a partial
partition, so cells are dealt into cells of the next level, until one is left. A group's shard is
its slot followed through the levels. No task holds more than a few thousand vectors, and the
driver sees counts only.

Defined cases: null texts are one group of size 1 per row with CRC 0; an empty text is another
group. No rows give no rows. Repeated rows stay together. Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators.ranking import seeded_rank
from quire.staging import stage

SHARDS = 8
CELL = 4096
SEED = 17


def differencing(vectors: list[list[int]]) -> list[list[int]]:
    """For each vector of sums, the slot of the combined vector that each of its sums went to."""
    shards = len(vectors[0])
    order = [sorted(range(shards), key=lambda s: -v[s]) for v in vectors]
    sums = [[v[s] for s in o] for v, o in zip(vectors, order)]
    heap = [(s[-1] - s[0], i) for i, s in enumerate(sums)]
    heapq.heapify(heap)
    joined: list[tuple[int, int, list[int], list[int]]] = []
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        added = [x + y for x, y in zip(sums[a], reversed(sums[b]))]
        slots = sorted(range(shards), key=lambda s: -added[s])
        joined.append((a, b, slots, [shards - 1 - s for s in slots]))
        sums.append([added[s] for s in slots])
        heapq.heappush(heap, (sums[-1][-1] - sums[-1][0], len(sums) - 1))
    goes: dict[int, list[int]] = {heap[0][1]: list(range(shards))}
    for at in range(len(joined) - 1, -1, -1):
        a, b, of_a, of_b = joined[at]
        mine = goes.pop(len(vectors) + at)
        for child, slots in ((a, of_a), (b, of_b)):
            to = [0] * shards
            for slot, target in zip(slots, mine):
                to[slot] = target
            goes[child] = to
    result = []
    for i, o in enumerate(order):
        to = [0] * shards
        for sorted_slot, original in enumerate(o):
            to[original] = goes[i][sorted_slot]
        result.append(to)
    return result


def _difference_cell(table: pa.Table) -> pa.Table:
    table = table.sort_by([("id", "ascending")])
    slots = differencing(table["sums"].to_pylist())
    return pa.table({"id": table["id"], "cell": table["cell"], "slots": pa.array(slots, pa.list_(pa.int32())), "sums": table["sums"]})


def _level(items: DataFrame, n: int, level: int) -> tuple[DataFrame, DataFrame, int]:
    """Difference ``(id, sums)`` by cells: ``(id, cell, slots)``, the cells as items, their number."""
    cells = max(1, -(-n // CELL))
    dealt = items.withColumn("cell", F.pmod(F.xxhash64(F.lit(level), "id"), F.lit(cells)).cast("string"))
    done = stage(
        dealt.groupBy("cell").applyInArrow(_difference_cell, "id string, cell string, slots array<int>, sums array<bigint>"),
        "differenced",
    )
    each = done.select("cell", F.posexplode("slots").alias("_from", "_to"), "sums")
    added = each.groupBy("cell", "_to").agg(F.sum(F.element_at("sums", F.col("_from") + 1)).alias("_sum"))
    sums = F.array_sort(F.collect_list(F.struct("_to", "_sum")))["_sum"]
    return done.select("id", "cell", "slots"), added.groupBy("cell").agg(sums.alias("sums")).withColumnRenamed("cell", "id"), cells


def balanced(groups: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``(id, shard)`` for distinct ``(id string, size bigint)``."""
    n = groups.count()
    if not n:
        return groups.select("id", F.lit(0).alias("shard"))
    zeros = F.array_repeat(F.lit(0).cast("bigint"), shards - 1)
    items = groups.select("id", F.concat(F.array(F.col("size").cast("bigint")), zeros).alias("sums"))
    levels = []
    while not levels or n > 1:
        slots, items, n = _level(items, n, len(levels))
        levels.append(slots)
    found = levels[0].select("id", "cell", F.element_at("slots", 1).alias("shard"))
    for upper in levels[1:]:
        upper = upper.select(F.col("id").alias("cell"), F.col("cell").alias("_upper"), "slots")
        found = found.join(upper, "cell").select(
            "id", F.col("_upper").alias("cell"), F.element_at("slots", F.col("shard") + 1).alias("shard")
        )
    return found.select("id", "shard")


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``(doc_id, size, text_crc32, shard, slot)``; ``slot`` has no gaps within a shard."""
    text = F.col("text")
    rows = stage(
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint").alias("size"),
            F.coalesce(F.crc32(text), F.lit(0)).alias("text_crc32"),
            F.coalesce(F.sha2(text, 256), F.lit("null")).alias("_group"),
        ),
        "sizes",
    )
    groups = rows.groupBy("_group").agg(F.sum("size").alias("size")).withColumnRenamed("_group", "id")
    shard = balanced(stage(groups, "groups"), shards).withColumnRenamed("id", "_group")
    placed = stage(rows.join(shard, "_group").drop("_group"), "sharded")
    return seeded_rank(placed, ["doc_id"], "shard", SEED, "slot").drop("total")


def sharded_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``shard_by_bytes`` with the law they follow."""
    return shard_by_bytes(docs).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
