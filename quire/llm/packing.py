"""Best-two-fit packing of documents into fixed token sequences.

1. Every document is tokenized once, where it lies, ended with the end id and cut into pieces of
   at most ``capacity`` tokens (only longer documents are cut; their first piece takes the
   remainder). The pieces are a written table.
2. A sequence is filled greedily, largest piece first. Then its smallest piece is replaced by two
   unpacked pieces if they fill the widened gap more tightly.

Only the number of pieces per length matters for step 2, and there are at most ``capacity``
lengths, so the plan is made from that histogram: a sequence is planned once and repeated until
one of its lengths runs out, which is what packing piece by piece gives. The histogram and the
plan have a bounded size at every scale. Pieces then meet the plan by their rank among pieces of
equal length; ranks come from counts per task, not from a sort.

Defined cases: a null or empty text is the end id alone; repeated rows are packed as often as
they occur; no rows give no pieces; other columns are ignored. A document has to fit in a task.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.staging import stage

CAPACITY = 1024
END_ID = 2
PIECES = (
    "doc_id bigint, piece int, start bigint, length bigint, ids array<int>, _task int, _at bigint"
)
# How the byte-level vocabulary cuts text into words (a property of the public tokenizer).
WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary file."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


def vocabulary(path: str) -> dict[bytes, int]:
    """Byte strings and ids of a byte-level vocabulary file, without its special tokens."""
    with open(path, encoding="utf-8") as file:
        definition = json.load(file)
    special = {t["content"] for t in definition["added_tokens"]}
    symbols = byte_symbols()
    return {
        bytes(symbols[c] for c in token): i
        for token, i in definition["model"]["vocab"].items()
        if token not in special
    }


def added_tokens(path: str) -> dict[str, int]:
    """Tokens that the file adds to the vocabulary; in a text they stand for themselves."""
    with open(path, encoding="utf-8") as file:
        return {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}


_MODELS: dict[str, object] = {}


def _model(name: str, known):
    """One encoder per worker process."""
    import tiktoken

    if name not in _MODELS:
        ranks, added = known.value
        _MODELS[name] = tiktoken.Encoding(name, pat_str=WORDS, mergeable_ranks=ranks, special_tokens=added)
    return _MODELS[name]


def piece_bounds(n: int, capacity: int) -> list[int]:
    """Where ``n`` tokens are cut: ``[0, first end, ..., n]``."""
    first = n % capacity or capacity
    return [0, *range(min(first, n), n + 1, capacity)]


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``(doc_id, piece, start, length, ids)``, written, with the place of each row in its task."""
    known, name = docs.sparkSession.sparkContext.broadcast((vocabulary(path), added_tokens(path))), uuid.uuid4().hex

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = _model(name, known).encode_to_numpy, TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        end = np.array([end_id], np.int32)
        for whole in batches:
            for low in range(0, whole.num_rows, 256):
                batch = whole.slice(low, 256)
                rows, flat, bounds = [], [], [0]
                for key, text in zip(batch[0].to_pylist(), batch[1].to_pylist()):
                    ids = np.append(encode(text or "", allowed_special="all").astype(np.int32), end)
                    cuts = piece_bounds(len(ids), capacity)
                    flat.append(ids)
                    for number, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        rows.append((key, number, a, b - a, seen[b - a]))
                        seen[b - a] += 1
                        bounds.append(bounds[-1] + b - a)
                if not rows:
                    continue
                keys, numbers, starts, lengths, at = zip(*rows)
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(np.concatenate(flat)))
                columns = [
                    pa.array(keys, pa.int64()), pa.array(numbers, pa.int32()), pa.array(starts, pa.int64()),
                    pa.array(lengths, pa.int64()), lists, pa.array([task] * len(rows), pa.int32()),
                    pa.array(at, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids", "_task", "_at"])

    narrow = docs.select(F.col("doc_id").cast("bigint"), "text")
    return stage(narrow.mapInArrow(cut, PIECES), "pieces")


def best_two_fit(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Sequences as ``(lengths, how often)`` that use up ``counts`` (length -> pieces)."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    plan = []
    while left.any():
        free, room, taken = left.copy(), capacity, []
        while room and (fits := np.flatnonzero(free[: room + 1])).size:
            taken.append(int(fits[-1]))
            free[taken[-1]] -= 1
            room -= taken[-1]
        pair = _tighter_pair(free, room + taken[-1], taken[-1]) if room else None
        if pair:
            taken[-1:] = pair
        sizes, needed = np.unique(taken, return_counts=True)
        copies = int((left[sizes] // needed).min())
        left[sizes] -= copies * needed
        plan.append((taken, copies))
    return plan


def _tighter_pair(free: np.ndarray, gap: int, smallest: int) -> tuple[int, int] | None:
    """The two free lengths with the largest sum in ``(smallest, gap]``."""
    for total in range(gap, smallest, -1):
        below = free[1:total] > 0
        both = below & below[::-1]
        if total % 2 == 0 and free[total // 2] < 2:
            both[total // 2 - 1] = False
        if both.any():
            a = int(np.flatnonzero(both)[-1]) + 1
            return a, total - a
    return None


def slots(plan: list[tuple[list[int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """The plan by rank: ``(length, first rank, end rank, per sequence, first sequence, offset)``."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for lengths, copies in plan:
        offset = 0
        for length in sorted(set(lengths), reverse=True):
            each = lengths.count(length)
            low = used.get(length, 0)
            used[length] = low + each * copies
            rows.append((length, low, used[length], each, sequence, offset))
            offset += each * length
        sequence += copies
    return rows


def place(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Rows of ``pieces`` (any columns besides its own) with ``sequence_id`` and ``offset``."""
    spark = cut.sparkSession
    per_task = cut.groupBy("length", "_task").agg(F.count("*").alias("_n"))
    histogram = per_task.groupBy("length").agg(F.sum("_n").alias("n")).collect()  # at most capacity rows
    plan = best_two_fit({r.length: r.n for r in histogram}, capacity)
    fields = "length bigint, _low bigint, _high bigint, _each bigint, _sequence bigint, _offset bigint"
    table = spark.createDataFrame(slots(plan), fields)
    earlier = Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_task.select("length", "_task", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_first"))
    ranked = cut.join(starts, ["length", "_task"]).withColumn("_rank", F.col("_first") + F.col("_at"))
    within = F.col("_rank") - F.col("_low")
    found = ranked.join(F.broadcast(table), "length").filter("_rank >= _low and _rank < _high")
    kept = [c for c in cut.columns if c not in ("_task", "_at")]
    return found.select(
        *kept,
        (F.col("_sequence") + F.floor(within / F.col("_each"))).alias("sequence_id"),
        (F.col("_offset") + F.pmod(within, F.col("_each")) * F.col("length")).alias("offset"),
    )


def sequences(placed: DataFrame) -> DataFrame:
    """``(sequence_id, input_ids, doc_ids, lengths)``: the packed sequences themselves."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "length", "ids")))
    whole = placed.groupBy("sequence_id").agg(parts.alias("_p"))
    return whole.select(
        "sequence_id",
        F.flatten("_p.ids").alias("input_ids"),
        F.col("_p.doc_id").alias("doc_ids"),
        F.col("_p.length").alias("lengths"),
    )


@F.arrow_udf(T.LongType())
def _crc32(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    from zlib import crc32

    for lists in batches:
        flat = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
        bounds = lists.offsets.to_numpy().tolist()
        yield pa.array([crc32(flat[a:b]) for a, b in zip(bounds, bounds[1:])], pa.int64())


def ids_crc32(ids: Column) -> Column:
    """CRC-32 of the ids as little-endian unsigned 32-bit numbers."""
    return _crc32(ids)


def packed_pieces(docs: DataFrame, path: str) -> DataFrame:
    """One row per piece with a digest of its ids and its place."""
    cut = pieces(docs, path)
    digested = cut.select("doc_id", "piece", "start", "length", ids_crc32(F.col("ids")).alias("ids_crc32"), "_task", "_at")
    return place(digested)
