"""Packing: the ordered token stream of a split, cut into overlapping chunks.

Chunk ``c`` of a stream is ``[c * stride, c * stride + length)`` with
``stride = length - overlap``. Chunks cross document borders. What is left after the last full
chunk is kept when it is longer than half a chunk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.fixed_values import MAX_LENGTH, OVERLAP, TEXT_SUFFIX
from quire.operators.ranking import running_offsets
from quire.staging import stage


SEGMENT_CHUNKS = 8
# Segment offsets are handed to every task up to this many, and joined by shuffling beyond it.
MAX_SHARED_SEGMENTS = 500_000


def file_order(key: str = "doc_id") -> Column:
    """Order of documents in the stream: by file name, as text; a missing name comes first."""
    return F.concat(F.col(key).cast("string"), F.lit(TEXT_SUFFIX))


def _quotient(a: Column, b: int) -> Column:
    """Integer quotient of non-negative numbers."""
    return F.call_function("div", a.cast("bigint"), F.lit(b).cast("bigint"))


def last_chunk(total: Column, length: int, overlap: int, least_rest: int | None = None) -> Column:
    """Number of the last chunk of a stream of ``total`` tokens; -1 when there is none.

    A rest of ``least_rest`` tokens or fewer, half a chunk if not given, is no chunk.
    """
    least_rest = length // 2 if least_rest is None else least_rest
    stride = length - overlap
    full = F.when(total < length, F.lit(0)).otherwise(_quotient(total - length, stride) + 1)
    rest = total - full * stride
    return F.when(rest > least_rest, full).otherwise(full - 1)


def counted(tokens: DataFrame) -> DataFrame:
    return tokens.withColumn("n_tokens", F.size("tokens").cast("bigint"))


def offsets(sizes: DataFrame, by: str = "split", key: str = "doc_id") -> DataFrame:
    """``(by, key, n_tokens, offset, total)`` for ``(by, key, n_tokens)``."""
    narrow = sizes.select(by, key, "n_tokens", file_order(key).alias("_order"))
    return running_offsets(narrow, [F.col("_order")], weight="n_tokens", by=by).drop("_order")


def segments(tokens: DataFrame, size: int) -> DataFrame:
    """Cut token arrays into rows of at most ``size`` tokens: adds ``segment`` and ``n_tokens``.

    Bounds the size of a row, so that a very long document is spread over tasks like many short
    ones, and a batch of rows fits in memory.
    """
    kept = [c for c in tokens.columns if c != "tokens"]
    last = F.floor((F.size("tokens") - 1) / size).cast("int")
    cut = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.struct(i.alias("segment"), F.slice("tokens", i * size + 1, F.lit(size)).alias("tokens")),
    )
    # No filter for empty arrays: Spark would run the tokenizer a second time for it.
    return counted(tokens.select(*kept, F.inline(F.when(F.size("tokens") > 0, cut))))


def pack(
    tokens: DataFrame,
    max_length: int = MAX_LENGTH,
    overlap: int = OVERLAP,
    by: str = "split",
    key: str = "doc_id",
    then_by: Sequence[str] = (),
    least_rest: int | None = None,
) -> DataFrame:
    """Pack ``(by, key, tokens)`` into ``(by, chunk_id, input_ids)``.

    Every row is a document of its own: keys may repeat or be missing. Rows of one key follow each
    other in the order of ``then_by``, else of the written table.

    The tokens are written once, in segments of at most ``SEGMENT_CHUNKS`` chunks. Stream offsets
    come from the narrow columns alone and are written too. Where there are few, they go to the
    segments; else the token arrays are moved to meet them. A chunk that lies within one segment is cut
    where it is, and written nowhere in between. Only the pieces around segment borders, which a second
    look at the written table cuts, are moved and put together; such a group has at most ``max_length``
    tokens, so none is hot.
    """
    if not 0 <= overlap < max_length:
        raise ValueError(f"need 0 <= overlap < max_length, got {overlap} and {max_length}")
    stride = max_length - overlap
    rows = tokens.select(by, key, *then_by, F.monotonically_increasing_id().alias("_row"), "tokens")
    table = stage(segments(rows, SEGMENT_CHUNKS * max_length), "tokens")
    narrow = table.select(by, "_row", "segment", "n_tokens", file_order(key).alias("_order"), *then_by)
    order = [F.col(c) for c in ("_order", *then_by, "_row", "segment")]
    starts = running_offsets(narrow, order, weight="n_tokens", by=by)
    starts = stage(starts.select("_row", "segment", "n_tokens", "offset", "total"), "offsets")

    start, end = F.col("offset"), F.col("offset") + F.col("n_tokens")
    touching = F.when(start < max_length, F.lit(0)).otherwise(_quotient(start - max_length, stride) + 1)
    last = F.least(_quotient(end - 1, stride), last_chunk(F.col("total"), max_length, overlap, least_rest))
    few = starts.count() <= MAX_SHARED_SEGMENTS
    placed = table.drop("n_tokens").join(F.broadcast(starts) if few else starts, ["_row", "segment"])
    placed = placed.withColumns({"_first": touching.cast("bigint"), "_last": last.cast("bigint")})
    if not few:
        placed = stage(placed, "placed")  # moved once, looked at twice

    def is_whole(chunk: Column) -> Column:
        # No other segment has a token of this chunk.
        return (start <= chunk * stride) & (F.least(chunk * stride + max_length, F.col("total")) <= end)

    def piece(chunk: Column) -> Column:
        low = F.greatest(start, chunk * stride)
        high = F.least(end, chunk * stride + max_length)
        part = F.slice("tokens", (low - start + 1).cast("int"), (high - low).cast("int"))
        return F.struct(chunk.alias("chunk_id"), low.alias("low"), part.alias("part"))

    def pieces(wanted) -> DataFrame:
        # Built inside one expression: exploding chunk numbers beside the token array would copy the
        # whole array once per chunk.
        chunks = F.when(F.col("_first") <= F.col("_last"), F.sequence("_first", "_last"))
        return placed.select(by, F.inline(F.transform(F.filter(chunks, wanted), piece)))

    parts = F.array_sort(F.collect_list(F.struct("low", "part")))
    joined = (
        pieces(lambda c: ~is_whole(c))
        .groupBy(by, "chunk_id")
        .agg(parts.alias("_parts"))
        .select(by, "chunk_id", F.flatten(F.col("_parts.part")).alias("input_ids"))
    )
    return pieces(is_whole).select(by, "chunk_id", F.col("part").alias("input_ids")).unionByName(joined)


def with_labels(packed: DataFrame) -> DataFrame:
    """Labels for next-token training are a copy of the input."""
    return packed.withColumn("labels", F.col("input_ids"))


def packing_report(stories: DataFrame, packed: DataFrame, by: str = "split") -> DataFrame:
    """Documents, chunks and packed tokens per split."""
    documents = stories.groupBy(by).agg(F.count("*").alias("n_docs"))
    chunks = packed.groupBy(by).agg(
        F.count("*").alias("n_chunks"), F.sum(F.size("input_ids").cast("bigint")).alias("n_tokens")
    )
    return documents.join(chunks, by, "left").fillna(0, ["n_chunks", "n_tokens"])
