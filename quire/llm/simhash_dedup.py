"""Near-duplicate documents by SimHash, found with Golay-code fuzzy hashing.

The 64-bit fingerprint is cut into segments of 22, 21 and 21 bits. If two fingerprints differ in at
most two bits, one segment is equal, and the next one differs in at most two bits. The (23,12)
Golay code is perfect: a segment lies within distance 3 of one codeword, and two segments at most
two bits apart have a codeword within distance 4 in common, of which each has one or six. A key is
therefore an equal segment with one nearby codeword of the next: 3 to 18 keys of 34 bits, which
every linked pair shares at least once. Candidates of a key are joined and verified.

Fingerprints are made distinct first, so exact copies cost one row. A key with more than
``DENSE`` fingerprints is not expanded into pairs: its fingerprints are dealt by all fingerprints
at distance 0 or 1. Two that differ in at most two bits meet in such a ball, all of a ball are
linked, and a ball has at most 65 fingerprints, so a link to its smallest is enough. Both ways are
exact, and neither is quadratic in the size of a group.

Defined cases: a null or empty text has fingerprint zero and is linked like any other. Rows with a
null ``doc_id`` are linked too; a component is null if no row of it has a ``doc_id``. Repeated rows are
returned as often as they occur. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.components import components
from quire.staging import stage

SEED = 42
SHINGLE = 3
MAX_DISTANCE = 2
SEGMENTS = ((0, 22), (22, 21), (43, 21))
DENSE = 64
# Fixed value: generator polynomial of the (23,12) Golay code.
GOLAY = 0xC75
_BLOCK = 1 << 16
KEY = "struct<none:boolean,id:bigint,hash:bigint>"
# Rows are named to every task up to this many, and shuffled to the names beyond it.
MAX_SHARED_ROWS = 1_000_000


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned SimHash of the word shingles of a text."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths).tolist()
    ends = ends.tolist()[min(shingle, len(words)) - 1 :]
    digest, n = xxhash.xxh64_intdigest, len(ends)
    ones = np.zeros(64, np.int64)
    for low in range(0, n, _BLOCK):
        spans = zip(starts[low : low + _BLOCK], ends[low : low + _BLOCK])
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist())


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = [_signed(fingerprint(t.as_py())) for t in batch["text"]]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(values, pa.int64())], ["doc_id", "fp"])


def _fingerprinted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = [_signed(fingerprint(t.as_py())) for t in batch["text"]]
        yield pa.RecordBatch.from_arrays([batch["_key"], pa.array(values, pa.int64())], ["_key", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, fp)`` with the fingerprint as a signed number."""
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(_fingerprints, "doc_id bigint, fp bigint")


@lru_cache
def _golay() -> tuple[np.ndarray, np.ndarray]:
    """Syndrome of every single bit, and for every syndrome the error of weight 3 or less."""
    columns = []
    for i in range(23):
        value = 1 << i
        for bit in range(22, 10, -1):
            if value >> bit & 1:
                value ^= GOLAY << (bit - 11)
        columns.append(value)
    errors = np.zeros(2048, np.int64)
    for weight in (1, 2, 3):
        for bits in combinations(range(23), weight):
            errors[np.bitwise_xor.reduce([columns[b] for b in bits])] = sum(1 << b for b in bits)
    return np.array(columns, np.int64), errors


def codewords(segments: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(row, index)`` of all Golay codewords within distance 4 of each 23-bit segment."""
    columns, errors = _golay()
    syndrome = np.zeros(len(segments), np.int64)
    for i, column in enumerate(columns):
        syndrome ^= (segments >> i & 1) * column
    flips = np.concatenate([[0], 1 << np.arange(23)])
    steps = np.concatenate([[0], columns])
    near = (segments[:, None] ^ flips ^ errors[syndrome[:, None] ^ steps]) >> 11
    near.sort(axis=1)
    new = np.ones(near.shape, bool)
    new[:, 1:] = near[:, 1:] != near[:, :-1]
    rows, places = np.nonzero(new)
    return rows, near[rows, places]


def _cut(fp: np.ndarray, segment: int) -> np.ndarray:
    shift, width = SEGMENTS[segment]
    return (fp >> np.uint64(shift)).astype(np.int64) & ((1 << width) - 1)


def fuzzy_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(row, key)`` for unsigned fingerprints."""
    rows, keys = [], []
    for segment in range(len(SEGMENTS)):
        at, index = codewords(_cut(fp, (segment + 1) % len(SEGMENTS)))
        rows.append(at)
        keys.append(segment << 40 | _cut(fp, segment)[at] << 12 | index)
    return np.concatenate(rows), np.concatenate(keys)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, keys = fuzzy_keys(batch["fp"].to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
        at = pa.array(rows)
        yield pa.RecordBatch.from_arrays([pa.array(keys), batch["fp"].take(at)], ["key", "fp"])


def links(distinct: DataFrame) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints ``(fp)`` that connect all near pairs."""
    keyed = distinct.select("fp").mapInArrow(_keyed, "key bigint, fp bigint")
    counted = keyed.withColumn("n", F.count("*").over(Window.partitionBy("key"))).filter("n > 1")
    shared = stage(counted, "fuzzy-keys")
    few = shared.filter(F.col("n") <= DENSE)
    other = few.select("key", F.col("fp").alias("other"))
    differ = F.bit_count(F.col("fp").bitwiseXOR(F.col("other")))
    pairs = few.join(other, "key").filter((F.col("fp") > F.col("other")) & (differ <= MAX_DISTANCE))
    verified = pairs.select(F.col("fp").alias("a"), F.col("other").alias("b"))
    masks = F.array(F.lit(0).cast("bigint"), *[F.lit(_signed(1 << i)).cast("bigint") for i in range(64)])
    dense = shared.filter(F.col("n") > DENSE).select("fp").distinct()
    balls = dense.select("fp", F.explode(F.transform(masks, lambda m: F.col("fp").bitwiseXOR(m))).alias("ball"))
    nearest = balls.withColumn("low", F.min("fp").over(Window.partitionBy("ball")))
    stars = nearest.filter("fp > low").select(F.col("fp").alias("a"), F.col("low").alias("b"))
    return verified.unionByName(stars).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, fp, group, component_id)``, a row per document; ``group`` tells components apart."""
    marked = stage(fingerprints(docs), "fingerprints")
    distinct = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("rep")), "distinct-fingerprints")
    found = components(links(distinct)).withColumnRenamed("id", "fp")
    grouped = distinct.join(found, "fp", "left").select("fp", "rep", F.coalesce("component", "fp").alias("group"))
    grouped = stage(grouped, "grouped-fingerprints")
    smallest = grouped.groupBy("group").agg(F.min("rep").alias("component_id"))
    labels = grouped.select("fp", "group").join(smallest, "group")
    return marked.join(labels, "fp").select("doc_id", "fp", "group", "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest ``doc_id`` and, of its texts, the smallest hash.

    Rows are judged by their own text, also where an id has several. A missing id comes last. Of rows with equal
    id and text one stays, the smallest by all its columns.
    """
    text = F.col("text").cast("string")
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("id"), F.xxhash64(text).alias("hash"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*columns).alias("row"), key.alias("_key"))
    marked = docs.select(key.alias("_key"), text.alias("text")).mapInArrow(_fingerprinted, f"_key {KEY}, fp bigint")
    counted = stage(marked.groupBy("_key", "fp").agg(F.count("*").alias("n")), "row-fingerprints")
    distinct = stage(counted.groupBy("fp").agg(F.count("*").alias("n")), "distinct-fingerprints")
    found = components(links(distinct)).withColumnRenamed("id", "fp")
    group = F.coalesce("component", "fp")
    # The smallest row of each fingerprint first, so that the largest group is combined before it meets its component.
    least = counted.groupBy("fp").agg(F.min("_key").alias("_key"))
    kept = least.join(found, "fp", "left").groupBy(group).agg(F.min("_key").alias("_key"))
    kept = stage(kept.select("_key").join(counted, "_key").select("_key", "n"), "kept-rows")
    others = counted.select("_key").join(kept.select("_key"), "_key", "left_anti")
    repeated = kept.filter("n > 1").select("_key")
    listed = stage(others.unionByName(repeated), "listed-rows")
    few = listed.count() <= MAX_SHARED_ROWS
    once = rows.join(F.broadcast(listed) if few else listed, "_key", "left_anti").select("row.*")
    again = rows.join(F.broadcast(repeated) if few else repeated, "_key", "left_semi")
    return once.unionByName(again.groupBy("_key").agg(F.min("row").alias("row")).select("row.*"))


def component_rows(docs: DataFrame) -> DataFrame:
    """Rows of ``near_duplicates`` with the fingerprint as 16 hex digits."""
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return near_duplicates(docs).select("doc_id", hexed.alias("fingerprint"), "component_id")
