"""Alignment of two tokenizers over the same bytes, and how common each link of two ids is.

Every text is encoded by a byte-level vocabulary (A, with a space before the text) and by a piece
vocabulary (B, which adds that space). Both give an increasing list of byte offsets where tokens end.
The shorter list of each document is searched in the longer one by galloping: from the place its rank
suggests, steps double until the wanted offset is passed, then the last step is halved. Offsets found are ends
in both: they cut the tokens into groups, and the differences of their ranks tell how many tokens of A and
of B overlap in each group. All searches of a batch run side by side in numpy.

A link is a token of A and one of B in the same group. A group of ``x`` and ``y`` tokens is never expanded
beyond its distinct ids, so a text without common ends but the last is no special case. Documents with their
distinct links are written once. In how many documents each link occurs is a distributed count; these counts
come back to the documents by ``join_counts``: common links by a broadcast of bounded size, all others by
a shuffle in which no link is common.

Defined cases: a null or empty text, and one that a tokenizer does not give back byte by byte, has no tokens:
zeros and an empty digest. Each row is a document of its own, whether its id repeats or is null. Other
columns are ignored; no rows give no rows. A text has to fit in a task.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.byte_tokens import plain_encoder
from quire.llm.counted_joins import SHARED_KEYS, join_counts
from quire.llm.packing import vocabulary
from quire.staging import stage

# Bytes of text that are aligned side by side, and pairs of a group that are listed one by one.
_SLICE_BYTES = 1 << 20
_LISTED_PAIRS = 1 << 12
LINK = "struct<a:int,b:int,n:bigint>"
ALIGNED = f"doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, links array<{LINK}>"


class _Table:
    """Byte strings by number, laid end to end, so that many are put together at once."""

    def __init__(self, strings: list[bytes]):
        self.sizes = np.array([len(s) for s in strings], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.content = np.frombuffer(b"".join(strings), np.uint8)

    def joined(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(bytes, end of each string in them)``."""
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes)
        shift = np.repeat(self.starts[numbers] - ends + sizes, sizes)
        return self.content[shift + np.arange(len(shift))], ends


class Tokenizers:
    """Both tokenizers, the bytes of their tokens, and the decimal ids as used in the digest."""

    def __init__(self, ranks: dict[bytes, int], pieces: bytes):
        import sentencepiece

        a, b = plain_encoder(ranks), sentencepiece.SentencePieceProcessor(model_proto=pieces)
        self.encode_a = lambda text: a(" " + text)
        self.encode_b = lambda text: np.array(b.encode(text), np.int64)
        bytes_a = [b""] * (max(ranks.values()) + 1)
        for token, number in ranks.items():
            bytes_a[number] = token
        bytes_b = [
            bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
            for i in range(b.get_piece_size())
        ]
        self.a, self.b = _Table(bytes_a), _Table(bytes_b)
        self.first_b = len(bytes_a)
        marked = [(n, last) for n, last in ((len(bytes_a), b"|"), (len(bytes_b), b";"))]
        # Two strings per id: as the last of its group, and before another.
        self.shown = _Table([str(i).encode() + end for n, last in marked for i in range(n) for end in (b",", last)])


_LOADED: dict[str, Tokenizers] = {}


def _loaded(name: str, definition) -> Tokenizers:
    if name not in _LOADED:
        _LOADED.clear()
        _LOADED[name] = Tokenizers(*definition.value)
    return _LOADED[name]


def gallop(wanted: np.ndarray, ends: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Place of each of ``wanted`` in the increasing ``ends``, or -1; ``at`` is where its search starts.

    The last of ``ends`` is not less than any of ``wanted``.
    """
    low, high, last = at.copy(), at.copy(), len(ends) - 1
    active, step = np.flatnonzero(ends[at] < wanted), 1
    while len(active):  # forward: ends[low] < wanted
        low[active] = high[active]
        high[active] = np.minimum(high[active] + step, last)
        active, step = active[ends[high[active]] < wanted[active]], step * 2
    active, step = np.flatnonzero(ends[at] >= wanted), 1
    while len(active):  # backward until ends[low] < wanted, or before the first
        high[active] = np.where(low[active] >= 0, low[active], high[active])
        low[active] = np.maximum(low[active] - step, -1)
        back = low[active]
        active, step = active[(back >= 0) & (ends[back] >= wanted[active])], step * 2
    while len(active := np.flatnonzero(high - low > 1)):
        middle = (low[active] + high[active]) >> 1
        less = ends[middle] < wanted[active]
        low[active[less]], high[active[~less]] = middle[less], middle[~less]
    return np.where(ends[high] == wanted, high, -1)


def _search(short: np.ndarray, long: np.ndarray, short_first, long_first, short_n, long_n) -> tuple[np.ndarray, np.ndarray]:
    """Places in both lists of the ends they have in common, for the chosen documents."""
    owner = np.repeat(np.arange(len(short_n)), short_n)
    rank = np.arange(len(owner)) - np.repeat(np.cumsum(short_n) - short_n, short_n)
    mine = short_first[owner] + rank
    found = gallop(short[mine], long, long_first[owner] + rank * long_n[owner] // short_n[owner])
    return mine[found >= 0], found[found >= 0]


def common_ends(ends_a: np.ndarray, ends_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the common ends in both lists, in order; documents lie end to end with the same bytes."""
    first_a, first_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    by_a = n_a <= n_b
    a1, b1 = _search(ends_a, ends_b, first_a[by_a], first_b[by_a], n_a[by_a], n_b[by_a])
    b2, a2 = _search(ends_b, ends_a, first_b[~by_a], first_a[~by_a], n_b[~by_a], n_a[~by_a])
    a = np.concatenate([a1, a2])
    order = np.argsort(a, kind="stable")
    return a[order], np.concatenate([b1, b2])[order]


def _group_pairs(a, b, x, y, first_a, first_b, owner):
    """``(owner, a, b, n)`` of the links of all groups, with repeats."""
    small = x * y <= _LISTED_PAIRS
    sizes = (x * y)[small]
    group = np.repeat(np.flatnonzero(small), sizes)
    at = np.arange(len(group)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    found = [(owner[group], a[first_a[group] + at // y[group]], b[first_b[group] + at % y[group]], np.ones(len(group), np.int64))]
    for g in np.flatnonzero(~small):
        ids_a, times_a = np.unique(a[first_a[g] : first_a[g] + x[g]], return_counts=True)
        ids_b, times_b = np.unique(b[first_b[g] : first_b[g] + y[g]], return_counts=True)
        each = len(ids_a) * len(ids_b)
        found.append((np.full(each, owner[g]), np.repeat(ids_a, len(ids_b)), np.tile(ids_b, len(ids_a)), np.outer(times_a, times_b).ravel()))
    return [np.concatenate(c) for c in zip(*found)]


def _links(owner, a, b, n, documents: int):
    """Distinct links per document, as an Arrow list."""
    codes = owner << 40 | a << 20 | b
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.empty(0, np.int64)
    distinct = codes[starts]
    sums = np.add.reduceat(n[order], starts) if len(starts) else np.empty(0, np.int64)
    bounds = np.searchsorted(distinct >> 40, np.arange(documents + 1)).astype(np.int32)
    fields = [pa.array((distinct >> 20 & 0xFFFFF).astype(np.int32)), pa.array((distinct & 0xFFFFF).astype(np.int32)), pa.array(sums)]
    return pa.ListArray.from_arrays(pa.array(bounds), pa.StructArray.from_arrays(fields, ["a", "b", "n"]))


def align(tokenizers: Tokenizers, texts: list[str | None]) -> list:
    """Columns ``n_a, n_b, n_groups, n_links, groups_sha256, links`` of the texts."""
    t, k = tokenizers, len(texts)
    n_a, n_b, ids_a, ids_b = np.zeros(k, np.int64), np.zeros(k, np.int64), [], []
    for i, text in enumerate(texts):
        if not text:
            continue
        content, both = b" " + text.encode(), []
        for encode, table in ((t.encode_a, t.a), (t.encode_b, t.b)):
            ids = encode(text)
            if table.joined(ids)[0].tobytes() != content:
                break
            both.append(ids)
        else:
            ids_a.append(both[0])
            ids_b.append(both[1])
            n_a[i], n_b[i] = len(both[0]), len(both[1])
    digests = [""] * k
    if not ids_a:
        zeros = pa.array(np.zeros(k, np.int64))
        none = np.empty(0, np.int64)
        return [zeros, zeros, zeros, zeros, pa.array(digests), _links(none, none, none, none, k)]
    a, b = np.concatenate(ids_a), np.concatenate(ids_b)
    ends_a, ends_b = np.cumsum(t.a.sizes[a]), np.cumsum(t.b.sizes[b])
    some = np.flatnonzero(n_a)
    last_a, last_b = common_ends(ends_a, ends_b, n_a[some], n_b[some])
    x, y = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
    owner = np.searchsorted(np.cumsum(n_a), last_a, side="right")
    groups = np.bincount(owner, minlength=k)
    links = np.zeros(k, np.int64)
    np.add.at(links, owner, x * y)

    # The digest's text: tokens of A, then of B, group by group.
    ends_group_a, ends_group_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    ends_group_a[last_a], ends_group_b[last_b] = 1, 1
    group_a, group_b = np.cumsum(ends_group_a) - ends_group_a, np.cumsum(ends_group_b) - ends_group_b
    merged = np.empty(len(a) + len(b), np.int64)
    merged[np.arange(len(a)) + (last_b - y + 1)[group_a]] = 2 * a + ends_group_a
    merged[np.arange(len(b)) + (last_a + 1)[group_b]] = 2 * (t.first_b + b) + ends_group_b
    shown, ends = t.shown.joined(merged)
    bounds = np.concatenate([[0], ends[np.cumsum((n_a + n_b)[some]) - 1]]).tolist()
    shown = shown.tobytes()
    for i, low, high in zip(some.tolist(), bounds, bounds[1:]):
        digests[i] = hashlib.sha256(shown[low : high - 1]).hexdigest()

    pairs = _group_pairs(a, b, x, y, last_a - x + 1, last_b - y + 1, owner)
    return [*map(pa.array, (n_a, n_b, groups, links)), pa.array(digests), _links(*pairs, k)]


def _slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    low = size = 0
    for i, text in enumerate(texts):
        if i > low and size + len(text or "") > _SLICE_BYTES:
            yield low, i
            low, size = i, 0
        size += len(text or "")
    if texts:
        yield low, len(texts)


def aligned_documents(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Written: counts, digest and distinct ``links`` of every row, and ``_row``."""
    with open(path_b, "rb") as file:
        definition = docs.sparkSession.sparkContext.broadcast((vocabulary(path_a), file.read()))
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = _loaded(name, definition)
        for batch in batches:
            texts = batch["text"].to_pylist()
            for low, high in _slices(texts):
                columns = [batch["doc_id"].slice(low, high - low), *align(tokenizers, texts[low:high])]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"])

    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stage(narrow.mapInArrow(run, ALIGNED).withColumn("_row", F.monotonically_increasing_id()), "aligned")


def link_counts(aligned: DataFrame) -> DataFrame:
    """Written ``(a, b, n_docs, is_best)``: documents per link, and whether no link of ``a`` has more."""
    counts = aligned.select(F.inline("links")).groupBy("a", "b").agg(F.count("*").alias("n_docs"))
    counts = stage(counts, "link-counts")
    most = counts.groupBy("a").agg(F.max("n_docs").alias("_most"))
    return stage(counts.join(most, "a").select("a", "b", "n_docs", (F.col("n_docs") == F.col("_most")).alias("is_best")), "best-links")


def alignment_rows(docs: DataFrame, path_a: str, path_b: str, shared: int = SHARED_KEYS) -> DataFrame:
    """A row per document: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``."""
    aligned = aligned_documents(docs, path_a, path_b)
    links = aligned.select("_row", F.inline("links"))
    found = join_counts(links, link_counts(aligned), ["a", "b"], "n_docs", shared)
    best = F.when(F.col("is_best"), F.col("n")).otherwise(F.lit(0))
    sums = found.groupBy("_row").agg(F.sum(best).alias("n_best"), F.sum(F.col("n") * F.col("n_docs")).alias("count_sum"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    rows = aligned.drop("links").join(sums, "_row", "left")
    return rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
