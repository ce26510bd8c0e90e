"""Benchmark decontamination with a generalised suffix automaton.

The automaton holds the word sequences of all test items of a block. A document's words are
streamed through it, and the state and the longest matching length are tracked. Where the length
reaches the window (10 words, or a whole shorter item), the words of the window are hit and the
items of the window's state are noted. Words are mapped to ids first; only runs in which every pair
of neighbours occurs in some item can hold a match of two words or more, so only those are streamed.

Items are cut into blocks of about ``BLOCK_WORDS`` words; one block's automaton is broadcast at a
time, so its size is bounded whatever the benchmark's size. Documents pass all blocks where they
lie: no shuffle, and no document is compared with items one by one.

``decontaminate`` removes a document if hits cover more than ``max_coverage`` of its words, and else
cuts every hit span out, again until no window is left.

Defined cases: null or empty texts have no words and no hits. Items without words match nothing;
items with a null id are ignored; items with equal ids count once. Repeated documents are
treated alike. No items give no hits, no documents no rows.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.operators.ranking import running_offsets
from quire.staging import stage

WINDOW = 10
MAX_COVERAGE = 0.5
BLOCK_WORDS = 200_000

# Letters (A-Z lowered), digits and all bytes of non-ASCII characters stay, the rest is a space.
_WORD_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()
_WORD = re.compile(rb"[^ ]+")
SPANS = "array<struct<first:bigint,last:bigint>>"


def normalised_words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_WORD_BYTES).split()


class _Ids(dict):
    """Word ids; -1 for words of no item."""

    def __missing__(self, word):
        return -1


class ItemAutomaton:
    """Generalised suffix automaton of the items' word ids."""

    def __init__(self, items: list[tuple[int, str]], window: int = WINDOW):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ids, pairs, sequences = _Ids(), set(), []
        for item, text in items:
            sequence = [self.ids.setdefault(w, len(self.ids)) for w in normalised_words(text)]
            if sequence:
                sequences.append((item, sequence))
                pairs.update(zip(sequence, sequence[1:]))
                last = 0
                for word in sequence:
                    last = self._extend(last, word)
        self.pairs = np.array(sorted(a << 32 | b for a, b in pairs), np.int64)
        self.shortest = min([window, *(len(s) for _, s in sequences)])
        # state -> items of its windows; state -> [(length, item)] of whole shorter items
        self.items: dict[int, set[int]] = {}
        self.short: dict[int, list[tuple[int, int]]] = {}
        for item, sequence in sequences:
            state = 0
            for i, word in enumerate(sequence):
                state = self.next[state][word]
                if i + 1 >= window:
                    self.items.setdefault(self._cut(state, window), set()).add(item)
            if len(sequence) < window:
                self.short.setdefault(self._cut(state, len(sequence)), []).append((len(sequence), item))
        # nearest state on the suffix path, itself included, with a shorter item
        self.nearest_short = [-1] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            self.nearest_short[state] = state if state in self.short else self.nearest_short[self.link[state]]

    def _extend(self, last: int, word: int) -> int:
        known = self.next[last].get(word)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._clone(last, word, known)
        state = self._add({}, self.length[last] + 1, 0)
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = state
            at = self.link[at]
        if at >= 0:
            to = self.next[at][word]
            self.link[state] = to if self.length[to] == self.length[at] + 1 else self._clone(at, word, to)
        return state

    def _add(self, arcs: dict[int, int], length: int, link: int) -> int:
        self.next.append(arcs)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _clone(self, at: int, word: int, to: int) -> int:
        copy = self._add(dict(self.next[to]), self.length[at] + 1, self.link[to])
        self.link[to] = copy
        while at >= 0 and self.next[at].get(word) == to:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def _cut(self, state: int, length: int) -> int:
        """State of the last ``length`` words of a match in ``state``."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def stream(self, words: list[int], first: int, hits: list[tuple[int, int]], found: set[int]) -> None:
        """Add hit spans ``[first, last]`` and items of one run of words that starts at ``first``."""
        state = length = 0
        for at, word in enumerate(words, first):
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word not in self.next[state]:
                continue
            state, length = self.next[state][word], length + 1
            if length >= self.window:
                hits.append((at - self.window + 1, at))
                found |= self.items[self._cut(state, self.window)]
            short = self.nearest_short[state]
            while short > 0:
                for size, item in self.short[short]:
                    if size <= length:
                        hits.append((at - size + 1, at))
                        found.add(item)
                short = self.nearest_short[self.link[short]] if self.link[short] > 0 else -1

    def runs(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """``[first, end)`` of the runs that can hold a match; ids of several texts may be apart by -1."""
        known = ids >= 0
        codes = ids[:-1].astype(np.int64) << 32 | ids[1:]
        both = np.flatnonzero(known[:-1] & known[1:])
        joined = np.zeros(max(len(ids) - 1, 0), bool)
        if len(both) and len(self.pairs):
            place = np.minimum(np.searchsorted(self.pairs, codes[both]), len(self.pairs) - 1)
            joined[both] = self.pairs[place] == codes[both]
        start = known.copy()
        start[1:] &= ~joined
        end = known.copy()
        end[:-1] &= ~joined
        first, last = np.flatnonzero(start), np.flatnonzero(end) + 1
        long = last - first >= self.shortest
        return list(zip(first[long].tolist(), last[long].tolist()))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans as one."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1] + 1:
            out[-1] = out[-1][0], max(last, out[-1][1])
        else:
            out.append((first, last))
    return out


def scan(automaton: ItemAutomaton, texts: list[str | None]) -> list[tuple[int, list[tuple[int, int]], set[int]]]:
    """For each text: number of words, hit spans, items."""
    words = [normalised_words(t) for t in texts]
    starts = np.cumsum([0, *(len(w) + 1 for w in words)])
    ids = np.full(starts[-1], -1, np.int32)
    for at, own in zip(starts.tolist(), words):
        ids[at : at + len(own)] = np.fromiter(map(automaton.ids.__getitem__, own), np.int32, len(own))
    results = [(len(w), [], set()) for w in words]
    for first, end in automaton.runs(ids):
        number = int(np.searchsorted(starts, first, side="right")) - 1
        _, hits, found = results[number]
        automaton.stream(ids[first:end].tolist(), first - int(starts[number]), hits, found)
    return [(n, merged(hits), found) for n, hits, found in results]


_AUTOMATA: dict[str, ItemAutomaton] = {}


def _automaton(name: str, items, window: int) -> ItemAutomaton:
    """One automaton per worker process: the last that was used."""
    if name not in _AUTOMATA:
        _AUTOMATA.clear()
        _AUTOMATA[name] = ItemAutomaton(items.value, window)
    return _AUTOMATA[name]


def _batches(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            yield batch.slice(low, rows)


def _span_lists(spans: list[list[tuple[int, int]]]) -> list[list[dict]]:
    return [[{"first": a, "last": b} for a, b in s] for s in spans]


def item_blocks(items: DataFrame) -> Iterator[list[tuple[str | None, str]]]:
    """Items as lists of about ``BLOCK_WORDS`` words, one after the other."""
    length = F.coalesce(F.length("text"), F.lit(0)).cast("bigint")
    # Ids as text behind a mark; an item without id hits like any other and is not named.
    key = F.coalesce(F.concat(F.lit("="), F.col("item_id").cast("string")), F.lit(""))
    named = items.filter("text is not null").select(key.alias("item_id"), F.col("text").cast("string").alias("text"))
    sized = named.groupBy("item_id", "text").agg(F.first(length / 2 + 1).cast("bigint").alias("size"))
    placed = running_offsets(sized.select("item_id", "size", F.xxhash64("text").alias("h")), [F.col("item_id"), F.col("h")], "size")
    block = F.floor(F.col("offset") / BLOCK_WORDS)
    placed = stage(placed.select("item_id", "h", block.alias("block")), "item-blocks")
    numbers = [r.block for r in placed.select("block").distinct().collect()]
    for number in sorted(numbers):
        mine = placed.filter(F.col("block") == number).select("item_id", "h").distinct()
        rows = sized.withColumn("h", F.xxhash64("text")).join(mine, ["item_id", "h"]).select("item_id", "text").collect()
        yield [(key[1:] if key else None, text) for key, text in sorted((r.item_id, r.text) for r in rows)]


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(row, text, n_words, spans, items)``: ``row`` is the document as a struct, ``spans`` are word numbers."""
    spark = docs.sparkSession
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    marked = docs.select(
        row.alias("row"),
        F.col("text").cast("string").alias("text"),
        F.lit(0).cast("bigint").alias("n_words"),
        F.array().cast(SPANS).alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    schema = marked.schema

    def passed(before: DataFrame, block: list[tuple[str | None, str]]) -> DataFrame:
        shared, name = spark.sparkContext.broadcast(block), uuid.uuid4().hex

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton = _automaton(name, shared, window)
            for batch in _batches(batches):
                rows = scan(automaton, batch["text"].to_pylist())
                earlier = [[(s["first"], s["last"]) for s in x] for x in batch["spans"].to_pylist()]
                spans = [merged(e + hits) for e, (_, hits, _) in zip(earlier, rows)]
                found = [sorted({*e, *f} - {None}) for e, (_, _, f) in zip(batch["items"].to_pylist(), rows)]
                columns = [
                    batch["row"],
                    batch["text"],
                    pa.array([n for n, _, _ in rows], pa.int64()),
                    pa.array(_span_lists(spans), batch.schema.field("spans").type),
                    pa.array(found, batch.schema.field("items").type),
                ]
                yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

        return before.mapInArrow(run, schema)

    block = None
    for following in item_blocks(items):
        if block is not None:
            marked = stage(passed(marked, block), "scanned")
        block = following
    return passed(marked, block or [])


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text with every span of words, from its first to its last byte, replaced by a line end."""
    content = text.encode()
    places = [m.span() for m in _WORD.finditer(content.translate(_WORD_BYTES))]
    parts, at = [], 0
    for first, last in spans:
        parts.append(content[at : places[first][0]])
        at = places[last][1]
    return b"\n".join([*parts, content[at:]]).decode()


def decontaminate(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, max_coverage: float = MAX_COVERAGE
) -> DataFrame:
    """``docs`` without documents that are mostly benchmark, and without hit spans in the others."""
    names, hit = docs.columns, F.expr("aggregate(spans, 0L, (n, s) -> n + s.last - s.first + 1)")
    scanned = contamination(docs, items, window)
    # Joining what is left can make a window again, so cut rows are scanned again, until none is hit.
    done = scanned.filter("size(spans) = 0").select("row.*")
    dirty = stage(scanned.filter((F.size("spans") > 0) & (hit <= F.col("n_words") * max_coverage)), "hit")
    while not dirty.isEmpty():
        cut = dirty.withColumn("left", _cut(F.col("text"), F.col("spans"))).select(
            *[
                F.col("left").alias(c) if c == "text" else _length(c, dirty).alias(c)
                for c in names
            ]
        )
        again = stage(contamination(cut, items, window), "hit")
        done = done.unionByName(again.filter("size(spans) = 0").select("row.*"))
        dirty = again.filter("size(spans) > 0")
    return done


def _length(column: str, dirty: DataFrame):
    """A document's column, with ``n_chars`` as long as the text that is left."""
    value = F.col(f"row.`{column}`")
    return F.length("left").cast(dirty.select(value).schema[0].dataType) if column == "n_chars" else value


@F.arrow_udf(T.StringType())
def _cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
    pairs = zip(texts.to_pylist(), spans.to_pylist())
    return pa.array([without_spans(t, [(s["first"], s["last"]) for s in x]) for t, x in pairs], pa.string())


def contamination_rows(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Counts and a digest of the items per document."""
    named = F.array_sort("items")
    n_hit = F.expr("aggregate(spans, 0L, (n, s) -> n + s.last - s.first + 1)")
    return contamination(docs, items).select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(named, ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


_SQL_WORDS = (
    "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)
ORACLE = f"""
WITH items AS (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, w[i:i + least(len(w), 10) - 1] AS g
  FROM items, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS u(i) WHERE len(w) > 0),
texts AS (SELECT doc_id, coalesce({_SQL_WORDS}, []) AS w FROM documents),
sizes AS (SELECT DISTINCT len(g) AS k FROM windows),
places AS (
  SELECT doc_id, i, k, w[i:i + k - 1] AS g FROM texts, sizes, unnest(generate_series(1, len(w) - k + 1)) AS u(i)),
found AS (SELECT doc_id, i, k, item_id FROM places JOIN windows USING (g)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM found, unnest(generate_series(i, i + k - 1)) AS u(p) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(item_id) AS n, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM texts LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""
