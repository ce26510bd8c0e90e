"""Byte-level subwords: ids by the merges of a given vocabulary file.

Texts are cut into words in the JVM, by the vocabulary's own pattern. Tasks then encode every different
word of a batch once, by a heap of adjacent pairs in the order of the merges, and remember it: most words
of a corpus are few different ones. No word is shuffled and none is cut or dropped, however long. The
vocabulary is given and never trained; its file is read on the driver and has a checked size.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.operators.tokens import CHUNK_WORDS, IDS, bounds, frame, pieces
from quire.session import keep_batches_small

MAX_DEFINITION_BYTES = 64 << 20
# Words whose ids a worker remembers.
REMEMBERED_WORDS = 200_000
# Fixed value: how the public byte-level vocabularies cut texts into words.
BYTE_LEVEL_WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++\z|\s+(?!\S)|\s"


def _symbol_bytes() -> dict[str, int]:
    """Byte-level files write a byte as itself where that is printable, and the others from 256 on."""
    shown = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    symbols = {chr(b): b for b in shown}
    symbols.update((chr(256 + i), b) for i, b in enumerate(b for b in range(256) if b not in shown))
    return symbols


class Merges(dict):
    """Ids of words (text to list), filled as words are asked for."""

    def __init__(self, ids: dict[bytes, int], ranks: dict[tuple[bytes, bytes], int], whole_words: bool):
        super().__init__()
        self.ids, self.ranks, self.whole_words, self.fixed = ids, ranks, whole_words, {}

    def __missing__(self, word: str) -> list[int]:
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        ids = self[word] = self.kept(self.fixed[word] if word in self.fixed else self.encode(word.encode()))
        return ids

    kept = staticmethod(list)

    def encode(self, word: bytes) -> list[int]:
        """Join the adjacent pair that comes first among the merges, the leftmost of equal ones, while there is one."""
        if self.whole_words and word in self.ids:
            return [self.ids[word]]
        n = len(word)
        parts = [word[i : i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ranks, pairs = self.ranks, []
        for i in range(n - 1):
            rank = ranks.get((parts[i], parts[i + 1]))
            if rank is not None:
                pairs.append((rank, i))
        heapify(pairs)
        while pairs:
            rank, i = heappop(pairs)
            j = after[i]
            if not parts[i] or j >= n or ranks.get((parts[i], parts[j])) != rank:
                continue  # one side has been joined to something else
            parts[i] += parts[j]
            parts[j] = b""
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for left in (before[i], i):
                right = after[left] if left >= 0 else n
                if right < n and (rank := ranks.get((parts[left], parts[right]))) is not None:
                    heappush(pairs, (rank, left))
        return [self.ids[p] for p in parts if p]


class PackedMerges(Merges):
    """Keeps the ids of a word as the bytes of 32-bit numbers, a quarter of a list's size."""

    kept = staticmethod(lambda ids: array("i", ids).tobytes())


_LOADED: dict[str, Merges] = {}


def _loaded(name: str, definition) -> Merges:
    """One encoder per worker process: that of the last vocabulary used."""
    if name not in _LOADED:
        _LOADED.clear()
        ids, ranks, whole_words, fixed = definition.value
        _LOADED[name] = PackedMerges(ids, ranks, whole_words)
        _LOADED[name].fixed = fixed
    return _LOADED[name]


class SubwordTokenizer:
    """Byte-level pair merges from a JSON vocabulary file.

    ``eos`` must be an added token of the file; ``pad`` falls back to it. An added token within a text stands
    for itself. ``pattern`` is how the vocabulary cuts words, in Java's syntax.
    """

    def __init__(self, path: str, eos: str, pad: str | None = None, bos: str | None = None, pattern: str = BYTE_LEVEL_WORDS):
        if os.path.getsize(path) > MAX_DEFINITION_BYTES:
            raise ValueError("vocabulary is too large to hand to every task")
        with open(path, encoding="utf-8") as file:
            definition = json.load(file)
        model, symbols = definition["model"], _symbol_bytes()
        self.added = {t["content"]: t["id"] for t in definition["added_tokens"]}
        for token in filter(None, (eos, pad, bos)):
            if token not in self.added:
                raise ValueError(f"{token!r} is not an added token of this vocabulary")
        as_bytes = lambda token: bytes(symbols[c] for c in token)
        self.ids = {as_bytes(t): i for t, i in model["vocab"].items() if t not in self.added}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.ranks = {(as_bytes(a), as_bytes(b)): i for i, (a, b) in enumerate(pairs)}
        self.whole_words = bool(model.get("ignore_merges"))
        self.eos, self.pattern = eos, pattern
        self.eos_id = self.added[eos]
        self.pad_id = self.added[pad] if pad else self.eos_id
        self.bos_id = self.added[bos] if bos else None
        self.vocab_size = len(self.ids) + len(self.added)

    def words(self, text: Column) -> Column:
        """Words of a text in order; added tokens are words of their own."""
        names = "|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True))
        cut = lambda part: F.regexp_extract_all(part, F.lit(f"(?U){self.pattern}"), F.lit(0))
        marks = F.regexp_extract_all(text, F.lit(f"({names})"), F.lit(1))
        parts = F.transform(
            F.split(text, names, -1),
            lambda part, i: F.concat(cut(part), F.when(i < F.size(marks), F.array(F.get(marks, i))).otherwise(F.array().cast("array<string>"))),
        )
        return F.flatten(parts)

    def vocabulary(self, spark) -> DataFrame:
        """``(id, token binary, added)`` of all tokens."""
        rows = [(i, bytearray(t), False) for t, i in self.ids.items()] + [(i, bytearray(t.encode()), True) for t, i in self.added.items()]
        return spark.createDataFrame(rows, "id int, token binary, added boolean")

    def transform(self, df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
        """Replace ``text`` by ``tokens``; the end of text stands on a line of its own."""
        keep_batches_small(df.sparkSession)
        fixed = {t: [i] for t, i in self.added.items()}
        definition = df.sparkSession.sparkContext.broadcast((self.ids, self.ranks, self.whole_words, fixed))
        name = uuid.uuid4().hex

        @F.arrow_udf(IDS)
        def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            known = _loaded(name, definition)
            for lists in batches:
                for piece in pieces(lists, CHUNK_WORDS):
                    flat = piece.flatten().dictionary_encode()
                    found = [known[w] for w in flat.dictionary.to_pylist()]
                    sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
                    numbers = pa.array(np.frombuffer(b"".join(found), np.int32))
                    ids = pa.ListArray.from_arrays(bounds(sizes), numbers).take(flat.indices)
                    ends = np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy(zero_copy_only=False))])
                    words = piece.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                    last = ends[np.concatenate([[0], np.cumsum(words)])].astype(np.int32)
                    yield pa.ListArray.from_arrays(pa.array(last), ids.flatten())

        kept = [c for c in df.columns if c != text]
        framed = frame(F.coalesce(F.col(text), F.lit("")), self.eos)
        return df.select(*kept, encode(self.words(framed)).alias("tokens"))


def token_counts(tokens: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``(id, token, added, n, n_docs)`` of a ``vocabulary``; tokens that do not occur count zero.

    Reads ``tokens`` twice: write them before.
    """
    first = F.explode(F.array_distinct("tokens")).alias("id")
    occurrences = tokens.select(F.explode("tokens").alias("id")).groupBy("id").agg(F.count("*").alias("n"))
    documents = tokens.select(first).groupBy("id").agg(F.count("*").alias("n_docs"))
    counts = occurrences.join(documents, "id")
    return vocabulary.join(counts, "id", "left").fillna(0, ["n", "n_docs"])
