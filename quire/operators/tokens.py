"""Tokenizers: each turns a text column into an array of token ids.

``WordTokenizer`` and ``ByteTokenizer`` are here; ``quire.operators.subwords`` has byte-level subwords of a
given vocabulary. Every document is followed by the end-of-text token. No ids are added or cut.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.operators.ranking import running_offsets
from quire.functions.text import is_blank, strip
from quire.session import keep_batches_small
from quire.staging import stage

WORD_PATTERN = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"
# The most frequent words are handed to every task, at most so many of at most so many bytes; the
# rest of the vocabulary is joined.
SHARED_WORDS = 200_000
SHARED_WORD_BYTES = 64
IDS = T.ArrayType(T.IntegerType())
# Words of the rows that share one numbering of rare words.
CHUNK_WORDS = 1 << 19
_RARE = T.ArrayType(T.StructType().add("code", T.IntegerType()).add("token", T.StringType()))
_ENCODED = T.StructType().add("chunk", T.LongType()).add("ids", IDS).add("rare", _RARE)


def stories(df: DataFrame, text: str = "text") -> DataFrame:
    """Non-blank documents, stripped at both ends."""
    return df.filter(~is_blank(F.col(text))).withColumn(text, strip(F.col(text)))


def frame(text: Column, eos: str) -> Column:
    """A document and its separator: the end-of-text token on a line of its own."""
    return F.concat(text, F.lit(f"\n{eos}\n"))


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(0))


_LOOKUPS: dict[str, dict[str, int]] = {}


def _lookup(name: str, words_and_ids) -> dict[str, int]:
    """One dictionary per worker process: that of the last vocabulary used."""
    if name not in _LOOKUPS:
        _LOOKUPS.clear()
        _LOOKUPS[name] = dict(zip(*words_and_ids.value))
    return _LOOKUPS[name]


def pieces(lists: pa.Array, most: int) -> Iterator[pa.Array]:
    """Runs of lists with at most ``most`` values, or a single list that has more."""
    ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    low = 0
    while low < len(ends):
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + most, "right")))
        yield lists.slice(low, high - low)
        low = high


def bounds(lengths: np.ndarray) -> pa.Array:
    """Where lists of these lengths start, and where the last one ends."""
    return pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))


def _word_ids(name: str, words_and_ids) -> Column:
    """Ids of the shared words; all others get the unknown id."""

    @F.arrow_udf(IDS)
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = _lookup(name, words_and_ids)
        for batch in batches:
            for lists in pieces(batch, CHUNK_WORDS):
                flat = lists.flatten().dictionary_encode()
                found = [known.get(w, WordTokenizer.unknown_id) for w in flat.dictionary.to_pylist()]
                lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                yield pa.ListArray.from_arrays(bounds(lengths), pa.array(found, pa.int32()).take(flat.indices))

    return ids


def _numbered_words(name: str, words_and_ids) -> Column:
    """Ids of the shared words, and ``-1 - code`` for the others, which are numbered anew in every chunk of rows.

    The number of a word and its text stand in the first row of the chunk that has it. A chunk is named by its first
    row, and has at most ``CHUNK_WORDS`` words unless it is one row.
    """

    @F.arrow_udf(_ENCODED)
    def ids(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        known = _lookup(name, words_and_ids)
        chunk, codes, held = None, {}, 0
        for batch, names in batches:
            at = 0
            for lists in pieces(batch, CHUNK_WORDS):
                flat = lists.flatten().dictionary_encode()
                lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                size = len(flat) + len(lists)  # rows without words have to count as well
                if chunk is None or held + size > CHUNK_WORDS:
                    chunk, codes, held = names[at].as_py(), {}, 0
                held += size
                numbers, new = [], []
                for i, word in enumerate(flat.dictionary.to_pylist()):
                    number = known.get(word)
                    if number is None:
                        if word not in codes:
                            new.append((i, len(codes)))
                            codes[word] = len(codes)
                        number = -1 - codes[word]
                    numbers.append(number)
                ends = bounds(lengths)
                encoded = pa.ListArray.from_arrays(ends, pa.array(numbers, pa.int32()).take(flat.indices))
                new = np.array(new, np.int64).reshape(-1, 2)
                # Words of a dictionary stand in the order of their first places.
                indices = flat.indices.to_numpy(zero_copy_only=False)
                first = np.zeros(len(numbers), np.int64)
                first[indices[::-1]] = np.arange(len(indices))[::-1]
                rows = np.searchsorted(ends.to_numpy(), first[new[:, 0]], "right") - 1
                counts = np.bincount(rows, minlength=len(lengths))
                texts = flat.dictionary.take(pa.array(new[:, 0])).cast(pa.string())
                rare = pa.StructArray.from_arrays([pa.array(new[:, 1].astype(np.int32)), texts], ["code", "token"])
                chunks = pa.array(np.full(len(lengths), chunk, np.int64))
                yield pa.StructArray.from_arrays(
                    [chunks, encoded, pa.ListArray.from_arrays(bounds(counts), rare)], ["chunk", "ids", "rare"]
                )
                at += len(lengths)

    return ids


def _filled(rows: pa.Table, found: pa.Table) -> pa.Table:
    """A chunk's rows with the ids of its numbered words; what is not found is unknown."""
    lists = rows["_ids"].combine_chunks()
    flat = lists.flatten().to_numpy(zero_copy_only=False).copy()
    rare = np.flatnonzero(flat < 0)
    codes = -1 - flat[rare]
    numbers = np.full(codes.max(initial=-1) + 1, WordTokenizer.unknown_id, np.int32)
    numbers[found["code"].to_numpy()] = found["id"].to_numpy()
    flat[rare] = numbers[codes]
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    filled = pa.ListArray.from_arrays(bounds(lengths), pa.array(flat, pa.int32()))
    return rows.set_column(rows.column_names.index("_ids"), "_ids", filled).drop_columns(["_chunk"])


@dataclass
class WordTokenizer:
    """Words, numbers and single symbols, numbered by falling frequency.

    ``vocabulary`` is ``(token, n, id)``. Id 0 ends a text and pads, id 1 is an unknown token.
    """

    FIRST = 2
    eos_id = 0
    pad_id = 0
    unknown_id = 1
    bos_id = None

    vocabulary: DataFrame
    shared_words: int = SHARED_WORDS
    _shared: object = field(default=None, repr=False)

    @classmethod
    def fit(cls, df: DataFrame, text: str = "text", **options) -> WordTokenizer:
        """Count all words; equal counts are ordered by the word itself."""
        counts = (
            df.select(F.explode(words(F.col(text))).alias("token"))
            .groupBy("token")
            .agg(F.count("*").alias("n"))
        )
        ranked = running_offsets(counts, [F.desc("n"), F.asc("token")])
        vocabulary = ranked.select("token", "n", (F.col("offset") + cls.FIRST).cast("int").alias("id"))
        return cls(stage(vocabulary, "vocabulary"), **options)

    @property
    def vocab_size(self) -> int:
        return self.vocabulary.count() + self.FIRST

    @property
    def _is_shared(self) -> Column:
        frequent = F.col("id") < self.FIRST + self.shared_words
        return frequent & (F.octet_length("token") <= SHARED_WORD_BYTES)

    def _sent_words(self):
        """The frequent words and their ids, broadcast: a bounded number of bounded length."""
        if self._shared is None:
            table = self.vocabulary.filter(self._is_shared).select("token", "id").toArrow()
            content = table["token"].to_pylist(), table["id"].to_pylist()
            self._shared = uuid.uuid4().hex, self.vocabulary.sparkSession.sparkContext.broadcast(content)
        return self._shared

    def transform(self, df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
        """Replace ``text`` by ``tokens``. Every row is a document of its own; keys do not matter.

        Frequent words, which are nearly all occurrences, get their id where they are. Other words are numbered
        in chunks of rows; each different one of a chunk is joined once to the rest of the vocabulary, and its id
        meets the chunk's rows. A word meets the vocabulary at most once a chunk, so no join key is hot, and a chunk
        has a bounded number of words. The result is the same for any ``shared_words``.
        """
        keep_batches_small(df.sparkSession)
        kept = [c for c in df.columns if c != text]
        end = F.array(F.lit(self.eos_id))
        others = self.vocabulary.filter(~self._is_shared).select("token", "id")
        if others.isEmpty():
            ids = F.explode(F.array(_word_ids(*self._sent_words())(words(F.col(text))))).alias("_ids")
            return df.select(*kept, ids).select(*kept, F.concat("_ids", end).alias("tokens"))
        numbered = _numbered_words(*self._sent_words())(words(F.col(text)), F.monotonically_increasing_id())
        rows = stage(df.select(*kept, F.explode(F.array(numbered)).alias("_w")), "encoded")
        rare = rows.select(F.col("_w.chunk").alias("_chunk"), F.inline("_w.rare"))
        found = rare.join(others, "token").select("_chunk", "code", "id")
        encoded = rows.select(*kept, F.col("_w.chunk").alias("_chunk"), F.col("_w.ids").alias("_ids"))
        chunks = encoded.groupBy("_chunk").cogroup(found.groupBy("_chunk"))
        filled = chunks.applyInArrow(_filled, encoded.drop("_chunk").schema)
        return filled.select(*kept, F.concat("_ids", end).alias("tokens"))


@F.arrow_udf(IDS)
def _byte_values(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for content in batches:
        content = content.cast(pa.large_binary())
        lengths = pc.fill_null(pc.binary_length(content), 0).to_numpy(zero_copy_only=False)
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        data = content.buffers()[2]
        first = np.frombuffer(content.buffers()[1], dtype=np.int64)[content.offset]
        flat = np.frombuffer(data, dtype=np.uint8)[first : first + bounds[-1]] if data else []
        values = pa.array(np.asarray(flat, dtype=np.int32))
        yield pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), values)


class ByteTokenizer:
    """One id per UTF-8 byte; id 256 ends a text and pads."""

    eos_id = 256
    pad_id = 256
    bos_id = None
    vocab_size = 257

    def transform(self, df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
        """Replace ``text`` by ``tokens``; the end of text stands on a line of its own."""
        keep_batches_small(df.sparkSession)
        newline = ord("\n")
        end = F.array(F.lit(newline), F.lit(self.eos_id), F.lit(newline))
        kept = [c for c in df.columns if c != text]
        return df.select(*kept, F.concat(_byte_values(F.col(text)), end).alias("tokens"))


def special_ids(tokenizer, spark) -> DataFrame:
    """Vocabulary size and the ids of the special tokens."""
    row = (tokenizer.vocab_size, tokenizer.bos_id, tokenizer.eos_id, tokenizer.pad_id)
    return spark.createDataFrame([row], "vocab_size bigint, bos_id int, eos_id int, pad_id int")
