"""Phrase collocations by the stripes pattern.

A stripe is a prefix with an associative counter of the words that follow it. Tasks build the stripes of a
chunk of text and emit one row per prefix. Stripes are merged elementwise: a merged stripe is a set of rows
``(lang, prefix, next, n)``, never one row, since the stripe of a common prefix has no bound; sums are combined before
the shuffle, and no group is larger than one entry's partial sums. The entry with an empty ``next`` holds
the prefix total, and the one of the empty prefix all words of the language. So one structure gives the extensions
(entries), the frequencies of first parts (prefix totals), and the largest longer phrase (maximum over the
entries of a stripe, and over those that share prefix's last word and ``next``).

Prefixes of one word come first. A phrase of three words can be frequent only if both its pairs
are, so prefixes of two words are counted where both pairs are in a Bloom filter of the frequent pairs. The filter
has a fixed size; a false hit costs an entry and changes nothing, and a full filter just prunes nothing.

Defined cases: a null text is empty; a null language is ``und``; repeated rows and ids count as often as they
occur; empty tables and texts without frequent phrases give no rows; other columns are ignored. A text has to
fit in a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.counted_joins import SHARED_KEYS, join_counts
from quire.staging import stage

LEAST = 10
SUBSUMED_PERCENT = 50
TOP = 2000
UNKNOWN = "und"
# Words of a chunk whose stripes a task holds at once, and bits of the filter of frequent pairs.
CHUNK_WORDS = 400_000
FILTER_BITS = 1 << 25
_PROBES = 3
_SALTS = 64
STRIPES = "lang string, prefix string, nexts array<string>, counts array<bigint>"
_ROWS_AT_ONCE = 50_000
# Piece ends become a byte that no UTF-8 text holds, and tabs become spaces.
_END = b"\xff"
_CUTS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", _END * 10 + b" ")


class _Numbers(dict):
    """Words of one language, numbered at first sight by a numbering that all languages of a chunk share."""

    def __init__(self, lang: str, known: list):
        super().__init__({_END: 0})
        self.lang, self.known = lang, known

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.known)
        self.known.append((self.lang, word))
        return number


def _word_stream(text: str) -> list[bytes]:
    """Lower-cased words in order, with an end mark after each piece."""
    return text.encode().lower().translate(_CUTS).replace(_END, b" " + _END + b" ").split() + [_END]


def _chunks(batches: Iterator[pa.RecordBatch], chunk_words: int) -> Iterator[tuple[list, np.ndarray]]:
    """``(words by number, stream of numbers)``; number 0 ends a piece."""
    known, by_lang, streams, size = [None], {}, [], 0
    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"]):
            if not (text := text.as_py()):
                continue
            lang = lang.as_py()
            numbers = by_lang.get(lang)
            if numbers is None:
                numbers = by_lang[lang] = _Numbers(lang, known)
            stream = np.array(list(map(numbers.__getitem__, _word_stream(text))), np.int64)
            streams.append(stream)
            size += len(stream)
            if size >= chunk_words:
                yield known, np.concatenate(streams)
                known, by_lang, streams, size = [None], {}, [], 0
    if size:
        yield known, np.concatenate(streams)


def _counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(codes, return_counts=True)


def _rows(langs: pa.Array, prefixes: pa.Array, owner: np.ndarray, nexts: pa.Array, counts: np.ndarray):
    """Stripe rows; ``owner`` says for every entry, in order, which prefix it belongs to."""
    bounds = np.searchsorted(owner, np.arange(len(prefixes) + 1))
    for low in range(0, len(prefixes), _ROWS_AT_ONCE):
        cut = bounds[low : low + _ROWS_AT_ONCE + 1]
        at, some = pa.array((cut - cut[0]).astype(np.int32)), slice(cut[0], cut[-1])
        columns = [
            langs.slice(low, len(cut) - 1),
            prefixes.slice(low, len(cut) - 1),
            pa.ListArray.from_arrays(at, nexts.slice(cut[0], cut[-1] - cut[0])),
            pa.ListArray.from_arrays(at, pa.array(counts[some].astype(np.int64))),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "prefix", "nexts", "counts"])


def _word_stripes(chunk_words: int):
    """Stripes of all prefixes of one word, of their totals, and of the empty prefix's total."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for known, stream in _chunks(batches, chunk_words):
            langs = pa.array([""] + [k[0] for k in known[1:]], pa.string())
            words = pa.array([""] + [k[1].decode() for k in known[1:]], pa.string())
            first, second = stream[:-1], stream[1:]
            pairs, n = _counted((first << 32 | second)[(first > 0) & (second > 0)])
            totals = np.bincount(stream, minlength=len(known))[1:]
            # The total of a prefix is its entry with the empty word, number 0, which sorts first.
            codes = np.concatenate([np.arange(1, len(known)) << 32, pairs])
            order = np.argsort(codes, kind="stable")
            codes, n = codes[order], np.concatenate([totals, n])[order]
            yield from _rows(langs[1:], words[1:], (codes >> 32) - 1, words.take(pa.array(codes & 0xFFFFFFFF)), n)
            whole: dict[str, int] = {}
            for (lang, _), total in zip(known[1:], totals.tolist()):
                whole[lang] = whole.get(lang, 0) + total
            k = len(whole)
            empty = pa.array([""] * k, pa.string())
            yield from _rows(pa.array(list(whole), pa.string()), empty, np.arange(k), empty, np.array(list(whole.values()), np.int64))

    return build


def _word_hash(lang: str, word: bytes) -> int:
    return xxhash.xxh64_intdigest(lang.encode() + b"\0" + word)


def _bits(first: np.ndarray, second: np.ndarray, bits: int) -> np.ndarray:
    """``_PROBES`` bit numbers for each pair of word hashes."""
    mixed = (first * np.uint64(0x9E3779B97F4A7C15)) ^ (second + (first >> np.uint64(29)))
    probes = []
    for _ in range(_PROBES):
        mixed = mixed * np.uint64(0xD6E8FEB86659FD93) + np.uint64(0x632BE59BD9B4E019)
        mixed ^= mixed >> np.uint64(32)
        probes.append((mixed % np.uint64(bits)).astype(np.int64))
    return np.stack(probes)


def _pair_filter(pairs: DataFrame, bits: int) -> np.ndarray:
    """Bloom filter of ``(lang, prefix, next)``, as bytes: ``bits / 64`` rows come to the driver at most."""

    def positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            lang, first, second = (batch[c].to_pylist() for c in ("lang", "prefix", "next"))
            sides = [np.array([_word_hash(g, w.encode()) for g, w in zip(lang, side)], np.uint64) for side in (first, second)]
            at = np.unique(_bits(*sides, bits))
            starts = np.flatnonzero(np.concatenate([[True], at[1:] >> 6 != at[:-1] >> 6]))
            masks = np.bitwise_or.reduceat(np.uint64(1) << (at & 63).astype(np.uint64), starts).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at[starts] >> 6), pa.array(masks)], ["place", "mask"])

    found = pairs.select("lang", "prefix", "next").mapInArrow(positions, "place bigint, mask bigint")
    table = found.groupBy("place").agg(F.bit_or("mask").alias("mask")).toArrow()
    content = np.zeros(bits // 64, np.int64)
    content[table["place"].to_numpy()] = table["mask"].to_numpy()
    return content.view(np.uint8)


def _pair_stripes(chunk_words: int, frequent, bits: int):
    """Stripes of prefixes of two words, where both pairs of the phrase may be frequent."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        content = frequent.value
        for known, stream in _chunks(batches, chunk_words):
            hashes = np.array([0] + [_word_hash(*k) for k in known[1:]], np.uint64)
            words = pa.array([""] + [k[1].decode() for k in known[1:]], pa.string())
            langs = pa.array([""] + [k[0] for k in known[1:]], pa.string())
            # Pairs are numbered; a pair that holds a piece's end or is not frequent has number -1.
            codes, number = np.unique(stream[:-1] << 32 | stream[1:], return_inverse=True)
            first, second = codes >> 32, codes & 0xFFFFFFFF
            at = _bits(hashes[first], hashes[second], bits)
            kept = ((content[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=0) & (first > 0) & (second > 0)
            both = kept[number[:-1]] & kept[number[1:]]
            triples, n = _counted((number[:-1] << 32 | stream[2:])[both])
            if not len(triples):
                continue
            prefix, owner = np.unique(triples >> 32, return_inverse=True)
            a, b = words.take(pa.array(first[prefix])).to_pylist(), words.take(pa.array(second[prefix])).to_pylist()
            phrases = pa.array([f"{x} {y}" for x, y in zip(a, b)], pa.string())
            yield from _rows(langs.take(pa.array(first[prefix])), phrases, owner, words.take(pa.array(triples & 0xFFFFFFFF)), n)

    return build


def _merged(stripes: DataFrame, least: int) -> DataFrame:
    """Stripes merged elementwise, as written entries of at least ``least``."""
    entries = stripes.select("lang", "prefix", F.inline(F.arrays_zip("nexts", "counts")))
    entries = entries.withColumnsRenamed({"nexts": "next", "counts": "n"})
    merged = entries.groupBy("lang", "prefix", "next").agg(F.sum("n").alias("n"))
    return stage(merged.filter(F.col("n") >= least), "stripes")


def stripe_entries(docs: DataFrame, least: int = LEAST, chunk_words: int = CHUNK_WORDS, bits: int = FILTER_BITS):
    """Frequent entries of the stripes of one word and of two: two tables ``(lang, prefix, next, n)``."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN))
    narrow = docs.select(lang.alias("lang"), F.col("text").cast("string").alias("text"))
    ones = _merged(narrow.mapInArrow(_word_stripes(chunk_words), STRIPES), least)
    content = _pair_filter(ones.filter("next != ''"), bits)
    frequent = docs.sparkSession.sparkContext.broadcast(content)
    return ones, _merged(narrow.mapInArrow(_pair_stripes(chunk_words, frequent, bits), STRIPES), least)


def _score(a: Column, left: Column, right: Column) -> Column:
    wide = lambda c: c.cast("decimal(18,0)")
    square = (wide(a) * wide(a)).cast("decimal(38,0)") * F.lit(1_000_000).cast("decimal(38,0)")
    return F.call_function("div", square, (wide(left) * wide(right)).cast("decimal(38,0)"))


def _last_word(phrase: str) -> Column:
    return F.substring_index(phrase, " ", -1)


def scored_phrases(ones: DataFrame, twos: DataFrame, percent: int = SUBSUMED_PERCENT, shared: int = SHARED_KEYS) -> DataFrame:
    """``(lang, phrase, a, l, r, score)`` of all candidates that no longer one subsumes."""
    words = ones.filter("prefix != '' and next = ''").select("lang", F.col("prefix").alias("w"), F.col("n").alias("f"))
    pairs = ones.filter("next != ''").select("lang", F.col("prefix").alias("w1"), F.col("next").alias("w2"), F.col("n").alias("a"))
    phrases = pairs.select("lang", F.concat_ws(" ", "w1", "w2").alias("w"), F.col("a").alias("f"))
    triples = twos.select("lang", F.col("prefix").alias("w12"), F.col("next").alias("w3"), F.col("n").alias("a"))

    def frequency(rows: DataFrame, table: DataFrame, of: Column, name: str) -> DataFrame:
        found = join_counts(rows.withColumn("w", of), table, ["lang", "w"], "f", shared)
        return found.drop("w").withColumnRenamed("f", name)

    two = frequency(frequency(pairs, words, F.col("w1"), "l"), words, F.col("w2"), "r")
    two = two.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", _score(F.col("a"), F.col("l"), F.col("r")).alias("score"))

    later = F.concat_ws(" ", _last_word("w12"), "w3")
    longest = triples.select("lang", F.col("w12").alias("phrase"), "a").unionByName(triples.select("lang", later.alias("phrase"), "a"))
    longest = longest.groupBy("lang", "phrase").agg(F.max("a").alias("_longer"))
    wide = lambda c, by: F.col(c).cast("decimal(38,0)") * by
    two = two.join(longest, ["lang", "phrase"], "left")
    two = two.filter(F.col("_longer").isNull() | (wide("_longer", 100) < wide("a", percent))).drop("_longer")

    three = frequency(triples, words, F.substring_index("w12", " ", 1), "l1")
    three = frequency(three, phrases, later, "r1")
    three = frequency(three, phrases, F.col("w12"), "l2")
    three = frequency(three, words, F.col("w3"), "r2")
    three = three.withColumns({f"s{k}": _score(F.col("a"), F.col(f"l{k}"), F.col(f"r{k}")) for k in (1, 2)})
    cut = [F.struct(F.col(f"s{k}").alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")) for k in (1, 2)]
    three = three.withColumn("_c", F.least(*cut))
    three = three.select("lang", F.concat_ws(" ", "w12", "w3").alias("phrase"), "a", "_c.l", "_c.r", "_c.score")
    return two.unionByName(three)


def best_phrases(scored: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` of each language with ``rank``; cut per salt before a language comes together."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = scored.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(_SALTS)))
    within = Window.partitionBy("lang", "_salt").orderBy(*order)
    few = salted.withColumn("rank", F.row_number().over(within)).filter(F.col("rank") <= top).drop("_salt", "rank")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")
    return few.withColumn("rank", rank).filter(F.col("rank") <= top)


def collocations(docs: DataFrame, top: int = TOP, least: int = LEAST, shared: int = SHARED_KEYS, **chunks) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``."""
    ones, twos = stripe_entries(docs, least, **chunks)
    best = best_phrases(scored_phrases(ones, twos, shared=shared), top)
    sizes = ones.filter("prefix = ''").select("lang", "n")
    return best.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM texts
), grams AS (
  SELECT lang, w[i : i + k - 1] AS g, count(*) AS f
  FROM pieces, unnest([1, 2, 3]) AS o(k), unnest(range(1, greatest(len(w) - k + 2, 1))) AS s(i)
  GROUP BY ALL
), sizes AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang
), candidates AS (
  SELECT * FROM grams WHERE len(g) > 1 AND f >= 10
), cuts AS (
  SELECT c.lang, c.g, c.f AS a, k, x.f AS l, y.f AS r, 1000000::HUGEINT * c.f * c.f // (x.f::HUGEINT * y.f) AS score
  FROM candidates c, unnest(range(1, len(c.g))) AS o(k)
  JOIN grams x ON x.lang = c.lang AND x.g = c.g[1 : k]
  JOIN grams y ON y.lang = c.lang AND y.g = c.g[k + 1 : len(c.g)]
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1
), longer AS (
  SELECT lang, inner_g AS g, max(f) AS f FROM (
    SELECT lang, g[1 : 2] AS inner_g, f FROM candidates WHERE len(g) = 3
    UNION ALL SELECT lang, g[2 : 3], f FROM candidates WHERE len(g) = 3) GROUP BY ALL
), kept AS (
  SELECT b.lang, array_to_string(b.g, ' ') AS phrase, b.a, b.l, b.r, b.score
  FROM lowest b LEFT JOIN longer m ON m.lang = b.lang AND m.g = b.g
  WHERE m.f IS NULL OR 100::HUGEINT * m.f < 50::HUGEINT * b.a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT r.lang, rank, phrase, a, l, r.r, n, score::BIGINT AS score
FROM ranked r JOIN sizes USING (lang) WHERE rank <= 2000
"""
