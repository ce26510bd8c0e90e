"""Fuzzy line dedup: one occurrence per connected group of near-equal lines stays.

1. Lines with a word are normalised (lower case, words only; letters of scripts without spaces are words of their
   own) and get an id (a 64-bit hash of the normalised words). Lines with equal words are one node with a count.
2. Two lines are linked if their word edit similarity is 0.8 or more (words as 32-bit hashes). The
   search is complete. With ``n`` words in the longer line, at most ``k = n // 5`` edits are allowed, and each
   changes at most two pairs of neighbouring words, so the lines have ``n - 1 - 2 k`` or more pairs in common. Of two
   lists sorted by one order, the first few then hold a common one: a line's keys are its first ``prefix_sizes``, about
   0.4 a word, or fewer, as two pairs are changed by one edit only if they are neighbours in the line. Rare pairs come
   first in that order, by tables of fixed size made of samples of lines: pairs of rare words, and last the pairs that are
   common themselves, as those of a phrase of rare words are. The tables decide how many lines meet, not which links are
   found. Candidates of a key have lengths within 0.8 and word parities that
   differ in at most ``2 k`` less the difference of lengths, of 64 and then 256 or more classes, which no linked pair fails.
3. Groups are connected components. Of each group with more than one occurrence the first stays,
   by ``(doc_id, hash of the text, line number)``; the others are removed from their documents.

SimHash is not used: a link at 0.8 differs in a fifth of the bits of a SimHash of any width, so that a key of 16 bits
is shared with a chance of 0.025 and one of 32 bits with 0.0006. Recall 0.9 takes about 90 keys of 16 bits a line, and such
keys are shared by chance with every 65,536th line.

A key shared by many similar lines is not expanded into pairs. The commonest line of a key (the original, as a rule)
stands for it. Every line is first compared with that one of these that it shares most keys with. Lines that ended in the
same component need no further comparison; those that did not are then compared with the others of these, and lines
outside their key's largest component with the key's lines in other components. No link between components is lost. A key
that many lines share that are not similar is expanded in this last step.

Defined cases: null texts stay null, empty ones empty; lines without words stay. Rows with equal
``doc_id`` and text are one document and are treated alike. Other columns pass unchanged. A 64-bit
line id can collide once in about ``2**64 / n`` pairs.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.components import components
from quire.staging import drop, stage

# Equal lines of any length are linked, if there is a word in them.
MIN_WORDS = 1
SIMILARITY = 0.8
# Numbers of lines are handed to every task up to this many (8 bytes each); beyond it rows are shuffled to them.
MAX_SHARED_LINES = 2_000_000
# Ids of candidates (8 bytes each) and signatures (40 bytes each) likewise; the driver holds these several times.
MAX_SHARED_IDS = 200_000
MAX_SHARED_SIGNATURES = 50_000

# Keys of more different lines than this are taken in so many shares.
MAX_UNSHARED_ROWS = 100_000
KEY_SHARES = 3

# Lines of more words have a wider signature: 256 classes are half odd, however unlike two lines are.
MOST_NARROW, MOST_WIDE = 160, 800

# With fewer lines, keys are ordered by hash alone; with more, about so many show which words are common.
MIN_RANKED_LINES = 1_000
RANKED_SAMPLE = 20_000

# One line of so many, and about RANKED_SAMPLE at least, show which pairs of words are common, of which so many are known. The
# share is fixed, so that groups of lines that meet at a pair do not grow with their number.
PAIR_SHARE = 16
MIN_COMMON = 3
MAX_COMMON_PAIRS = 1 << 20

_WORD_BYTES = bytes(b if b >= 0x80 or b == 0x0A or chr(b).isalnum() else 0x20 for b in range(256)).lower()
# Letters of scripts without spaces (Thai, Lao, Burmese, Khmer, kana, Han), each a word of its own, and marks beyond ASCII.
_UNSPACED = re.compile("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff])")
_WIDE_MARKS = re.compile("[\u2000-\u206f\u3000-\u3004\u3008-\u3020\u3030\u30a0\u30fb\ufe10-\ufe1f\ufe30-\ufe6f\uff01-\uff0f\uff1a-\uff20\uff3b-\uff40\uff5b-\uff65]")
_ROWS = 256
_STEP = np.uint64(0x9E3779B97F4A7C15)
_LEVEL_WORDS = 1 << 20
_LEVEL_PAIRS = 1 << 23
_KEY_ROWS, _LEVEL_BITS, _HASH_BITS = 1024, 7, 47
_COMMON = 64  # the level from which pairs are common
_PAIRS_AT_ONCE = 1 << 20


def spaced(text: str) -> str:
    """The text with blanks around every letter of a script without spaces."""
    if text.isascii() or not _UNSPACED.search(text):
        return text
    return _UNSPACED.sub(r" \1 ", _WIDE_MARKS.sub(" ", text))


def line_words(text: str) -> list[list[bytes]]:
    """Normalised words of every line."""
    return [line.split() for line in spaced(text).lower().encode().translate(_WORD_BYTES).split(b"\n")]


def _mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ values >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ values >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return values ^ values >> np.uint64(31)


def word_hashes(content: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words at these places, eight bytes of all words at a time."""
    eights = np.ndarray(len(content) + 1, "<u8", content + bytes(8), strides=(1,))
    hashes, at, active = sizes.astype(np.uint64) * _STEP, 0, np.arange(len(starts))
    while len(active):
        unused = np.maximum(at + 8 - sizes[active], 0).astype(np.uint64) * np.uint64(8)
        values = eights[starts[active] + at] << unused
        hashes[active] = _mix((hashes[active] ^ values) + _STEP)
        at += 8
        active = active[sizes[active] > at]
    return hashes


def hashed_lines(texts: list[str | None]) -> tuple[np.ndarray, ...]:
    """Of all lines that are long enough: number of the text, of the line, id, number of words; and 32 bits of all their words."""
    cleaned = [spaced(text).lower().encode() if text else b"" for text in texts]
    content = b"\n".join(cleaned).translate(_WORD_BYTES)
    letters = np.frombuffer(content, np.uint8)
    edges = np.flatnonzero(np.diff((letters > 0x20).view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    starts, ends = edges[0::2], edges[1::2]
    hashes = word_hashes(content, starts, ends - starts)
    line = np.searchsorted(np.flatnonzero(letters == 0x0A), starts)
    firsts = np.flatnonzero(np.diff(line, prepend=-1))
    sizes = np.diff(firsts, append=len(line))
    if len(firsts) and MIN_WORDS > 1:
        enough = np.repeat(sizes >= MIN_WORDS, sizes)
        hashes, line = hashes[enough], line[enough]
        firsts = np.flatnonzero(np.diff(line, prepend=-1))
        sizes = np.diff(firsts, append=len(line))
    place = (np.arange(len(line)) - np.repeat(firsts, sizes)).astype(np.uint64)
    placed = _mix(hashes + (place + np.uint64(1)) * _STEP)
    ids = _mix(np.add.reduceat(placed, firsts) + sizes.astype(np.uint64)) if len(firsts) else placed
    breaks = np.fromiter((c.count(b"\n") + 1 for c in cleaned), np.int64, len(cleaned))
    first_lines, found = np.cumsum(breaks) - breaks, line[firsts]
    numbers = np.searchsorted(first_lines, found, "right") - 1
    return numbers, found - first_lines[numbers], ids.view(np.int64), sizes, hashes.astype("<u4")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for low in range(0, whole.num_rows, _ROWS):
            batch = whole.slice(low, _ROWS)
            numbers, places, ids, sizes, words = hashed_lines(batch["text"].to_pylist())
            if len(ids):
                at = pa.array(numbers, pa.int64())
                columns = [
                    batch["doc_id"].take(at), batch["text_hash"].take(at), pa.array(places, pa.int32()),
                    pa.array(ids), _short_words(words, sizes),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "at", "line", "words"])


def _short_words(words: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The words of each line, given as 32-bit numbers, in one binary value."""
    offsets = np.concatenate([[0], np.cumsum(4 * sizes)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(words.tobytes())])


def edit_distance(a: list, b: list) -> int:
    """Levenshtein distance of two sequences, with one bit per element of ``a``."""
    if not a or not b:
        return len(a) + len(b)
    places: dict = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, distance = full, 0, len(a)
    for x in b:
        equal = places.get(x, 0)
        diagonal = (((equal & up) + up) ^ up) | equal | down
        right_up = down | ~(diagonal | up) & full
        right_down = up & diagonal
        distance += bool(right_up & top) - bool(right_down & top)
        right_up = (right_up << 1 | 1) & full
        right_down = right_down << 1 & full
        up = right_down | ~(diagonal | right_up) & full
        down = right_up & diagonal
    return distance


def similar(a: list, b: list, least: float = SIMILARITY) -> bool:
    longest = max(len(a), len(b))
    if min(len(a), len(b)) < least * longest:
        return False
    return longest - edit_distance(a, b) >= least * longest - 1e-9


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = [
            similar(np.frombuffer(a, "<u4").tolist(), np.frombuffer(b, "<u4").tolist())
            for a, b in zip(batch["words_a"].to_pylist(), batch["words_b"].to_pylist())
        ]
        yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], ["a", "b"]).filter(pa.array(kept, pa.bool_()))


def prefix_sizes(sizes: np.ndarray) -> np.ndarray:
    """How many of its pairs of words a line has to offer as keys.

    For a longer line of ``n`` words it is ``2 * (n // 5) + 1 - (n - size)``, largest at the own size or at the next
    multiple of five. Lines of fewer than four words are linked to equal ones only.
    """
    edits, rest = sizes // 5, 5 - sizes % 5
    own, longer = 2 * edits + 1, 2 * (edits + 1) + 1 - rest
    most = np.where(5 * sizes >= 4 * (sizes + rest), np.maximum(own, longer), own)
    return np.where(sizes >= 4, most, 0)


def gram_keys(
    words: np.ndarray, sizes: np.ndarray, levels: np.ndarray | None = None, common: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """``(row, key)`` for lines given as 32-bit words: the first pairs of neighbouring words, by level and hash.

    The first pairs are so many that no allowed edits change all of them, so that one is left in the other line, and among its
    first: the lines' ends in the order are one after the other. A pair that a line has again is one key. ``levels`` says how
    common words are, and ``common`` which pairs are common themselves; any of these give the same links.
    """
    rows, keys, ends = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], np.cumsum(sizes)
    for low in range(0, len(sizes), _KEY_ROWS):
        some = sizes[low : low + _KEY_ROWS]
        start, end = ends[low] - sizes[low], ends[low + len(some) - 1]
        owner, found = _some_keys(words[start:end], some, levels, common)
        rows.append(owner + low)
        keys.append(found)
    return np.concatenate(rows), np.concatenate(keys)


def _pair_hashes(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hashes of the pairs of neighbouring words that begin at these places."""
    long = words.astype(np.uint64)
    return _mix(long[at] * _STEP + long[at + 1]) >> np.uint64(64 - _HASH_BITS)


def _some_keys(
    words: np.ndarray, sizes: np.ndarray, levels: np.ndarray | None, common: np.ndarray | None
) -> tuple[np.ndarray, np.ndarray]:
    """One number has the row (10 bits), the level (7 bits) and the hash (47 bits) of a pair, so that sorting it is all."""
    wanted = prefix_sizes(sizes)
    pairs = np.where(wanted > 0, sizes - 1, 0)
    firsts = np.cumsum(pairs) - pairs
    owner = np.repeat(np.arange(len(sizes)), pairs)
    at = np.arange(len(owner)) + np.repeat(np.cumsum(sizes) - sizes - firsts, pairs)
    order = _pair_hashes(words, at)
    if levels is not None:
        of_word = levels[words & np.uint32(len(levels) - 1)]
        level = of_word[at] + of_word[at + 1] >> 1
        if common is not None:
            level = np.maximum(level, common[order & np.uint64(len(common) - 1)])
        order |= level.astype(np.uint64) << np.uint64(_HASH_BITS)
    order |= owner.astype(np.uint64) << np.uint64(_HASH_BITS + _LEVEL_BITS)
    sorting = np.argsort(order)
    order = order[sorting]
    rank = np.arange(len(order)) - firsts[owner]
    taken = rank < _enough(sizes, wanted, firsts, owner, rank, sorting)[owner]
    taken[1:] &= order[1:] != order[:-1]
    keys = order[taken] & np.uint64((1 << _HASH_BITS + _LEVEL_BITS) - 1)
    return owner[taken], keys.view(np.int64)


def _enough(sizes: np.ndarray, wanted: np.ndarray, firsts: np.ndarray, owner: np.ndarray, rank: np.ndarray, sorting: np.ndarray) -> np.ndarray:
    """How many of its first pairs each line has to offer, ``wanted`` at most, so that no allowed edits change all of them.

    An edit of a word changes two of these pairs only where they are neighbours, and an added word changes one. ``k`` edits
    of which ``b`` or more add a word change ``k + min(k - b, doubles)`` pairs at most, with ``doubles`` the number of
    neighbours, of which no pair is counted twice. ``b`` is by how many words the other line is longer.
    """
    place = np.empty(len(sorting), np.int64)
    place[sorting] = np.arange(len(sorting))
    # Runs of two less those of three and those of four: of a run of n that is as many as it has doubles, or more.
    two = np.maximum(place[1:], place[:-1])
    three = np.maximum(two[1:], place[:-2])
    four = np.maximum(three[1:], place[:-3])
    n = len(sorting) + 1
    met = np.bincount(two[owner[1:] == owner[:-1]], minlength=n)
    met -= np.bincount(three[owner[2:] == owner[:-2]], minlength=n)
    met += np.bincount(four[owner[3:] == owner[:-3]], minlength=n)
    doubles = np.cumsum(met)
    some = np.flatnonzero(rank < wanted[owner])
    line = owner[some]
    size, t = sizes[line], rank[some] + 1
    doubles = doubles[some] - (doubles[firsts] - met[firsts])[line]
    edits = size // 5
    most = edits + np.minimum(edits, doubles)
    longer = np.maximum((size - doubles) >> 2, edits + 1)  # as many edits, if the other line has five times as many words
    more = np.where(4 * longer <= size, longer + np.minimum(size - 4 * longer, doubles), 0)
    enough = np.where(t > np.maximum(most, more), t, size)
    least, has = wanted.copy(), wanted > 0
    if len(some):
        least[has] = np.minimum(wanted[has], np.minimum.reduceat(enough, (np.cumsum(wanted) - wanted)[has]))
    return least


def _parts(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The 32-bit words of all lines, and the number of each line."""
    values = words.to_pylist()
    return np.frombuffer(b"".join(values), "<u4"), np.fromiter(map(len, values), np.int64, len(values)) // 4


def _parity(words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Of each of 64 classes of words whether their number in a line is odd."""
    ones = np.uint64(1) << (words & np.uint32(63)).astype(np.uint64)
    return np.bitwise_xor.reduceat(ones, starts).view(np.int64)


def _keyed(levels: Broadcast | None, part: int, parts: int) -> Callable:
    """Makes the keys of one of ``parts`` shares, each with what is compared first."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                words, sizes = _parts(batch["words"])
                rows, keys = gram_keys(words, sizes, *(levels.value if levels else ()))
                if parts > 1:
                    own = keys % parts == part
                    rows, keys = rows[own], keys[own]
                odd = _parity(words, np.cumsum(sizes) - sizes)
                line, n = batch["line"].to_numpy(), batch["n"].to_numpy()
                columns = [keys, line[rows], n[rows], odd[rows], sizes[rows].astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "line", "n", "odd", "size"])

    return keyed


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The odd ones of 256 classes of words, as four numbers; of a long line, those of more classes as well."""
    for batch in batches:
        if batch.num_rows:
            words, sizes = _parts(batch["words"])
            starts, sides = np.cumsum(sizes) - sizes, []
            for side in range(4):
                ones = np.where(words >> np.uint32(6) & np.uint32(3) == side, np.uint64(1) << (words & np.uint32(63)).astype(np.uint64), np.uint64(0))
                sides.append(pa.array(np.bitwise_xor.reduceat(ones, starts).view(np.int64)))
            columns = [batch["line"], *sides, _long_parity(words, sizes), pa.array(sizes, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["line", "s0", "s1", "s2", "s3", "wide", "size"])


def _long_parity(words: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The odd ones of 1,024 or 8,192 classes of words as numbers, none for a line that 256 classes tell from others."""
    width = np.select([sizes > MOST_WIDE, sizes > MOST_NARROW], [128, 16], 0)
    ends = np.cumsum(width)
    of_word = np.repeat(width > 0, sizes)
    own = words[of_word] >> np.uint32(8)
    place = (own >> np.uint32(6)) & np.repeat(np.maximum(width - 1, 0), sizes)[of_word].astype(np.uint32)
    bits = np.zeros(ends[-1], np.uint64)
    np.bitwise_xor.at(bits, np.repeat(ends - width, sizes)[of_word] + place, np.uint64(1) << (own & np.uint32(63)).astype(np.uint64))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(bits.view(np.int64)))


def _words_met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            found, counts = np.unique(_parts(batch["words"])[0] & np.uint32(_LEVEL_WORDS - 1), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(counts)], ["word", "n"])


def _pairs_met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places in the table of common pairs, with the number of lines' pairs that fall on each."""

    def counted(some: list[np.ndarray]) -> pa.RecordBatch:
        found, counts = np.unique(np.concatenate(some), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts)], ["pair", "n"])

    some, n = [], 0
    for batch in batches:
        if batch.num_rows:
            words, sizes = _parts(batch["words"])
            at = np.delete(np.arange(len(words)), np.cumsum(sizes) - 1)
            some.append((_pair_hashes(words, at) & np.uint64(_LEVEL_PAIRS - 1)).astype(np.int32))
            n += len(at)
            if n >= _PAIRS_AT_ONCE:
                yield counted(some)
                some, n = [], 0
    if n:
        yield counted(some)


def _word_levels(distinct: DataFrame, lines: int) -> Broadcast | None:
    """How common words are, and common pairs of words, by the last bits of their hashes, as far as samples of lines show it.

    All tasks order keys by these tables. Rare pairs make small groups, but any table leads to the same links, as
    every line offers as many keys as it takes. Words tell pairs apart that are not common; they are rare, but not together,
    in a phrase that many lines have, so that its pairs have to be counted.
    """
    if lines < MIN_RANKED_LINES:
        return None
    step = 1 + lines // RANKED_SAMPLE
    some = distinct.filter(F.pmod("line", F.lit(step)) == 0).select("words")
    met = some.mapInArrow(_words_met, "word int, n bigint").groupBy("word").agg(F.sum("n").alias("n")).filter("n > 1").toArrow()
    levels = np.zeros(_LEVEL_WORDS, np.uint8)
    levels[met["word"].to_numpy()] = np.minimum(4 * np.log2(met["n"].to_numpy()), 63).astype(np.uint8)
    more = distinct.filter(F.pmod("line", F.lit(min(step, PAIR_SHARE))) == 0).select("words")
    met = more.mapInArrow(_pairs_met, "pair int, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    met = stage(met.filter(f"n >= {MIN_COMMON}"), "common-pairs")
    numbers = met.groupBy("n").agg(F.count("*").alias("pairs")).toArrow().sort_by([("n", "descending")])
    fit = np.cumsum(numbers["pairs"].to_numpy()) <= MAX_COMMON_PAIRS
    common = np.zeros(_LEVEL_PAIRS, np.uint8)
    if fit.any():
        least = int(numbers["n"].to_numpy()[fit][-1])
        found = met.filter(F.col("n") >= least).toArrow()
        common[found["pair"].to_numpy()] = _COMMON + np.minimum(3 * np.log2(found["n"].to_numpy() / least), _COMMON - 1).astype(np.uint8)
    drop(met)
    return distinct.sparkSession.sparkContext.broadcast((levels, common))


def _signatures(distinct: DataFrame, search: Search) -> DataFrame:
    signed = distinct.select("line", "words").mapInArrow(search.described, "line bigint, s0 bigint, s1 bigint, s2 bigint, s3 bigint, wide array<bigint>, size int")
    return stage(signed, "line-signatures")


_NARROW = ("s0", "s1", "s2", "s3")
_SIDES = (*_NARROW, "wide")


def _most(size_a: str, size_b: str) -> Column:
    """In how many classes of words linked lines differ: two an edit, but one if it adds or removes a word."""
    longer, shorter = F.greatest(size_a, size_b), F.least(size_a, size_b)
    return 2 * F.floor(longer / 5) - (longer - shorter)


def _alike(a: Callable[[str], str], b: Callable[[str], str]) -> Column:
    """Holds for signatures of lines that may be linked; ``a`` and ``b`` name the columns of both."""
    differ = sum(F.bit_count(F.col(a(c)).bitwiseXOR(F.col(b(c)))) for c in _NARROW)
    most = _most(a("size"), b("size"))
    each = F.zip_with(a("wide"), b("wide"), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    narrow = (F.size(a("wide")) == 0) | (F.size(a("wide")) != F.size(b("wide")))
    return (differ <= most) & (narrow | (F.aggregate(each, F.lit(0), lambda n, x: n + x) <= most))


def _still_near(pairs: DataFrame, signatures: DataFrame, few: bool) -> DataFrame:
    """Pairs whose signatures do not rule out a link."""
    sides = []
    for side in ("a", "b"):
        renamed = signatures.select(F.col("line").alias(side), F.struct(*_SIDES, "size").alias(f"sig_{side}"))
        sides.append(F.broadcast(renamed) if few else renamed)
    both = pairs.join(sides[0], "a").join(sides[1], "b")
    return both.filter(_alike("sig_a.{}".format, "sig_b.{}".format)).select("a", "b")


def _near(odd_a: str, size_a: str, odd_b: str, size_b: str) -> Column:
    """Holds for all lines that are similar enough, and for few others."""
    longer, shorter = F.greatest(size_a, size_b), F.least(size_a, size_b)
    differ = F.bit_count(F.col(odd_a).bitwiseXOR(F.col(odd_b)))
    return (5 * shorter >= 4 * longer) & (differ <= _most(size_a, size_b))


@dataclass(frozen=True)
class Search:
    """How similar items are found: keys that they share, and what they have to fulfil before and after words are read."""

    keyed: Callable
    described: Callable
    near: Callable
    verified: Callable


LINES = Search(_keyed, _described, _near, _verified)


def _union(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def _links(found: DataFrame, distinct: DataFrame, signatures: DataFrame, search: Search) -> DataFrame:
    """Candidate pairs ``(a, b)`` that are similar enough; signatures thin them out before words are read."""
    few = signatures.count() <= MAX_SHARED_SIGNATURES
    pairs = stage(_still_near(found, signatures, few), "line-pairs")
    ids = stage(pairs.select(F.explode(F.array("a", "b")).alias("line")).distinct(), "candidate-lines")
    needed = F.broadcast(ids) if ids.count() <= MAX_SHARED_IDS else ids
    words = stage(distinct.select("line", "words").join(needed, "line", "left_semi"), "candidate-words")
    first = words.select(F.col("line").alias("a"), F.col("words").alias("words_a"))
    second = words.select(F.col("line").alias("b"), F.col("words").alias("words_b"))
    joined = pairs.join(first, "a").join(second, "b").select("a", "b", "words_a", "words_b")
    links = stage(joined.mapInArrow(search.verified, "a bigint, b bigint"), "line-links")
    drop(pairs, ids, words)
    return links


def distinct_lines(lines: DataFrame) -> DataFrame:
    """``(line, words, n)`` of different lines, written."""
    return stage(lines.groupBy("line").agg(F.first("words").alias("words"), F.count("*").alias("n")), "distinct-lines")


def line_groups(lines: DataFrame) -> DataFrame:
    """``(id, component)`` of lines that are linked to another one."""
    return similar_groups(distinct_lines(lines), LINES)


def similar_groups(distinct: DataFrame, search: Search) -> DataFrame:
    """``(id, component)`` of the rows ``(line, words, n)`` that are linked to another one.

    Many rows are taken in shares of their keys, one after the other: a share's shuffle is gone before the next
    one begins, and every key is in one share.
    """
    lines = distinct.count()
    parts = KEY_SHARES if lines > MAX_UNSHARED_ROWS else 1
    levels = _word_levels(distinct, lines)
    of_key = Window.partitionBy("key")
    close = (F.col("line") != F.col("top.line")) & search.near("odd", "size", "top.odd", "top.size")
    shares = []
    for part in range(parts):
        keyed = distinct.select("line", "n", "words").mapInArrow(search.keyed(levels, part, parts), "key bigint, line bigint, n bigint, odd bigint, size int")
        top = F.max(F.struct("n", "line", "odd", "size")).over(of_key)
        met = keyed.withColumns({"lines": F.count("*").over(of_key), "top": top}).filter("lines > 1")
        met = met.select("key", "line", "odd", "size", "lines", F.col("top.line").alias("top"), close.alias("close"))
        # With those that are close to it all lines of a key are compared with its commonest one: others matter among three or more.
        met = met.filter("close or lines > 2 and line != top")
        shares.append(stage(met, "met-keys"))
    met = _union(shares)
    signatures = _signatures(distinct, search)
    # First every line with the one of these that it shares most keys with: copies of one line are in a group after that.
    pairs = met.filter("close").groupBy(F.col("line").alias("a"), F.col("top").alias("b")).agg(F.count("*").alias("keys"))
    pairs = stage(pairs, "close-pairs")
    nearest = pairs.groupBy("a").agg(F.max(F.struct("keys", "b")).alias("best")).select("a", "best.b")
    links = _links(nearest, distinct, signatures, search)
    known = components(links, "line-components")
    rest = pairs.select("a", "b")
    for side in ("a", "b"):
        of_side = known.select(F.col("id").alias(side), F.col("component").alias(f"known_{side}"))
        rest = rest.join(of_side, side, "left").withColumn(f"group_{side}", F.coalesce(f"known_{side}", side))
    rest = stage(rest.filter("group_a != group_b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "other-pairs")
    drop(pairs)
    others = met.filter("lines > 2 and line != top").select("key", "line", "odd", "size")
    grouped = others.join(known.withColumnRenamed("id", "line"), "line", "left")
    grouped = stage(grouped.select("key", "line", "odd", "size", F.coalesce("component", "line").alias("group")), "grouped-keys")
    drop(known, *shares)
    sizes = grouped.groupBy("key", "group").agg(F.count("*").alias("n"))
    main = sizes.groupBy("key").agg(F.max_by("group", "n").alias("main"), F.count("*").alias("groups")).filter("groups > 1")
    # Signatures go along, as lines of different groups make many pairs, and most are ruled out where they meet.
    mixed = grouped.join(main.drop("groups"), "key").join(signatures.drop("size"), "line")
    mixed = stage(mixed.select("key", "line", "odd", "size", "group", "main", *_SIDES), "mixed-keys")
    drop(grouped)
    apart = mixed.filter("group != main").select("key", F.col("line").alias("a"), "odd", "size", F.col("group").alias("group1"), *_SIDES)
    renamed = [F.col(c).alias(f"{c}2") for c in ("odd", "size", "group", *_SIDES)]
    every = mixed.select("key", F.col("line").alias("b"), (F.col("group") == F.col("main")).alias("of_main"), *renamed)
    near = search.near("odd", "size", "odd2", "size2") & _alike("{}".format, "{}2".format)
    once = F.col("of_main") | (F.col("a") < F.col("b"))
    across = apart.join(every, "key").filter((F.col("group1") != F.col("group2")) & once & near)
    found = stage(across.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "across-pairs")
    drop(mixed)
    more = _links(found.unionByName(rest).distinct(), distinct, signatures, search)
    drop(signatures, found, rest)
    if levels:
        levels.destroy()
    all_links = components(links.unionByName(more), "line-components")
    drop(links, more, distinct)
    return all_links


def removed_lines(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_hash, removed)``: numbers of the lines to remove, for documents with any."""
    narrow = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64(F.col("text").cast("string")).alias("text_hash"),
        F.col("text").cast("string").alias("text"),
    )
    lines = stage(narrow.mapInArrow(_hashed, "doc_id bigint, text_hash bigint, at int, line bigint, words binary"), "lines")
    distinct = distinct_lines(lines)
    # Words are most of the table; from here on only the distinct lines have them.
    places = stage(lines.drop("words"), "line-places")
    drop(lines)
    lines, groups = places, similar_groups(distinct, LINES)
    counts = lines.groupBy("line").agg(F.count("*").alias("n"))
    labelled = counts.join(groups.withColumnRenamed("id", "line"), "line", "left")
    labelled = labelled.select("line", "n", F.coalesce("component", "line").alias("group"))
    again = labelled.groupBy("group").agg(F.sum("n").alias("total")).filter("total > 1").select("group")
    repeated = stage(labelled.join(again, "group").select("line", "group"), "repeated-lines")
    occurrence = F.struct("doc_id", "text_hash", "at").alias("occurrence")
    places = stage(lines.join(repeated, "line").select("group", occurrence), "occurrences")
    drop(lines, repeated, groups)
    first = stage(places.groupBy("group").agg(F.min("occurrence").alias("first")), "first-occurrences")
    rest = places.join(first, "group").filter(~F.col("occurrence").eqNullSafe(F.col("first"))).select("occurrence.*")
    return rest.groupBy("doc_id", "text_hash").agg(F.collect_set("at").alias("removed"))


@F.arrow_udf(T.StringType())
def _without_lines(texts: pa.Array, removed: pa.Array) -> pa.Array:
    out = []
    for text, numbers in zip(texts.to_pylist(), removed.to_pylist()):
        gone = set(numbers or ())
        out.append(None if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone))
    return pa.array(out, pa.string())


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``(row, text, n_lines, n_removed)``: ``row`` is the document as a struct, ``text`` what is left of it."""
    text = F.col("row.text").cast("string")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.withColumns({"doc_id": F.col("row.doc_id").cast("bigint"), "text_hash": F.xxhash64(text)})
    gone = removed_lines(docs).select(F.col("doc_id").alias("id2"), F.col("text_hash").alias("hash2"), "removed")
    same = (F.col("text_hash") == F.col("hash2")) & F.col("doc_id").eqNullSafe(F.col("id2"))
    gone = stage(gone, "removed-lines")
    few = gone.agg(F.coalesce(F.sum(F.size("removed") + 2), F.lit(0))).first()[0] <= MAX_SHARED_LINES
    found = rows.join(F.broadcast(gone) if few else gone, same, "left")
    touched = F.when(F.col("removed").isNotNull(), text)
    # A generator keeps later filters on the text from running the function again.
    cut = F.explode(F.array(_without_lines(touched, F.col("removed"))))
    left = found.select("row", "removed", cut.alias("left"))
    n_lines = F.when(text.isNull(), 0).otherwise(F.length(text) - F.length(F.replace(text, F.lit("\n"))) + 1)
    return left.select(
        "row",
        F.when(F.col("removed").isNull(), text).otherwise(F.col("left")).alias("text"),
        n_lines.cast("bigint").alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).cast("bigint").alias("n_removed"),
    )


def deduped_lines(docs: DataFrame) -> DataFrame:
    """Each document with what is left of its text."""
    return dedup_lines(docs).select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_removed", "text")
