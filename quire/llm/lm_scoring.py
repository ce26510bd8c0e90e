"""Document scores of an n-gram model, run as a weighted backoff automaton.

The model is a bigram model with absolute discounting, on a unigram model with add-1/2 smoothing and
one class of unknown words. All bigrams seen ``CUTOFF`` times or more in training are kept, which is all of them. Its
automaton has a state per word (the history) and a root. An arc from a state carries the log
probability of a kept bigram; the failure arc carries the backoff weight and leads to the root, whose
arcs carry unigram log probabilities. A text is read once, left to right, from the state of the end
token to an end token. All arcs of a state and its failure arc sum to one.

The model grows with the corpus and is never in one place:

1. Documents are cut, where they lie, into chunks of at most about ``CHUNK_TOKENS`` tokens. A chunk
   is a row with the stream of its local word ids and the hashes of its words, and is written.
2. Each chunk sends the training counts of its distinct words and bigrams to buckets, by hash. The
   number of buckets follows the number of tokens. A frequent word or pair is one entry per chunk; the
   followers of one history are spread over about the square root of all buckets.
3. A bucket adds up, and returns to every chunk the totals of what that chunk sent, in order. Masses
   of kept bigrams go to the bucket of their history's word, and from there to the chunks.
4. Each chunk builds the part of the automaton that its own texts can reach, and reads them through it.

Defined cases: a null or empty text is the end token alone. A null ``doc_id`` counts as the empty
text in the hold-out rule. Repeated rows are scored, and learned from, each. No rows give no rows. Words
are told apart by 64-bit hashes, bigrams by hashes of those.

Numbers of a row travel as bytes: the JVM copies these at once, where lists of numbers are taken apart by element,
in vectors that double as they grow.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.staging import stage

FOLDS, HELD_OUT = 5, 1
CUTOFF = 1
CHUNK_TOKENS = 1_500_000
BUCKET_TOKENS = 1_500_000
END = b"\n"  # no word holds a line end
_ROWS = 256
# Rows for buckets go on together, up to so many and so many bytes.
_SENT_ROWS, _SENT_BYTES = 256, 1 << 20
_LONGS, _INTS = pa.list_(pa.int64()), pa.list_(pa.int32())
_LONG, _INT = np.dtype("<i8"), np.dtype("<i4")
_HALF = np.dtype("<u4")
_KINDS = {"stream": _INT, "high": _HALF, "low": _HALF}

_PAIR_NAMES, _WORD_NAMES = (["chunk", "bucket", "keys", "counts", *more] for more in (["histories", "runs"], ["masses", "kept"]))

CHUNKS = "chunk bigint, doc_ids array<bigint>, trained array<boolean>, sizes array<int>, stream binary, high binary, low binary"
PAIRS_SENT = "chunk bigint, bucket int, keys binary, counts binary, histories binary, runs binary"
WORDS_SENT = "chunk bigint, bucket int, keys binary, counts binary, masses binary, kept binary"
PAIRS_BACK = "chunk bigint, bucket int, totals binary, histories array<bigint>, masses array<bigint>, kept array<int>, once bigint, twice bigint"
WORDS_BACK = "chunk bigint, bucket int, totals binary, masses binary, kept binary, known bigint"
SCORES = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS == HELD_OUT


def tokens(text: str | None) -> list[bytes]:
    words = (text or "").encode().lower().split()
    words.append(END)
    return words


class _LocalIds(dict):
    def __missing__(self, word):
        value = self[word] = len(self)
        return value


class _Chunk:
    """Documents collected for one chunk; the end token has local id 0."""

    def __init__(self):
        self.ids, self.doc_ids, self.sizes, self.streams, self.n = _LocalIds({END: 0}), [], [], [], 0

    def add(self, doc_id: int | None, text: str | None) -> None:
        words = tokens(text)
        self.doc_ids.append(doc_id)
        self.sizes.append(len(words))
        self.streams.append(np.fromiter(map(self.ids.__getitem__, words), np.int32, len(words)))
        self.n += len(words)

    def row(self, chunk: int) -> pa.RecordBatch:
        digest = xxhash.xxh3_64_intdigest
        hashes = np.fromiter(map(digest, self.ids), np.uint64, len(self.ids)).view(np.int64)
        values = [[chunk], [self.doc_ids], [[not held_out(d) for d in self.doc_ids]], [self.sizes]]
        kinds = [pa.int64(), _LONGS, pa.list_(pa.bool_()), _INTS]
        arrays = [pa.array(v, k) for v, k in zip(values, kinds)]
        arrays += [_one_list(np.concatenate(self.streams)), _one_list(hashes)]
        return pa.RecordBatch.from_arrays(arrays, ["chunk", "doc_ids", "trained", "sizes", "stream", "hashes"])


def _one_list(values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values))


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    return pa.array(values, kind)


def _flat(column: pa.ChunkedArray | pa.Array, kind: np.dtype) -> np.ndarray:
    """All numbers of all rows, one after the other."""
    parts = [np.zeros(0, kind)]
    for part in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        if len(part):
            part = part.cast(pa.binary())
            _, ends, data = part.buffers()
            ends = np.frombuffer(ends, _INT)[part.offset : part.offset + len(part) + 1]
            if ends[-1] > ends[0]:
                parts.append(np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].view(kind))
    return np.concatenate(parts)


def _pieces(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """``values`` as bytes, in pieces of these lengths."""
    ends = np.concatenate([[0], np.cumsum(lengths * values.itemsize)])
    if ends[-1] >= 1 << 31:
        raise ValueError("a bucket has too many numbers")
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(ends.astype(_INT)), pa.py_buffer(values)])


def _lengths(column: pa.ChunkedArray) -> np.ndarray:
    """How many 64-bit numbers each row has."""
    return pc.binary_length(column).to_numpy() // _LONG.itemsize


def _packed(row: pa.RecordBatch) -> pa.RecordBatch:
    """The row of a chunk with its long lists as bytes; of hashes apart the half by which words are dealt, as scoring needs no more."""
    halves = row["hashes"].values.to_numpy().view(_HALF).reshape(-1, 2)
    long = [_pieces(np.ascontiguousarray(v), np.array([len(v)])) for v in (row["stream"].values.to_numpy(), halves[:, 1], halves[:, 0])]
    few = ["chunk", "doc_ids", "trained", "sizes"]
    return pa.RecordBatch.from_arrays([*(row[name] for name in few), *long], [*few, "stream", "high", "low"])


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number, chunk = TaskContext.get().partitionId() << 32, _Chunk()
    for whole in batches:
        for low in range(0, whole.num_rows, _ROWS):
            batch = whole.slice(low, _ROWS)
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                chunk.add(doc_id, text)
                if chunk.n >= CHUNK_TOKENS:
                    yield _packed(chunk.row(number))
                    number, chunk = number + 1, _Chunk()
    if chunk.n:
        yield _packed(chunk.row(number))


def _mixed(history: np.ndarray, word: np.ndarray) -> np.ndarray:
    """64-bit hash of a pair of hashes."""
    state = history.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ (word.view(np.uint64) + np.uint64(0xD6E8FEB86659FD93))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        state = (state ^ state >> np.uint64(shift)) * np.uint64(factor)
    return (state ^ state >> np.uint64(31)).view(np.int64)


def _bucket(places: np.ndarray, buckets: int) -> np.ndarray:
    """Words are dealt by the upper 31 bits of their hashes."""
    return places % np.int32(buckets)


@dataclass
class Buckets:
    """How words and pairs are dealt."""

    words: int
    histories: int
    followers: int

    @classmethod
    def of(cls, n_tokens: int) -> Buckets:
        n = max(1, -(-n_tokens // BUCKET_TOKENS))
        followers = max(1, round(n**0.5))
        return cls(n, -(-n // followers), followers)


class ChunkWords:
    """Distinct words of one chunk, in the order in which buckets get and return them."""

    def __init__(self, row: dict, buckets: Buckets):
        self.buckets, self.sizes = buckets, row["sizes"]
        self.places = (row["high"] >> np.uint32(1)).astype(np.int32)
        if "low" in row:
            self.hashes = np.stack([row["low"], row["high"]], axis=1).view(_LONG)[:, 0]
        self.stream, self.n_words = row["stream"], len(self.places)
        self.ends = np.cumsum(self.sizes)
        self.trained = np.repeat(row["trained"], self.sizes)
        self.word_bucket = _bucket(self.places, buckets.words)
        self.word_order = np.argsort(self.word_bucket, kind="stable")

    def sent(self, chunk: int) -> Iterator[tuple]:
        counts = np.bincount(self.stream[self.trained], minlength=self.n_words).astype(_LONG)
        for bucket, at in _by_bucket(self.word_bucket, self.word_order):
            yield chunk, bucket, self.hashes[at].tobytes(), counts[at].tobytes(), b"", b""


class ChunkPairs(ChunkWords):
    """The same, with its distinct bigrams: ``history`` and ``follower`` are local word ids."""

    def __init__(self, row: dict, buckets: Buckets):
        super().__init__(row, buckets)
        self.state = np.roll(self.stream, 1)
        self.state[self.ends - self.sizes] = 0  # every text starts from the end token
        codes = self.state * np.int64(self.n_words) + self.stream
        codes, self.pair_of = np.unique(codes, return_inverse=True)
        self.history, self.follower = ((f(codes, self.n_words)).astype(np.int32) for f in (np.floor_divide, np.mod))
        by_history = _bucket(self.places, buckets.histories)[self.history] * np.int32(buckets.followers)
        self.pair_bucket = by_history + _bucket(self.places, buckets.followers)[self.follower]
        self.pair_order = np.argsort(self.pair_bucket, kind="stable")

    def sent(self, chunk: int) -> Iterator[tuple]:
        counts = np.bincount(self.pair_of[self.trained], minlength=len(self.history)).astype(np.int32)
        for bucket, at in _by_bucket(self.pair_bucket, self.pair_order):
            own = self.history[at]  # pairs are in order of their history
            first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            runs = np.diff(np.append(first, len(own))).astype(np.int32)
            keys = _mixed(self.hashes[own], self.hashes[self.follower[at]])
            yield chunk, bucket, keys.tobytes(), counts[at].tobytes(), self.hashes[own[first]].tobytes(), runs.tobytes()


def _by_bucket(buckets: np.ndarray, order: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    ordered = buckets[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    for low, high in zip(first, np.append(first[1:], len(order))):
        yield int(ordered[low]), order[low:high]


def _chunk_row(batch, i: int) -> dict:
    """Row ``i`` with its lists as arrays."""
    row = {"chunk": batch["chunk"][i].as_py(), "doc_ids": batch["doc_ids"][i].as_py()}
    for name in ("trained", "sizes"):
        row[name] = batch[name][i].values.to_numpy(zero_copy_only=False)
    for name, kind in _KINDS.items():
        if name in batch.schema.names:
            row[name] = np.frombuffer(batch[name][i].as_buffer(), kind)
    return row


def _sender(buckets: Buckets, counted: type, names: list[str]):
    kinds = (pa.int64(), pa.int32(), *[pa.binary()] * 4)

    def together(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row, rows, size = _chunk_row(batch, i), [], 0
                for sent in counted(row, buckets).sent(row["chunk"]):
                    rows.append(sent)
                    size += sum(map(len, sent[2:]))
                    if len(rows) >= _SENT_ROWS or size >= _SENT_BYTES:
                        yield together(rows)
                        rows, size = [], 0
                if rows:
                    yield together(rows)

    return send


def _sum_pairs(table: pa.Table) -> pa.Table:
    """Totals of the bigrams of one bucket; statistics are in the first row."""
    keys, counts = _flat(table["keys"], _LONG), _flat(table["counts"], _INT)
    histories = np.repeat(_flat(table["histories"], _LONG), _flat(table["runs"], _INT))
    distinct, first, place = np.unique(keys, return_index=True, return_inverse=True)
    totals = np.zeros(len(distinct), np.int64)
    np.add.at(totals, place, counts)
    kept = totals >= CUTOFF
    owners, at = np.unique(histories[first[kept]], return_inverse=True)
    mass = np.bincount(at, weights=totals[kept], minlength=len(owners)).astype(np.int64)
    n_kept = np.bincount(at, minlength=len(owners)).astype(np.int32)
    rest, none = table.num_rows - 1, np.array([], np.int64)
    back = np.where(kept, totals, 0)[place]
    return pa.table(
        {
            "chunk": table["chunk"],
            "bucket": table["bucket"],
            "totals": _pieces(back, _lengths(table["keys"])),
            "histories": _lists([owners, *[none] * rest], _LONGS),
            "masses": _lists([mass, *[none] * rest], _LONGS),
            "kept": _lists([n_kept, *[none.astype(np.int32)] * rest], _INTS),
            "once": pa.array([int((totals == 1).sum()), *[0] * rest], pa.int64()),
            "twice": pa.array([int((totals == 2).sum()), *[0] * rest], pa.int64()),
        }
    )


def _sum_words(table: pa.Table) -> pa.Table:
    """Totals of the words of one bucket, with the masses of the bigrams they are the history of; nothing sent is zeros."""
    lengths = _lengths(table["keys"])
    distinct, place = np.unique(_flat(table["keys"], _LONG), return_inverse=True)
    sums = []
    for name in ("counts", "masses", "kept"):
        total = np.zeros(len(distinct), np.int64)
        np.add.at(total, place[np.repeat(_lengths(table[name]) > 0, lengths)], _flat(table[name], _LONG))
        sums.append(total)
    back = [_pieces(total[place], lengths) for total in sums]
    known = pa.array([int((sums[0] > 0).sum()), *[0] * (table.num_rows - 1)], pa.int64())
    names = ["chunk", "bucket", "totals", "masses", "kept", "known"]
    return pa.table([table["chunk"], table["bucket"], *back, known], names=names)


def _history_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What bigrams say about their histories, as one more sender of words."""
    for batch in batches:
        if batch.num_rows:
            lists = [batch[name] for name in ("keys", "masses", "kept")]
            lengths = lists[0].value_lengths().to_numpy()
            keys, masses, kept = (_pieces(v.flatten().to_numpy().astype(_LONG), lengths) for v in lists)
            none = pa.array([b""] * batch.num_rows, pa.binary())
            columns = [pa.array([-1] * batch.num_rows, pa.int64()), batch["bucket"], keys, none, masses, kept]
            yield pa.RecordBatch.from_arrays(columns, _WORD_NAMES)


@dataclass
class Smoothing:
    """The numbers that all chunks share."""

    n_trained: int
    n_known: int
    once: int
    twice: int

    @property
    def discount(self) -> float:
        return self.once / (self.once + 2 * self.twice) if self.once else 0.5

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 0.5) / (self.n_trained + 0.5 * (self.n_known + 1))


class BackoffAutomaton:
    """States are histories; ``arcs`` are by bigram of the chunk, ``failures`` by state, ``root`` by word.

    All weights are log10. A missing arc is minus infinity.
    """

    def __init__(self, counts: np.ndarray, masses: np.ndarray, kept: np.ndarray, smoothing: Smoothing):
        self.smoothing, self.counts = smoothing, counts
        probability = smoothing.unigram(counts)
        self.root = np.log10(probability)
        explicit = np.divide(masses - smoothing.discount * kept, counts, out=np.zeros(len(counts)), where=counts > 0)
        self.backoff, self.probability = 1 - explicit, probability
        self.failures = np.log10(self.backoff)

    def arcs(self, state: np.ndarray, word: np.ndarray, pair_counts: np.ndarray) -> np.ndarray:
        """Weights of arcs; of bigrams not seen minus infinity."""
        weights = np.full(len(state), -np.inf)
        has = pair_counts > 0
        state, word = state[has], word[has]
        own = (pair_counts[has] - self.smoothing.discount) / self.counts[state]
        weights[has] = np.log10(own + self.backoff[state] * self.probability[word])
        return weights

    def read(self, state: np.ndarray, word: np.ndarray, arcs: np.ndarray) -> np.ndarray:
        """Log probability of each token: the arc if there is one, else the failure arc and the root's."""
        return np.where(np.isfinite(arcs), arcs, self.failures[state] + self.root[word])


def _scorer(buckets: Buckets, smoothing: Smoothing):
    names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]

    def gathered(table: pa.Table, order: np.ndarray, *columns: str) -> list[np.ndarray]:
        table, found = table.sort_by("bucket"), []
        for column in columns:
            found.append(np.zeros(len(order), np.int64))
            found[-1][order] = _flat(table[column], _LONG)
        return found

    def score(chunks: pa.Table, words: pa.Table, pairs: pa.Table) -> pa.Table:
        row = _chunk_row(chunks, 0)
        own = ChunkPairs(row, buckets)
        counts, masses, kept = gathered(words, own.word_order, "totals", "masses", "kept")
        (pair_counts,) = gathered(pairs, own.pair_order, "totals")
        automaton = BackoffAutomaton(counts, masses, kept, smoothing)
        arcs = automaton.arcs(own.history, own.follower, pair_counts)
        weights = automaton.read(own.state, own.stream, arcs[own.pair_of])
        starts = own.ends - own.sizes
        columns = [
            pa.array(row["doc_ids"], pa.int64()),
            pa.array(~row["trained"]),
            pa.array(own.sizes.astype(np.int64)),
            pa.array(np.add.reduceat((counts[own.stream] > 0).astype(np.int64), starts)),
            pa.array(np.add.reduceat(automaton.root[own.stream], starts)),
            pa.array(np.add.reduceat(weights, starts)),
        ]
        return pa.table(columns, names=names)

    def from_both(chunks: pa.Table, back: pa.Table) -> pa.Table:
        kind = back["kind"].to_numpy()
        return score(chunks, back.filter(pa.array(kind == 0)), back.filter(pa.array(kind == 1)))

    return from_both


def score_documents(docs: DataFrame) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)``, a row per document."""
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chunks = stage(narrow.mapInArrow(_chunked, CHUNKS), "chunks", "zstd")
    sizes = chunks.select(F.explode(F.arrays_zip("sizes", "trained")).alias("d"))
    all_tokens, trained = sizes.agg(
        F.coalesce(F.sum("d.sizes"), F.lit(0)), F.coalesce(F.sum(F.when(F.col("d.trained"), F.col("d.sizes"))), F.lit(0))
    ).first()
    buckets = Buckets.of(all_tokens)
    pairs_sent = chunks.mapInArrow(_sender(buckets, ChunkPairs, _PAIR_NAMES), PAIRS_SENT)
    pairs = stage(pairs_sent.groupBy("bucket").applyInArrow(_sum_pairs, PAIRS_BACK), "pair-totals", "zstd")
    # What bigrams say about their histories is one more sender of words.
    about = pairs.filter("size(histories) > 0").select(F.explode(F.arrays_zip("histories", "masses", "kept")).alias("h"))
    spread = F.shiftrightunsigned(F.col("h.histories"), 33)
    about = (
        about.select(F.pmod(spread, F.lit(buckets.words)).cast("int").alias("bucket"), "h")
        .groupBy("bucket", F.pmod(F.xxhash64("h.histories"), F.lit(64)).alias("part"))
        .agg(F.collect_list("h").alias("h"))
        .select("bucket", F.col("h.histories").alias("keys"), F.col("h.masses").alias("masses"), F.col("h.kept").alias("kept"))
    )
    words_sent = chunks.mapInArrow(_sender(buckets, ChunkWords, _WORD_NAMES), WORDS_SENT).unionByName(about.mapInArrow(_history_rows, WORDS_SENT))
    words = stage(words_sent.groupBy("bucket").applyInArrow(_sum_words, WORDS_BACK), "word-totals", "zstd")
    once, twice = pairs.agg(F.coalesce(F.sum("once"), F.lit(0)), F.coalesce(F.sum("twice"), F.lit(0))).first()
    known = words.agg(F.coalesce(F.sum("known"), F.lit(0))).first()[0]
    smoothing = Smoothing(int(trained), int(known), int(once), int(twice))
    back = words.filter("chunk >= 0").select("chunk", F.lit(0).alias("kind"), "bucket", "totals", "masses", "kept")
    none = F.lit(None).cast("binary")
    back = back.unionByName(pairs.select("chunk", F.lit(1).alias("kind"), "bucket", "totals", none.alias("masses"), none.alias("kept")))
    read = chunks.drop("low")
    scored = read.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInArrow(_scorer(buckets, smoothing), SCORES)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(int(trained)).cast("bigint").alias("train_tokens"), "base_score", "score")
