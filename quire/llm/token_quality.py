"""Quality rules on tokenizer fertility, with bands per language or script learned from the whole corpus.

Two public vocabularies measure every whole text: characters per token and the entropy of the token
distribution (as a share of the highest that so many tokens, up to ``ENTROPY_TOKENS``, can have) with a byte-level one, and the share
of byte-fallback tokens with a piece vocabulary. What is normal depends on the language, or, where none is
given, on the script that most letters of the text belong to. Per such ``band`` the median of each measure is
taken over all documents that pass the base rules. A document is rejected when it has

* fewer characters per token than ``1 / SPREAD`` of its band's median, or more than ``SPREAD`` times it,
* a share of byte tokens above ``FALLBACK_FACTOR`` times the median plus ``FALLBACK_SLACK``,
* an entropy below ``ENTROPY_SHARE`` of the median.

Medians are exact to a step of a histogram: counts per step and band are combined before the shuffle and
bounded in number, so a band with all documents is no hot group. Medians come back to the rows by ``join_counts``,
since languages have no bounded number.

Defined cases: a null or empty text has no words, fails the base rules and has the script ``none``, as has a
text without letters; texts without tokens have null measures, and a band without a document that passes the
base rules rejects nothing. Rows stand for themselves, whether ids
repeat or are null; other columns are ignored; no rows give no rows. A text has to fit in a task.
"""

from __future__ import annotations

import uuid
from bisect import bisect
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.byte_tokens import plain_encoder
from quire.llm.counted_joins import SHARED_KEYS, join_counts
from quire.llm.packing import vocabulary
from quire.staging import stage

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
SPREAD = 1.5
FALLBACK_FACTOR, FALLBACK_SLACK = 3.0, 0.1
ENTROPY_SHARE = 0.6
# Beyond so many tokens the entropy of a text hardly grows with its length.
ENTROPY_TOKENS = 1024
STEP = 0.005
SYMBOLS = "#*$%&|<>"
NO_SCRIPT = "none"
# First code points of runs of characters of one script (Unicode blocks); letters elsewhere are "other".
SCRIPTS = (
    (0x0041, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0780, "other"), (0x0900, "devanagari"), (0x0980, "indic"), (0x0E00, "thai"),
    (0x0E80, "other"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"),
    (0x2000, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"),
    (0xD7A4, "other"), (0xF900, "han"), (0xFB00, "other"), (0x20000, "han"), (0x32000, "other"),
)
_STARTS = [start for start, _ in SCRIPTS]
_NAMES = [name for _, name in SCRIPTS]
_BLANK, _SYMBOL = list(b" \t\n\x0b\x0c\r"), list(SYMBOLS.encode())
_MEASURES = ("chars_per_token", "fallback_share", "entropy_share")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MEASURED = (
    "doc_id bigint, lang string, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", script string, n_tokens bigint, n_pieces bigint, "
    + ", ".join(f"{m} double" for m in _MEASURES)
)


def _byte_counts(content: bytes) -> np.ndarray:
    return np.bincount(np.frombuffer(content, np.uint8), minlength=256)


def script_of(text: str, seen: np.ndarray | None = None) -> str:
    """The script of most letters; of equal ones the first by name. ``seen`` counts the text's bytes."""
    seen = _byte_counts(text.encode()) if seen is None else seen
    counts: Counter = Counter()
    if ascii_letters := int(seen[65:91].sum() + seen[97:123].sum()):
        counts["latin"] = ascii_letters
    if not text.isascii():
        codes, times = np.unique(np.frombuffer(text.encode("utf-32-le"), "<u4"), return_counts=True)
        for code, n in zip(codes.tolist(), times.tolist()):
            if code > 127 and chr(code).isalpha():
                counts[_NAMES[bisect(_STARTS, code) - 1]] += n
    return min(counts, key=lambda s: (-counts[s], s)) if counts else NO_SCRIPT


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def repeated_words(words: list[bytes]) -> int:
    """Words within a window of three that occurs twice or more."""
    if len(words) < 4:
        return 0
    numbers = _Numbers()
    ids = np.array(list(map(numbers.__getitem__, words)), np.int64)
    first, bits = ids[:-2], 21
    if len(numbers) >> 21:
        # Too many words for one number per window: pairs are numbered first.
        first, bits = np.unique(ids[:-2] << 31 | ids[1:-1], return_inverse=True)[1], 31
        windows = first << bits | ids[2:]
    else:
        windows = first << 2 * bits | ids[1:-1] << bits | ids[2:]
    ordered = np.sort(windows)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(again):
        return 0
    at = np.minimum(np.searchsorted(again, windows), len(again) - 1)
    found = np.flatnonzero(again[at] == windows)
    covered = np.zeros(len(ids), bool)
    for shift in range(3):
        covered[found + shift] = True
    return int(covered.sum())


def base_counts(text: str, content: bytes, seen: np.ndarray) -> tuple[int, int, int, int, int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``; ``seen`` counts the bytes of ``content``."""
    words = content.split()
    lines = [line for line in content.split(b"\n") if line.strip()]
    chars = len(text) - int(seen[_BLANK].sum())
    return len(words), chars, int(seen[_SYMBOL].sum()), len(lines) - len(set(lines)), repeated_words(words)


def entropy_share(ids: np.ndarray) -> float | None:
    """Entropy of the ids as a share of that of as many, or ``ENTROPY_TOKENS``, different ids; None for fewer than two."""
    if len(ids) < 2:
        return None
    p = np.unique(ids, return_counts=True)[1] / len(ids)
    return float(-(p * np.log2(p)).sum() / np.log2(min(len(ids), ENTROPY_TOKENS)))


class Meter:
    def __init__(self, ranks: dict[bytes, int], pieces: bytes):
        import sentencepiece

        self.bytes_ids = plain_encoder(ranks)
        model = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        self.piece_ids = lambda text: np.array(model.encode(text), np.int64)
        self.is_byte = np.array([model.is_byte(i) for i in range(model.get_piece_size())])

    def measure(self, text: str | None) -> tuple:
        """The columns of ``MEASURED`` after ``lang``."""
        if not text:
            return *[0] * len(COUNTS), NO_SCRIPT, 0, 0, None, None, None
        content = text.encode()
        seen = _byte_counts(content)
        base = base_counts(text, content, seen)
        ids, pieces = self.bytes_ids(text), self.piece_ids(text)
        fallback = float(self.is_byte[pieces].mean()) if len(pieces) else None
        return *base, script_of(text, seen), len(ids), len(pieces), len(text) / len(ids), fallback, entropy_share(ids)


_METERS: dict[str, Meter] = {}


def measured(docs: DataFrame, bytes_path: str, pieces_path: str) -> DataFrame:
    """Counts and measures of every row, written."""
    with open(pieces_path, "rb") as file:
        definition = docs.sparkSession.sparkContext.broadcast((vocabulary(bytes_path), file.read()))
    name = uuid.uuid4().hex
    kinds = {"doc_id": "bigint", "lang": "string", "text": "string"}
    narrow = docs.select(*[F.col(c).cast(kind).alias(c) for c, kind in kinds.items()])
    schema = pa.schema([(name, _ARROW[kind]) for name, kind in (column.split() for column in MEASURED.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _METERS:
            _METERS.clear()
            _METERS[name] = Meter(*definition.value)
        meter = _METERS[name]
        for batch in batches:
            rows = [meter.measure(t.as_py()) for t in batch["text"]]
            found = [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(list(schema)[2:])]
            columns = [batch["doc_id"], batch["lang"].cast(pa.string()), *found]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return stage(narrow.mapInArrow(run, MEASURED), "fertility")


_ARROW = {"bigint": pa.int64(), "string": pa.string(), "double": pa.float64()}


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))


def bands(rows: DataFrame) -> DataFrame:
    """``(band, n, <measure>...)``: rows, and lower medians to ``STEP`` over those that pass the base rules."""
    at = [F.struct(F.lit(m).alias("measure"), F.floor(F.col(m) / STEP).alias("at")) for m in _MEASURES]
    steps = rows.filter(~base_failed()).select("band", F.inline(F.array(*at))).filter("at is not null")
    counts = steps.groupBy("band", "measure", "at").agg(F.count("*").alias("n"))
    group = Window.partitionBy("band", "measure")
    below = F.sum("n").over(group.orderBy("at").rowsBetween(Window.unboundedPreceding, -1))
    reach = counts.withColumns({"_below": F.coalesce(below, F.lit(0)), "_all": F.sum("n").over(group)})
    middle = reach.filter((2 * F.col("_below") < F.col("_all")) & (2 * (F.col("_below") + F.col("n")) >= F.col("_all")))
    medians = middle.groupBy("band").pivot("measure", list(_MEASURES)).agg(F.first(F.col("at") * STEP))
    return rows.groupBy("band").agg(F.count("*").alias("n")).join(medians, "band", "left")


def judged(measures: DataFrame, spread: float = SPREAD, shared: int = SHARED_KEYS) -> DataFrame:
    """``measures``, a written table, with ``base_failed``, ``rejected_by`` (names of failed rules) and ``kept``."""
    rows = measures.withColumn("band", F.coalesce("lang", "script"))
    normal = stage(bands(rows).withColumnsRenamed({m: f"_{m}" for m in _MEASURES}), "bands")
    value, usual = {m: F.col(m) for m in _MEASURES}, {m: F.col(f"_{m}") for m in _MEASURES}
    chars, fallback, entropy = _MEASURES
    failed = {
        "chars_per_token_low": value[chars] * spread < usual[chars],
        "chars_per_token_high": value[chars] > (usual[chars] + STEP) * spread,
        "byte_fallback": value[fallback] > (usual[fallback] + STEP) * FALLBACK_FACTOR + FALLBACK_SLACK,
        "entropy": value[entropy] < usual[entropy] * ENTROPY_SHARE,
    }
    names = F.concat_ws(",", *[F.when(rule, F.lit(name)) for name, rule in failed.items()])
    rows = join_counts(rows, normal, ["band"], "n", shared)
    rows = rows.withColumns({"base_failed": base_failed(), "rejected_by": names})
    rows = rows.withColumn("kept", ~F.col("base_failed") & (F.col("rejected_by") == ""))
    return rows.drop("n", *[f"_{m}" for m in _MEASURES])


def quality_rows(docs: DataFrame, bytes_path: str, pieces_path: str) -> DataFrame:
    """A row per document: base counts, the verdict, and what it is based on."""
    rows = judged(measured(docs, bytes_path, pieces_path))
    return rows.select("doc_id", *COUNTS, "base_failed", "kept", "rejected_by", "band", "script", "n_tokens", "n_pieces", *_MEASURES)
