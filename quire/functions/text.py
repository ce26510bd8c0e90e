"""Small text expressions: decoding, newlines, whitespace."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.fixed_values import WHITESPACE

_ESCAPE = "\u0001"
_REPLACEMENT = "\ufffd"


def decode_lossy(content: Column) -> Column:
    """UTF-8 bytes as text, with the invalid bytes left out.

    Spark's repair function marks invalid bytes with U+FFFD. Genuine U+FFFD characters are
    escaped before the repair so that only the marks are removed.
    """
    text = content.cast("string")
    escaped = F.replace(
        F.replace(text, F.lit(_ESCAPE), F.lit(_ESCAPE + "A")),
        F.lit(_REPLACEMENT),
        F.lit(_ESCAPE + "B"),
    )
    without_marks = F.replace(F.make_valid_utf8(escaped), F.lit(_REPLACEMENT), F.lit(""))
    repaired = F.replace(
        F.replace(without_marks, F.lit(_ESCAPE + "B"), F.lit(_REPLACEMENT)),
        F.lit(_ESCAPE + "A"),
        F.lit(_ESCAPE),
    )
    return F.when(F.is_valid_utf8(text), text).otherwise(repaired)


def universal_newlines(text: Column) -> Column:
    """CRLF and lone CR become LF."""
    return F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def strip(text: Column) -> Column:
    """Remove Unicode whitespace at both ends (``trim`` removes spaces only)."""
    return F.btrim(text, F.lit(WHITESPACE))


def is_blank(text: Column) -> Column:
    return strip(text) == F.lit("")


def character_class(characters: str, negated: bool = False) -> str:
    """Regex class of the given characters; neighbouring code points become ranges."""
    ranges: list[list[int]] = []
    for code in sorted(map(ord, characters)):
        if ranges and code == ranges[-1][1] + 1:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    body = "".join(rf"\x{{{low:x}}}-\x{{{high:x}}}" for low, high in ranges)
    return f"[{'^' if negated else ''}{body}]"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
