"""The cleaning chain as column expressions.

Each step takes a text column and returns one. The steps nest, and none of them mentions its
input more than once outside exclusive branches, so the chain runs once per document.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire import fixed_values as V
from quire.functions.text import bound, character_class, is_blank, strip

_WS = character_class(V.WHITESPACE)
_INLINE_WS = character_class(V.WHITESPACE.replace("\n", ""))
_NON_WS = character_class(V.WHITESPACE, negated=True)

_CONTENTS = "()" + V.CONTENTS_BLOCK.format(ws=_WS)
# Every line break of a whitespace run leads to the same heading. Trying each of them is
# quadratic in the length of the run, so with very long runs only the first one is tried, which
# is slower on ordinary text.
_LONG_RUN = rf"\n(?:{_INLINE_WS}*+\n){{3}}{_WS}{{1000}}"
_CONTENTS_LONG = (
    rf"(?={_WS})(?:\G|(?<={_NON_WS}))({_INLINE_WS}*+)" + V.CONTENTS_BLOCK.format(ws=_WS)
)
# A whitespace run with four or more newlines, from its first newline to its last. Unrolled
# with possessive classes: no repeated group, so a run of any length uses constant stack.
_BLANK_RUN = rf"\n(?:{_INLINE_WS}*+\n){{3}}(?:{_WS}*\n)?"
# From the first line whose stripped length is at least 3 to the end of the text.
_FROM_FULL_LINE = rf"(?:\A|(?<=\n)){_INLINE_WS}*+{_NON_WS}[^\n]+{_NON_WS}(?s:.*)"
_FRONT_WORD = "|".join(re.escape(word) for word in V.FRONT_WORDS)


def _has_stars(text: Column) -> Column:
    return F.contains(text, F.lit(V.MARKER_STARS))


def _side(text: Column, pattern: str, index: int) -> Column:
    """Part of the text before (0) or after (1) the first match."""
    return F.get(F.split(text, pattern, 2), F.lit(index))


def before_end_marker(text: Column) -> Column:
    """Text up to the end marker; the whole text when there is none."""
    spaced, tight = V.END_MARKERS
    return (
        F.when(~_has_stars(text), text)
        .when(text.rlike(spaced), _side(text, spaced, 0))
        .when(text.rlike(tight), _side(text, tight, 0))
        .otherwise(text)
    )


def has_start_marker(text: Column) -> Column:
    return _has_stars(text) & reduce(lambda a, b: a | b, [text.rlike(p) for p in V.START_MARKERS])


def _acceptable(line: Column) -> Column:
    return ~is_blank(line) & ~F.lower(line).rlike(_FRONT_WORD)


def from_first_content_line(text: Column, body: Column) -> Column:
    """Drop leading boilerplate from ``body`` when ``text`` has no start marker.

    The content starts where the first acceptable leading line of ``text`` occurs first, which
    can be inside an earlier line. ``body`` is ``text`` up to its end marker. Mostly the very
    first line will do, and the others are not looked at.
    """
    lines = F.split(F.substring_index(text, "\n", V.FRONT_LINES), "\n", -1)
    first = F.get(F.filter(lines, _acceptable), F.lit(0))
    searched = F.substr(body, F.coalesce(F.position(first, text), F.lit(1)))
    return F.when(_acceptable(F.substring_index(text, "\n", 1)), body).otherwise(searched)


def between_markers(text: Column) -> Column:
    """Content between the book markers, with the line rule as fallback for the start."""
    body = before_end_marker(text)
    spaced, tight = V.START_MARKERS
    nothing = F.lit("")
    return (
        F.when(text.isNull(), text)
        .when(~_has_stars(text), from_first_content_line(text, body))
        .when(text.rlike(spaced), F.coalesce(_side(body, spaced, 1), nothing))
        .when(text.rlike(tight), F.coalesce(_side(body, tight, 1), nothing))
        .otherwise(from_first_content_line(text, body))
    )


def drop_illustrations(text: Column) -> Column:
    return F.regexp_replace(text, V.ILLUSTRATION, "")


def drop_sidenotes(text: Column) -> Column:
    return F.regexp_replace(text, V.SIDENOTE, "")


def drop_footnotes(text: Column) -> Column:
    return F.regexp_replace(text, V.FOOTNOTE, "")


def drop_transcriber_notes(text: Column) -> Column:
    return F.regexp_replace(text, V.TRANSCRIBER_NOTE, "")


def drop_contents_block(text: Column) -> Column:
    def replaced(t: Column) -> Column:
        pattern = F.when(t.rlike(_LONG_RUN), _CONTENTS_LONG).otherwise(_CONTENTS)
        return F.regexp_replace(t, pattern, F.lit("$1\n"))

    return bound(text, replaced)


def collapse_blank_runs(text: Column) -> Column:
    return F.regexp_replace(text, _BLANK_RUN, V.MAX_BLANK_RUN)


def drop_short_leading_lines(text: Column) -> Column:
    return F.regexp_extract(text, _FROM_FULL_LINE, 0)


STEPS = (
    between_markers,
    drop_illustrations,
    drop_sidenotes,
    drop_footnotes,
    drop_transcriber_notes,
    drop_contents_block,
    collapse_blank_runs,
    strip,
    drop_short_leading_lines,
)


def clean(text: Column) -> Column:
    """All steps in order. Pass a plain column: the first step mentions it several times."""
    return reduce(lambda column, step: step(column), STEPS, text)
