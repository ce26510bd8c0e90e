"""Ids of a byte-level vocabulary for whole texts, however long their runs of blanks."""

from __future__ import annotations

import re
import uuid

import numpy as np

from quire.llm.packing import WORDS

# The library's pattern engine runs out of stack within longer runs of blanks.
_LONG_RUN = 100_000
_BLANKS = re.compile(r"[\t-\r \x85\xa0  -     　]{%d,}" % _LONG_RUN)


def plain_encoder(ranks: dict[bytes, int]):
    """A function from a text to its ids; special tokens in a text are plain text."""
    import tiktoken

    model = tiktoken.Encoding(uuid.uuid4().hex, pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
    encode = lambda part: model.encode_to_numpy(part, disallowed_special=()).astype(np.int64)

    def ids(text: str) -> np.ndarray:
        if len(text) < _LONG_RUN:
            return encode(text)
        # A run before other text is one word but for its last blank, and at the end it is one word.
        parts, low = [], 0
        for run in _BLANKS.finditer(text):
            end = run.end() - (run.end() < len(text))
            parts += [encode(text[low : run.start()]), encode(text[run.start() : end])]
            low = end
        return np.concatenate([*parts, encode(text[low:])])

    return ids
