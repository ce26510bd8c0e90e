"""What line dedup writes on its way stays near the number of its lines."""

import random

import numpy as np
import pytest

from quire.llm import line_dedup as L


@pytest.fixture
def written(monkeypatch):
    """Rows of each written table, by name."""
    rows, stage = {}, L.stage

    def counted(df, name):
        table = stage(df, name)
        rows[name] = rows.get(name, 0) + table.count()
        return table

    monkeypatch.setattr(L, "stage", counted)
    return rows


def test_unlike_long_lines_are_no_pairs(spark, written):
    """256 classes do not tell lines of 500 words from each other."""
    draw = random.Random(3)
    phrase = [f"p{i}" for i in range(60)]
    texts = [" ".join([*phrase, *(f"w{draw.randrange(10**6)}" for _ in range(440))]) for _ in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert all(r.n_removed == 0 for r in L.deduped_lines(docs).collect())
    assert written["met-keys"] > 0 and written["line-pairs"] == 0


def test_common_phrases_are_no_keys(spark, written):
    texts = [f"of all the things that there are {' '.join(f'v{i}x{j}' for j in range(8))}" for i in range(1_200)]
    texts.append(texts[7].replace("v7x3", "other"))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert [r.doc_id for r in L.deduped_lines(docs).filter("n_removed > 0").collect()] == [1_200]
    assert written["met-keys"] < 200


def test_any_levels_find_similar_lines():
    draw = random.Random(5)
    for n in [*range(4, 40), 99, 161, 1_001]:
        a = [draw.getrandbits(32) % (7 if n % 3 == 0 else 1 << 32) for _ in range(n)]
        b = list(a)
        for at in draw.sample(range(n), n // 5):
            b[at] = draw.getrandbits(32)
        levels = np.array([draw.randrange(64) for _ in range(1 << 10)], np.uint8)
        if n > 4 and a != b and L.similar(a, b):
            rows, keys = L.gram_keys(np.array([*a, *b], "<u4"), np.array([n, n]), levels)
            assert set(keys[rows == 0]) & set(keys[rows == 1])


def test_odd_lines_have_the_words_of_line_words():
    texts = ["", None, "\n\n", " A b\n\nc ---\n", "这是 x", "é" * 9 + " " + "abcdefghij" * 5, "a\tb\r\nA B"]
    numbers, places, ids, sizes, words = L.hashed_lines(texts)
    expected = [(i, at, w) for i, t in enumerate(texts) if t for at, w in enumerate(L.line_words(t)) if w]
    assert [(i, at, len(w)) for i, at, w in expected] == list(zip(numbers.tolist(), places.tolist(), sizes.tolist()))
    flat = [w for *_, line in expected for w in line]
    assert len(set(zip(flat, words.tolist()))) == len(set(flat)) == len(set(words.tolist()))
    lines = [tuple(w) for *_, w in expected]
    assert len(set(zip(lines, ids.tolist()))) == len(set(lines)) == len(set(ids.tolist()))
