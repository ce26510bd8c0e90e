import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from quire.llm import decontamination as D


def plain_words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(text, items, window=10):
    words, hit, found = plain_words(text), set(), set()
    for item, content in items:
        own = plain_words(content)
        size = min(window, len(own))
        for i in range(len(own) - size + 1 if size else 0):
            for j in range(len(words) - size + 1):
                if words[j : j + size] == own[i : i + size]:
                    hit.update(range(j, j + size))
                    found.add(item)
    return len(words), hit, found


def covered(spans):
    return {w for a, b in spans for w in range(a, b + 1)}


@pytest.mark.parametrize("window", [1, 2, 4])
def test_automaton_against_brute_force(window):
    for seed in range(40):
        random.seed(seed)
        draw = lambda n: " ".join(random.choice("abcd") for _ in range(n))
        items = [(i, draw(random.randint(0, 9))) for i in range(6)]
        texts = [draw(random.randint(0, 25)) for _ in range(5)]
        automaton = D.ItemAutomaton(items, window)
        for text, (n, spans, found) in zip(texts, D.scan(automaton, texts)):
            expected = brute(text, items, window)
            assert (n, covered(spans), found) == expected


def test_words():
    for text in ["A-b_c9 É́ü\x7fz", "", None, "a\x80b", "...", "x" * 99, "日本 語"]:
        assert [w.decode() for w in D.normalised_words(text)] == plain_words(text)


def test_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    bench = spark.read.parquet(f"{small}/benchmark.parquet")
    items = [(r.item_id, r.text) for r in bench.collect()]
    windows = {}
    for item, content in items:
        own = plain_words(content)
        for i in range(max(1, len(own) - 9)):
            windows.setdefault(tuple(own[i : i + 10]), set()).add(item)
    got = {r.doc_id: r for r in D.contamination_rows(docs, bench).collect()}
    hits = 0
    for r in docs.collect():
        words, hit, found = plain_words(r.text), set(), set()
        for j in range(len(words)):
            if tuple(words[j : j + 10]) in windows and len(words[j : j + 10]) == 10:
                hit.update(range(j, j + 10))
                found |= windows[tuple(words[j : j + 10])]
        mine = got[r.doc_id]
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        assert (mine.n_words, mine.n_hit, mine.n_items) == (len(words), len(hit), len(found))
        assert (mine.items_sha256, mine.contaminated) == (digest, bool(hit))
        hits += bool(hit)
    assert hits


def test_blocks_give_the_same(spark, small, rows, monkeypatch):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    bench = spark.read.parquet(f"{small}/benchmark.parquet")
    whole = rows(D.contamination_rows(docs, bench))
    monkeypatch.setattr(D, "BLOCK_WORDS", 1500)
    assert sum(1 for _ in D.item_blocks(bench)) > 2
    assert rows(D.contamination_rows(docs, bench)) == whole


def test_odd_rows(spark, rows):
    items = [(1, "One two"), (1, "three"), (2, None), (3, "..."), (None, "four"), (10, "one TWO"), (5, " ".join("abcdefghijkl"))]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    data = [(1, None), (2, ""), (3, "x one-two three four"), (3, "x one-two three four"), (4, "A b c d e f g h i j k l!"), (None, "three")]
    docs = spark.createDataFrame(data, "doc_id bigint, text string").withColumn("spans", F.lit(1)).withColumn("row", F.lit(2))
    got = rows(D.contamination_rows(docs, bench), "doc_id", "n_words", "n_hit", "n_items")
    assert got == sorted([(1, 0, 0, 0), (2, 0, 0, 0), (3, 5, 4, 2), (3, 5, 4, 2), (4, 12, 12, 1), (None, 1, 1, 1)], key=repr)
    assert D.contamination_rows(docs.limit(0), bench).count() == 0
    assert {r.n_hit for r in D.contamination_rows(docs, bench.limit(0)).collect()} == {0}


def test_ids_may_be_text_or_missing(spark):
    bench = spark.createDataFrame([("q-2", "one two"), ("q-10", "two three"), (None, "four"), ("", "five")], "item_id string, text string")
    docs = spark.createDataFrame([(1, "one two three"), (2, "four"), (3, "five")], "doc_id bigint, text string")
    got = {r.doc_id: r for r in D.contamination_rows(docs, bench).collect()}
    assert [(got[i].n_hit, got[i].n_items, got[i].contaminated) for i in (1, 2, 3)] == [(3, 2, True), (1, 0, True), (1, 1, True)]
    import hashlib

    assert got[1].items_sha256 == hashlib.sha256(b"q-10,q-2").hexdigest() and got[2].items_sha256 == hashlib.sha256(b"").hexdigest()


def test_decontaminate(spark, rows):
    bench = spark.createDataFrame([(1, "a b c d"), (2, "e f g h")], "item_id bigint, text string")
    data = [
        (1, "clean Text, kept as it is."),
        (2, "long enough words before A b, c d and after the span here"),
        (3, "a b c d"),
        (4, "one two three four five six a b e f g h c d seven eight nine ten"),
        (5, None),
    ]
    docs = spark.createDataFrame(data, "doc_id bigint, text string").withColumn("lang", F.lit("en"))
    clean = D.decontaminate(docs, bench, window=4, max_coverage=0.5)
    assert clean.columns == docs.columns
    assert rows(clean, "doc_id", "text") == sorted(
        [
            (1, data[0][1]),
            (2, "long enough words before \n and after the span here"),
            (4, "one two three four five six \n seven eight nine ten"),
            (5, None),
        ],
        key=repr,
    )
