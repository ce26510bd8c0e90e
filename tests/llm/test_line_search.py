"""Fuzzy line dedup against all pairs of lines, by edit similarity alone."""

import random

import numpy as np
from pyspark.sql import functions as F

from quire.llm import line_dedup as L


def by_all_pairs(docs, union_find):
    lines, places = {}, {}
    for doc_id, text in docs:
        for at, words in enumerate(L.line_words(text)) if text else ():
            if len(words) >= L.MIN_WORDS:
                lines[tuple(words)] = None
                places.setdefault(tuple(words), []).append((doc_id, at))
    every, found = list(lines), union_find()
    for i, a in enumerate(every):
        found.find(i)
        for j in range(i):
            b = every[j]
            if 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)) and 5 * L.edit_distance(a, b) <= max(len(a), len(b)):
                found.join(i, j)
    groups = {}
    for i, a in enumerate(every):
        groups.setdefault(found.find(i), []).extend(places[a])
    gone = {p for members in groups.values() for p in sorted(members)[1:]}
    return {d: text and "\n".join(x for at, x in enumerate(text.split("\n")) if (d, at) not in gone) for d, text in docs}


def changed(words, edits):
    """Words after so many edits: replaced, added or removed."""
    out = list(words)
    for _ in range(edits):
        at, kind = random.randrange(len(out)), random.random()
        out[at : at + (kind < 0.8)] = [f"new{random.random()}"] if kind < 0.6 or kind >= 0.8 else []
    return out


def test_similar_lines_share_a_key():
    random.seed(1)
    for n in [*range(4, 60), 80, 100, 203]:
        for _ in range(30):
            a = [random.getrandbits(16) % (9 if n % 2 else 1 << 16) for _ in range(n)]
            b = list(a)
            spread = random.sample(range(n), n // 5) if random.random() < 0.5 else range(2, n, 5)
            for at in sorted(list(spread)[: n // 5], reverse=True):
                kind = random.random()
                b[at : at + (kind < 0.8)] = [random.getrandbits(16)] if kind < 0.6 or kind >= 0.8 else []
            if not L.similar(a, b):
                continue
            rows, keys = L.gram_keys(np.array([*a, *b], "<u2"), np.array([len(a), len(b)]))
            assert max(n, len(b)) < 5 or a == b or set(keys[rows == 0]) & set(keys[rows == 1]), (a, b)


def test_all_lines_at_the_similarity_are_found(spark, union_find):
    random.seed(7)
    docs = []
    for n in (5, 6, 9, 10, 12, 20, 28, 40, 80):
        for edits in {1, n // 10, n // 5}:
            words = [f"w{random.randrange(10**6)}" for _ in range(n)]
            docs.append((len(docs), " ".join(words)))
            docs.append((len(docs), " ".join(changed(words, edits))))
    docs.append((len(docs), "not like any of them"))
    got = {r.doc_id: r.text for r in L.deduped_lines(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert got == by_all_pairs(docs, union_find)
    assert sum(not t for t in got.values()) >= 12


def test_given_documents(spark, small, union_find):
    df = spark.read.parquet(f"{small}/documents.parquet").filter("doc_id < 120")
    docs = [(r.doc_id, r.text) for r in df.collect()]
    assert {r.doc_id: r.text for r in L.deduped_lines(df).collect()} == by_all_pairs(docs, union_find)


def test_short_and_unspaced_lines(spark):
    line = "这是一个很长的句子没有空格但是经常被复制。"
    docs = [
        (1, f"All rights reserved.\n\n---\n{line}\none own text"),
        (2, f"all rights reserved\n\n---\n{line.replace('很', '非')[:-1]}\nanother"),
    ]
    got = {r.doc_id: r.text for r in L.deduped_lines(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert got == {1: docs[0][1], 2: "\n---\nanother"}


def test_shares_of_keys_give_the_same_groups(spark, monkeypatch):
    draw = random.Random(11)
    base = [[f"w{draw.randrange(400)}" for _ in range(draw.randrange(4, 30))] for _ in range(60)]
    texts = []
    for i in range(240):
        words = list(draw.choice(base))
        words[draw.randrange(len(words))] = f"x{draw.randrange(5)}"
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")

    def result():
        return sorted((r.doc_id, r.n_removed, r.text) for r in L.deduped_lines(docs).collect())

    whole, names, stage = result(), [], L.stage
    monkeypatch.setattr(L, "MAX_UNSHARED_ROWS", 10)
    monkeypatch.setattr(L, "stage", lambda df, name: names.append((name, "words" in df.columns)) or stage(df, name))
    assert result() == whole and 0 < sum(n for _, n, _ in whole) < 240
    assert names.count(("met-keys", False)) == L.KEY_SHARES and ("line-places", False) in names


def test_lines_with_one_phrase_make_no_written_pairs(spark, monkeypatch):
    """Different lines around a phrase are ruled out where they meet, not after they were written as pairs."""
    texts = [f"of all the things that there are {' '.join(f'v{i}x{j}' for j in range(8))}" for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows, stage = {}, L.stage

    def counted(df, name):
        table = stage(df, name)
        rows[name] = table.count()
        return table

    monkeypatch.setattr(L, "stage", counted)
    monkeypatch.setattr(L, "_near", lambda *columns: F.lit(True))
    monkeypatch.setattr(L, "LINES", L.Search(L._keyed, L._described, L._near, L._verified))
    assert all(r.n_removed == 0 for r in L.deduped_lines(docs).collect())
    assert rows["mixed-keys"] >= 40 and rows["across-pairs"] < 40
