import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quire.llm import simhash_dedup as S


def plain(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(small, spark):
    texts = [r.text for r in spark.read.parquet(f"{small}/documents.parquet").limit(60).collect()]
    for text in [*texts, None, "", " \t\n", "One", "one TWO", "ÉA b\x0bc\x85d", "a a a a a", "x " * 300]:
        assert S.fingerprint(text) == plain(text)


def test_blocks_of_shingles(monkeypatch):
    text = " ".join(f"w{i % 37}" for i in range(500))
    whole = S.fingerprint(text)
    monkeypatch.setattr(S, "_BLOCK", 16)
    assert S.fingerprint(text) == whole


def test_codewords_within_four():
    random.seed(1)
    words = np.array([random.getrandbits(23) for _ in range(30)])
    rows, index = S.codewords(words)
    found = {}
    for r, i in zip(rows, index):
        found.setdefault(int(r), set()).add(int(i))
    every = []
    for info in range(4096):
        value = info << 11
        rest = value
        for bit in range(22, 10, -1):
            if rest >> bit & 1:
                rest ^= S.GOLAY << (bit - 11)
        every.append(value | rest)
    for r, word in enumerate(words.tolist()):
        assert found[r] == {i for i, c in enumerate(every) if bin(c ^ word).count("1") <= 4}
        assert len(found[r]) in (1, 6)


def test_every_pair_within_two_bits_shares_a_key():
    random.seed(2)
    base = random.getrandbits(64)
    others = [base] + [base ^ (1 << i) for i in range(64)]
    others += [base ^ (1 << i) ^ (1 << j) for i in range(64) for j in range(i)]
    rows, keys = S.fuzzy_keys(np.array(others, np.uint64))
    by_row = {}
    for r, k in zip(rows, keys):
        by_row.setdefault(int(r), set()).add(int(k))
    assert all(by_row[0] & by_row[i] for i in range(1, len(others)))


@pytest.mark.parametrize("dense", [S.DENSE, 2])
def test_components_against_all_pairs(spark, rows, union_find, monkeypatch, dense):
    monkeypatch.setattr(S, "DENSE", dense)
    random.seed(dense)
    values = []
    for _ in range(25):
        base = random.getrandbits(64)
        values += [base ^ sum(1 << b for b in random.sample(range(64), random.randint(0, 4))) for _ in range(30)]
    items, found = sorted({S._signed(v) for v in values}), union_find()
    for i, v in enumerate(items):
        for w in items[:i]:
            if bin((v ^ w) & (1 << 64) - 1).count("1") <= 2:
                found.join(v, w)
    distinct = spark.createDataFrame([(v,) for v in items], "fp bigint")
    got = {r.id: r.component for r in S.components(S.links(distinct)).collect()}
    assert {v: got.get(v, v) for v in items} == {v: found.find(v) for v in items}


def test_documents(spark, small, union_find):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    prints = {k: plain(t) for k, t in texts.items()}
    found, keys = union_find(), sorted(prints)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if bin(prints[a] ^ prints[b]).count("1") <= 2:
                found.join(a, b)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in S.component_rows(docs).collect()}
    assert got == {k: (f"{prints[k]:016x}", found.find(k)) for k in keys}


def test_odd_rows(spark, rows):
    data = [(4, None), (2, ""), (9, "a b"), (9, "a b"), (None, "a b"), (None, "lonely words here now")]
    docs = spark.createDataFrame(data, "doc_id bigint, text string").withColumn("fp", F.lit("x")).withColumn("rep", F.lit(1))
    got = rows(S.near_duplicates(docs), "doc_id", "component_id")
    assert got == sorted([(4, 2), (2, 2), (9, 9), (9, 9), (None, 9), (None, None)], key=repr)
    assert S.component_rows(docs.limit(0)).count() == 0
