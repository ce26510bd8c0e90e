import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quire.llm import lm_scoring as M


class PlainModel:
    """The same model as counts in dictionaries, read word by word."""

    def __init__(self, texts):
        self.words, self.pairs = Counter(), Counter()
        for text in texts:
            own = M.tokens(text)
            self.words.update(own)
            self.pairs.update(zip([M.END, *own], own))
        self.n, self.v = sum(self.words.values()), len(self.words)
        once, twice = (sum(c == k for c in self.pairs.values()) for k in (1, 2))
        self.discount = once / (once + 2 * twice) if once else 0.5
        self.followers = {}
        for (h, w), c in self.pairs.items():
            if c >= M.CUTOFF:
                self.followers.setdefault(h, {})[w] = c

    def unigram(self, word):
        return (self.words[word] + 0.5) / (self.n + 0.5 * (self.v + 1))

    def probability(self, state, word):
        own = self.followers.get(state, {})
        taken = sum(c - self.discount for c in own.values()) / self.words[state] if own else 0.0
        explicit = (own[word] - self.discount) / self.words[state] if word in own else 0.0
        return explicit + (1 - taken) * self.unigram(word)

    def score(self, text):
        state, total = M.END, 0.0
        for word in M.tokens(text):
            total += math.log10(self.probability(state, word))
            state = word
        return total


def check(df, texts):
    model = PlainModel([t for d, t in texts if not M.held_out(d)])
    expected = []
    for d, text in texts:
        own = M.tokens(text)
        base = sum(math.log10(model.unigram(w)) for w in own)
        expected.append((d, M.held_out(d), len(own), sum(model.words[w] > 0 for w in own), model.n, base, model.score(text)))
    got = [tuple(r) for r in M.score_documents(df).collect()]
    assert len(got) == len(expected)
    for a, b in zip(sorted(got, key=repr), sorted(expected, key=repr)):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)
    return model


def test_held_out_rule():
    import zlib

    assert M.held_out(17) == (zlib.crc32(b"17") % 5 == 1)


def test_probabilities_sum_to_one():
    random.seed(1)
    texts = [" ".join(random.choice("abcde") for _ in range(random.randint(0, 20))) for _ in range(30)]
    model = PlainModel(texts)
    for state in [*model.words, b"never seen"]:
        seen = sum(model.probability(state, w) for w in model.words)
        assert seen + model.probability(state, b"unknown") == pytest.approx(1)


@pytest.mark.parametrize("tokens", [M.BUCKET_TOKENS, 300])
def test_given_documents(spark, small, monkeypatch, tokens):
    """With many small chunks and buckets as well."""
    monkeypatch.setattr(M, "BUCKET_TOKENS", tokens)
    df = spark.read.parquet(f"{small}/documents.parquet").repartition(3)
    check(df, [(r.doc_id, r.text) for r in df.collect()])


def test_chunk_rows():
    chunk = M._Chunk()
    chunk.add(1, "a b A")
    chunk.add(2, None)
    row = chunk.row(9).to_pylist()[0]
    assert (row["stream"], row["sizes"], row["doc_ids"]) == ([1, 2, 1, 0, 0], [4, 1], [1, 2])
    assert len(row["hashes"]) == 3


def test_odd_rows(spark):
    texts = [(1, None), (2, ""), (3, "A a\x0bb\tÉ"), (3, "A a\x0bb\tÉ"), (None, "a a a a"), (5, "long word " * 30_000)]
    df = spark.createDataFrame(texts, "doc_id bigint, text string").withColumn("score", F.lit("x")).withColumn("chunk", F.lit(1))
    check(df, texts)
    assert M.score_documents(df.limit(0)).count() == 0


def test_only_held_out_documents(spark):
    texts = [(i, "a b") for i in range(60) if M.held_out(i)]
    check(spark.createDataFrame(texts, "doc_id bigint, text string"), texts)


def test_better_than_the_base_on_held_out_texts(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = M.score_documents(df).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > held[1]
