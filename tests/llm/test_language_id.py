import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import language_id as L
from quire.llm.queries import QUERIES

SAMPLES = [("aa", "abab abba baab abab"), ("cc", "cdcd dccd cddc dcdc")] * 3


def test_gradient_is_the_slope():
    network = L.BidirectionalGru(["x", "y"], hidden=3, seed=1)
    network.parameters = {k: v.astype(np.float64) for k, v in network.parameters.items()}
    random = np.random.default_rng(2)
    data = random.integers(0, 256, size=(7, 4)).astype(np.uint8)
    mask = np.ones((7, 4), np.float32)
    mask[5:, 1] = 0
    target, weight = np.array([0, 1, 1, 0]), mask.copy()
    _, gradient = network.gradient(data, mask, target, weight)
    for name, values in network.parameters.items():
        places = [tuple(random.integers(s) for s in values.shape) for _ in range(4)]
        if name.endswith("_in"):
            places = [(int(data[random.integers(7), random.integers(4)]), p[1]) for p in places]
        for at in places:
            old, losses = values[at], []
            for step in (1e-3, -1e-3):
                values[at] = old + step
                losses.append(network.gradient(data, mask, target, weight)[0])
            values[at] = old
            assert gradient[name][at] == pytest.approx((losses[0] - losses[1]) / 2e-3, abs=2e-3)


def test_padding_changes_nothing():
    network = L.BidirectionalGru(["x", "y"], seed=3)
    data = np.frombuffer(b"some text", np.uint8)[:, None]
    padded = np.concatenate([data, np.zeros((6, 1), np.uint8)])
    mask = (np.arange(15) < 9).astype(np.float32)[:, None]
    plain, _ = network.probabilities(data, np.ones((9, 1), np.float32))
    longer, _ = network.probabilities(padded, mask)
    assert np.allclose(plain, longer[:9], atol=1e-6)


def test_learns_and_pools(monkeypatch):
    monkeypatch.setattr(L, "STEPS", 60)
    network = L.train(SAMPLES)
    found = L.label_texts(network, ["abba abab", "dcdc cdcd", "ABAB " * 400, "cd"])
    assert [network.languages[i] for i in found.argmax(1)] == ["aa", "cc", "aa", "cc"]
    assert np.allclose(found.sum(1), 1, atol=1e-4)
    # a long text is the letter-weighted mean of its segments
    text = "abab cdcd " * 60
    parts = [text[i : i + L.SEGMENT] for i in range(0, len(text), L.SEGMENT)]
    letters = np.array([sum(c.isalpha() for c in p) for p in parts])
    expected = (L.label_texts(network, parts) * letters[:, None]).sum(0) / letters.sum()
    assert np.allclose(L.label_texts(network, [text])[0], expected, atol=1e-5)


def test_letters():
    assert [L.has_letter(t) for t in (None, "", "12 ²Ⅷ!?_", "é", "日", "x1")] == [False, False, False, True, True, True]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op7_language_id"](spark, "/root/testdata/sf0.01").collect()}
    truth = {r.doc_id: r.lang for r in docs.collect()}
    assert set(got) == set(truth)
    assert all(0 <= r.score <= 1 and r.held_out == L.held_out(d) for d, r in got.items())
    held = [d for d in truth if L.held_out(d)]
    assert np.mean([got[d].lang_pred == truth[d] for d in held]) >= 0.95


def test_sample_is_bounded_and_of_training_documents(spark, small, monkeypatch):
    monkeypatch.setattr(L, "SAMPLE", 10)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labelled = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, "no").otherwise(F.col("lang")))
    sample = L.training_sample(labelled)
    assert {lang for lang, _ in sample} == {"en", "fr", "de", "es"}
    assert len(sample) < 4 * 10 * L.SNIPPETS * 2
    assert all(len(text) <= L.SNIPPET for _, text in sample)


def test_odd_rows(spark, rows, monkeypatch):
    monkeypatch.setattr(L, "STEPS", 60)
    data = [(i, text, lang) for i, (lang, text) in enumerate(SAMPLES * 4)]
    data += [(100, None, "aa"), (101, "", None), (102, "123 !", "cc"), (103, "ab" * 50_000, None), (None, "cdcd", None), (None, "cdcd", None)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, lang string").withColumn("score", F.lit("own"))
    got = rows(L.language_rows(docs).filter("doc_id is null or doc_id >= 100"), "doc_id", "lang_pred")
    assert got == sorted([(100, "und"), (101, "und"), (102, "und"), (103, "aa"), (None, "cc"), (None, "cc")], key=repr)
    assert L.language_rows(docs.limit(0)).count() == 0
    nothing = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in L.language_rows(nothing).collect()} == {"und"}


def test_a_hot_id_or_row_is_chosen_once(spark):
    trained = next(i for i in range(100) if not L.held_out(i))
    rows = [(trained, "the same text " * 20, "en")] * 3000 + [(trained, f"text number {i} of one id", "en") for i in range(3000)]
    rows += [(None, f"nameless {i}", "fr") for i in range(2000)]
    sample = L.training_sample(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    for lang in ("en", "fr"):
        assert 0 < sum(g == lang for g, _ in sample) <= L.SAMPLE * L.SNIPPETS
    assert sum("same text" in s for _, s in sample) <= L.SNIPPETS


def test_against_plain_loops():
    """The network step by step, one position and one text at a time."""
    network = L.train([("en", "the cat and the dog " * 9), ("de", "der hund und die katze " * 9), ("fr", "le chat et le chien été " * 9)])
    p, h = network.parameters, network.hidden
    gate = lambda x: np.clip(x * 0.25 + 0.5, 0, 1)

    def states(side, content):
        state, out = np.zeros(h), []
        for byte in content:
            a, g = p[f"{side}_in"][byte], state @ p[f"{side}_state"]
            update, reset = gate(a[:h] + g[:h]), gate(a[h : 2 * h] + g[h : 2 * h])
            candidate = np.tanh(a[2 * h :] + reset * g[2 * h :])
            state = update * state + (1 - update) * candidate
            out.append(state)
        return out

    def pooled(text):
        content, found = text.lower().encode(), []
        for low in range(0, len(content), L.SEGMENT):
            part = content[low : low + L.SEGMENT]
            backward = states("backward", part[::-1])[::-1]
            for byte, f, b in zip(part, states("forward", part), backward):
                logits = np.concatenate([f, b]) @ p["out"] + p["bias"]
                if 97 <= byte <= 122 or byte >= 128:
                    found.append(np.exp(logits - logits.max()) / np.exp(logits - logits.max()).sum())
        return np.mean(found, axis=0)

    texts = ["The dog", "Le chien a été là. " * 20, "x", "der 12 hund, 東京 " * 12]
    for mine, text in zip(L.label_texts(network, texts), texts):
        assert np.allclose(mine, pooled(text), atol=1e-4)
