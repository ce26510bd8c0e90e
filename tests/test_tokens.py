import pytest
from pyspark.sql import functions as F

from quire.operators import tokens as T

TEXTS = ["The cat, the cat.", "naïve 東京 x1", "", "\U0001F600 the\nend", "  "]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(str(i), t) for i, t in enumerate(TEXTS)], "doc_id string, text string").repartition(2)


def _ids(df):
    return {r.doc_id: r.tokens for r in df.collect()}


def test_word_vocabulary_and_ids(docs):
    tokenizer = T.WordTokenizer.fit(docs)
    ids = {r.token: (r.id, r.n) for r in tokenizer.vocabulary.collect()}
    assert ids["cat"] == (2, 2) and ids["the"] == (3, 2) and ids[","] == (4, 1)
    assert tokenizer.vocab_size == len(ids) + 2
    got = _ids(tokenizer.transform(docs))
    assert got["0"] == [ids[w][0] for w in ["The", "cat", ",", "the", "cat", "."]] + [0]
    assert got["1"] == [ids[w][0] for w in ["naïve", "東京", "x1"]] + [0]
    assert got["2"] == got["4"] == [0]
    assert got["3"] == [ids[w][0] for w in ["\U0001F600", "the", "end"]] + [0]


@pytest.mark.parametrize("n", [0, 1, 3, 100])
def test_same_ids_for_any_number_of_shared_words(docs, spark, n):
    known = T.WordTokenizer.fit(docs.filter("doc_id in ('0', '3')"))
    other = T.WordTokenizer(known.vocabulary, shared_words=n)
    assert _ids(known.transform(docs)) == _ids(other.transform(docs))
    assert _ids(other.transform(docs))["1"] == [1, 1, 1, 0]


@pytest.mark.parametrize("n", [0, 100])
def test_repeated_and_missing_keys_keep_their_words(spark, n):
    rows = [("a", "x y"), ("a", "y z"), (None, "x"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    tokenizer = T.WordTokenizer(T.WordTokenizer.fit(docs).vocabulary, shared_words=n)
    got = sorted(((r.doc_id, r.tokens) for r in tokenizer.transform(docs).collect()), key=repr)
    assert got == sorted([("a", [2, 3, 0]), ("a", [3, 4, 0]), (None, [2, 0]), (None, [0])], key=repr)


def test_long_words_are_joined(spark):
    long = "w" * 100
    docs = spark.createDataFrame([("a", f"{long} b {long}")], "doc_id string, text string")
    tokenizer = T.WordTokenizer.fit(docs)
    assert _ids(tokenizer.transform(docs))["a"] == [2, 3, 2, 0]
    assert _ids(T.WordTokenizer(tokenizer.vocabulary).transform(docs))["a"] == [2, 3, 2, 0]


def test_bytes(docs):
    got = _ids(T.ByteTokenizer().transform(docs))
    for i, text in enumerate(TEXTS):
        assert got[str(i)] == list(text.encode()) + [10, 256, 10]


def test_bytes_of_missing_text_and_slices(spark):
    df = spark.createDataFrame([(str(i), None if i % 3 == 0 else "ä" * (i % 5)) for i in range(100)], "doc_id string, text string")
    got = _ids(T.ByteTokenizer().transform(df.filter("doc_id <> '7'")))
    for i in range(100):
        if i != 7:
            expected = b"" if i % 3 == 0 else ("ä" * (i % 5)).encode()
            assert got[str(i)] == list(expected) + [10, 256, 10]


def test_stories(docs):
    assert {r.doc_id: r.text for r in T.stories(docs).collect()} == {
        "0": TEXTS[0], "1": TEXTS[1], "3": TEXTS[3]
    }


def test_framing(spark):
    framed = spark.createDataFrame([("x",)], "t string").select(T.frame(F.col("t"), "<eos>")).first()[0]
    assert framed == "x\n<eos>\n"


def _encoded(docs, monkeypatch, **options):
    """The tokens, and the written table of ids and numbered words that they come from."""
    written, stage = [], T.stage
    monkeypatch.setattr(T, "stage", lambda df, name: written.append(stage(df, name)) or written[-1])
    got = _ids(T.WordTokenizer(T.WordTokenizer.fit(docs).vocabulary, **options).transform(docs))
    return got, written[-1]


def test_a_rare_word_meets_the_vocabulary_once_a_chunk(spark, monkeypatch):
    rows = [(str(i), "b a a c" if i % 2 else "" if i % 3 else "c d") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id string, text string").coalesce(1)
    expected = _ids(T.WordTokenizer.fit(docs).transform(docs))
    for words, chunks in ((1000, 1), (12, None), (1, 60)):
        monkeypatch.setattr(T, "CHUNK_WORDS", words)
        got, table = _encoded(docs, monkeypatch, shared_words=0)
        assert got == expected
        met = table.select("_w.chunk", F.inline("_w.rare"))
        assert met.count() == met.select("chunk", "token").distinct().count() == met.select("chunk", "code").distinct().count()
        if chunks:
            assert table.select("_w.chunk").distinct().count() == chunks
        if chunks == 1:
            assert met.count() == 4


def test_few_texts_at_once_go_to_python(spark, docs):
    setting, before = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    tokenizer = T.WordTokenizer.fit(docs)
    try:
        for other in (T.WordTokenizer(tokenizer.vocabulary, shared_words=0), tokenizer, T.ByteTokenizer()):
            spark.conf.set(setting, "10000")
            other.transform(docs)
            assert int(spark.conf.get(setting)) <= 512
        spark.conf.set(setting, "7")
        tokenizer.transform(docs)
        assert spark.conf.get(setting) == "7"
    finally:
        spark.conf.set(setting, before)
