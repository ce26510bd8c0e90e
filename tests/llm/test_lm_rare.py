from test_lm_scoring import check

from quire.llm import lm_scoring as M


def test_bigrams_seen_once_have_arcs(spark):
    trained, held = [next(i for i in range(100) if M.held_out(i) == h) for h in (False, True)]
    texts = [(trained, "x y p q p q p r"), (held, "x y")]
    model = check(spark.createDataFrame(texts, "doc_id bigint, text string"), texts)
    assert model.followers[b"x"] == {b"y": 1}
    assert model.probability(b"x", b"y") > model.unigram(b"y")


def test_long_lists_travel_as_bytes(spark, monkeypatch):
    """Lists of numbers in rows are taken apart by the JVM, and held in vectors of twice their size."""
    kinds, stage = {}, M.stage

    def watched(df, name, *more):
        kinds[name] = dict(df.dtypes)
        return stage(df, name, *more)

    monkeypatch.setattr(M, "stage", watched)
    texts = [(i, f"a b c{i} a b") for i in range(50)]
    check(spark.createDataFrame(texts, "doc_id bigint, text string"), texts)
    assert kinds["chunks"]["stream"] == kinds["pair-totals"]["totals"] == kinds["word-totals"]["totals"] == "binary"


def test_rows_for_buckets_go_on_together():
    chunk = M._Chunk()
    for i in range(300):
        chunk.add(i, " ".join(f"w{i}x{j}" for j in range(10)))
    buckets = M.Buckets.of(200 * M.BUCKET_TOKENS)
    row = M._packed(chunk.row(3))
    for counted, names in ((M.ChunkWords, M._WORD_NAMES), (M.ChunkPairs, M._PAIR_NAMES)):
        sent = list(M._sender(buckets, counted, names)([row]))
        rows = [r for batch in sent for r in batch.to_pylist()]
        assert len(sent) == 1 < len({r["bucket"] for r in rows}) == len(rows)
        assert sum(len(r["keys"]) for r in rows) == 8 * (3001 if counted is M.ChunkWords else 3300)
