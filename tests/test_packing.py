import random

import pytest
from pyspark.sql import functions as F

from quire.operators.packing import pack, packing_report, segments, with_labels

SCHEMA = "split string, doc_id string, tokens array<int>"


def _sequential(stream, length, overlap):
    """One pass with a buffer, as the definition of the result."""
    chunks, at = [], 0
    while len(stream) - at >= length:
        chunks.append(stream[at : at + length])
        at += length - overlap
    if len(stream) - at > length // 2:
        chunks.append(stream[at:])
    return chunks


def _packed(spark, rows, length, overlap):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {}
    for r in pack(df, length, overlap).orderBy("split", "chunk_id").collect():
        chunks = got.setdefault(r.split, [])
        assert r.chunk_id == len(chunks)
        chunks.append(r.input_ids)
    return got


@pytest.mark.parametrize(
    "n, overlap, spans",
    [
        (4, 2, []),
        (5, 2, [(0, 5)]),
        (8, 2, [(0, 8)]),
        (10, 2, [(0, 8)]),
        (11, 2, [(0, 8), (6, 5)]),
        (14, 2, [(0, 8), (6, 8)]),
        (8, 5, [(0, 8), (3, 5)]),
        (16, 0, [(0, 8), (8, 8)]),
    ],
)
def test_spans(spark, n, overlap, spans):
    got = _packed(spark, [("train", "a", list(range(n)))], 8, overlap)
    assert got.get("train", []) == [list(range(a, a + k)) for a, k in spans]


@pytest.mark.parametrize("length, overlap", [(8, 2), (16, 0), (8, 7), (7, 3), (64, 8)])
def test_equal_to_one_pass(spark, length, overlap):
    rng = random.Random(length * 100 + overlap)
    rows, token = [], 0
    for i in range(120):
        n = rng.choice([0, 1, 1, 2, 5, 30, 200])
        rows.append((rng.choice(["train", "val"]), str(rng.randint(0, 10**6) * 1000 + i), list(range(token, token + n))))
        token += n
    got = _packed(spark, rows, length, overlap)
    for split in ("train", "val"):
        stories = sorted((d + ".txt", t) for s, d, t in rows if s == split)
        stream = [t for _, toks in stories for t in toks]
        expected = _sequential(stream, length, overlap)
        assert got.get(split, []) == expected
        rebuilt = expected[0] + [t for c in expected[1:] for t in c[overlap:]]
        assert rebuilt == stream[: len(rebuilt)]


@pytest.mark.parametrize("n", [500, 512, 513])
def test_one_long_document_among_short_ones(spark, n):
    """Longer than many segments, and around a segment border."""
    rows = [("train", f"{i:03d}", [i] * 3) for i in range(5)] + [("train", "002x", list(range(1000, 1000 + n)))]
    stories = sorted((d + ".txt", t) for _, d, t in rows)
    stream = [t for _, toks in stories for t in toks]
    assert _packed(spark, rows, 8, 3)["train"] == _sequential(stream, 8, 3)


def test_segments(spark):
    rows = [("train", "a", list(range(10))), ("train", "b", []), ("train", "c", list(range(4)))]
    cut = segments(spark.createDataFrame(rows, SCHEMA), 4)
    assert sorted((r.doc_id, r.segment, r.tokens, r.n_tokens) for r in cut.collect()) == [
        ("a", 0, [0, 1, 2, 3], 4), ("a", 1, [4, 5, 6, 7], 4), ("a", 2, [8, 9], 2), ("c", 0, [0, 1, 2, 3], 4)
    ]


def test_order_is_by_file_name(spark):
    got = _packed(spark, [("train", "986", [1, 2, 3]), ("train", "10045", [4, 5, 6])], 4, 0)
    assert got["train"] == [[4, 5, 6, 1]]


@pytest.mark.parametrize("overlap", [8, 9, -1])
def test_geometry_is_checked(spark, overlap):
    with pytest.raises(ValueError):
        pack(spark.createDataFrame([], SCHEMA), 8, overlap)


def test_report_and_labels(spark):
    df = spark.createDataFrame([("train", "a", list(range(20))), ("val", "b", [1])], SCHEMA)
    packed = pack(df, 8, 2)
    assert {tuple(r) for r in packing_report(df, packed).collect()} == {("train", 1, 3, 24), ("val", 1, 0, 0)}
    assert with_labels(packed).filter(F.col("labels") != F.col("input_ids")).count() == 0


def test_no_single_task_and_no_cross_join(spark):
    df = spark.createDataFrame([("train", str(i), [i] * 5) for i in range(50)], SCHEMA)
    plan = pack(df, 8, 2)._jdf.queryExecution().executedPlan().toString()
    for word in ("SinglePartition", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan


def test_repeated_and_missing_keys(spark):
    rows = [("train", "a", [1, 2, 3]), ("train", "a", [4, 5, 6]), ("train", None, [7, 8, 9]), (None, "b", [1, 2, 3, 4])]
    got = _packed(spark, rows, 4, 0)
    assert got[None] == [[1, 2, 3, 4]]
    stream = [t for c in got["train"] for t in c]  # nine tokens, of which one is left over
    assert stream in ([7, 8, 9, 1, 2, 3, 4, 5], [7, 8, 9, 4, 5, 6, 1, 2])


def test_order_of_repeated_keys(spark):
    rows = [("train", "a", [4, 5, 6], "y"), ("train", "a", [1, 2, 3], "x"), ("train", "a", [7, 8, 9], None)]
    df = spark.createDataFrame(rows, SCHEMA + ", tie string")
    chunks = pack(df, 4, 0, then_by=["tie"]).orderBy("chunk_id").collect()
    assert [c.input_ids for c in chunks] == [[7, 8, 9, 1], [2, 3, 4, 5]]


@pytest.mark.parametrize("few", [0, 10**6])
def test_tokens_are_joined_once_and_summed_once(spark, monkeypatch, few):
    from quire.operators import packing

    monkeypatch.setattr(packing, "MAX_SHARED_SEGMENTS", few)
    df = spark.createDataFrame([("train", str(i), [i] * 50) for i in range(50)], SCHEMA)
    packed = pack(df, 8, 2)
    plan = packed._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan and "Window" not in plan
    stream = [i for i in sorted(map(str, range(50)), key=lambda d: d + ".txt") for _ in range(50)]
    assert [c.input_ids for c in packed.orderBy("chunk_id").collect()] == _sequential([int(i) for i in stream], 8, 2)
