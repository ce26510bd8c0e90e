import hashlib

import pytest
from pyspark.sql import functions as F

from quire.operators import splitting
from quire.operators.ranking import running_offsets, seeded_rank
from quire.operators.splitting import attach_split, exact_split, split_sizes, train_size


def _expected(keys, ratio, seed):
    ordered = sorted(keys, key=lambda k: (hashlib.md5(f"{seed}:{k}".encode()).hexdigest(), k))
    return set(ordered[: int(len(ordered) * ratio)])


@pytest.mark.parametrize(
    "n, ratio, train", [(0, 0.9, 0), (1, 0.9, 0), (10, 0.9, 9), (100, 0.29, 28), (4036, 0.9, 3632)]
)
def test_sizes(spark, n, ratio, train):
    df = spark.createDataFrame([(f"d{i}",) for i in range(n)], "doc_id string")
    sizes = {r.split: r.n_docs for r in split_sizes(exact_split(df, ratio=ratio)).collect()}
    assert sizes == {k: v for k, v in (("train", train), ("val", n - train)) if v}
    assert train_size(n, ratio) == train


@pytest.mark.parametrize("small_cell", [10_000, 3])
def test_members_are_exact_and_independent_of_partitioning(spark, monkeypatch, small_cell):
    monkeypatch.setattr(splitting, "_SMALL_CELL", small_cell)
    keys = [f"book{i}" for i in range(3000)]
    df = spark.createDataFrame([(k,) for k in keys], "doc_id string")
    for parts in (1, 7):
        rows = exact_split(df.repartition(parts), ratio=0.37, seed=9).collect()
        assert {r.doc_id for r in rows if r.split == "train"} == _expected(keys, 0.37, 9)


def test_looks_closer_into_a_large_cell(spark, monkeypatch):
    """Few hash digits per round force several rounds."""
    monkeypatch.setattr(splitting, "CELL_DIGITS", 1)
    monkeypatch.setattr(splitting, "_SMALL_CELL", 2)
    df = spark.range(2000).withColumnRenamed("id", "doc_id")
    rows = exact_split(df, ratio=0.5).collect()
    assert {r.doc_id for r in rows if r.split == "train"} == _expected(range(2000), 0.5, 42)


def _order(row, seed, then_by=True):
    md5 = lambda *parts: hashlib.md5(":".join([str(seed), *[p for p in parts if p is not None]]).encode()).hexdigest()
    return md5(row[0]) + (md5(row[1]) if then_by else "")


REPEATED = [(k, f"t{i % 7}") for i in range(200) for k in [None, "a", "b", "hot", "hot", "hot", str(i)][i % 7 :][:1]]


@pytest.mark.parametrize("then_by", [("text",), ()])
@pytest.mark.parametrize("small_cell", [10_000, 3])
def test_repeated_and_missing_keys(spark, monkeypatch, then_by, small_cell):
    monkeypatch.setattr(splitting, "_SMALL_CELL", small_cell)
    df = spark.createDataFrame(REPEATED, "doc_id string, text string").repartition(5)
    for seed in range(2):
        for ratio in (0.02, 0.5, 0.8):
            split = exact_split(df, ratio=ratio, seed=seed, then_by=then_by)
            rows = split.collect()
            train = sorted((r.doc_id, r.text) for r in rows if r.split == "train" and r.doc_id is not None)
            assert len(rows) == len(REPEATED)
            assert sum(r.split == "train" for r in rows) == int(len(REPEATED) * ratio)
            wanted = sorted(REPEATED, key=lambda row: _order(row, seed, bool(then_by)))[: int(len(REPEATED) * ratio)]
            if then_by:
                assert train == sorted(r for r in wanted if r[0] is not None)
            else:
                assert [k for k, _ in train] == sorted(k for k, _ in wanted if k is not None)


def test_one_key_only(spark):
    df = spark.createDataFrame([("same", "x")] * 50 + [("same", "y")] * 50, "doc_id string, text string").repartition(7)
    for then_by in ((), ("text",)):
        assert {r.split: r.n_docs for r in split_sizes(exact_split(df, ratio=0.3, then_by=then_by)).collect()} == {"train": 30, "val": 70}


def test_attach_repeated_and_missing_keys(spark):
    df = spark.createDataFrame(REPEATED, "doc_id string, text string").repartition(5)
    for ratio in (0.1, 0.5, 0.9):
        split = exact_split(df, ratio=ratio, then_by=["text"])
        stored = split.select("doc_id", "split")
        got = attach_split(df, stored, then_by=["text"]).collect()
        assert sorted(map(repr, got)) == sorted(map(repr, split.collect()))
    one = spark.createDataFrame([("q", "train")], "doc_id string, split string")
    assert attach_split(df, one).collect() == []


@pytest.mark.parametrize("ratio", [0, 1, -0.1, 1.5])
def test_ratio_is_checked(spark, ratio):
    with pytest.raises(ValueError):
        exact_split(spark.range(3).withColumnRenamed("id", "doc_id"), ratio=ratio)


def test_labelling_documents_needs_no_shuffle(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    plan = exact_split(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_attach(spark):
    docs = spark.createDataFrame([("a", 1), ("b", 2)], "doc_id string, x int")
    assignment = spark.createDataFrame([("a", "train"), ("b", "val")], "doc_id string, split string")
    assert {tuple(r) for r in attach_split(docs, assignment).collect()} == {("a", 1, "train"), ("b", 2, "val")}


def test_running_offsets(spark):
    rows = [(["x", "y"][i % 3 == 0], f"k{i * 7919 % 1000:04d}", i % 5) for i in range(1000)]
    df = spark.createDataFrame(rows, "g string, k string, w bigint").repartition(5)
    got = {(r.g, r.k): (r.offset, r.total) for r in running_offsets(df, [F.col("k")], "w", "g", ranges=9).collect()}
    assert len(got) == len(rows)
    for g in "xy":
        at, total = 0, sum(w for h, _, w in rows if h == g)
        for _, k, w in sorted(r for r in rows if r[0] == g):
            assert got[g, k] == (at, total)
            at += w


def test_running_offsets_over_several_columns(spark):
    rows = [(i, i * 31 % 7) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, n int").repartition(3)
    got = {r.k: r.offset for r in running_offsets(df, [F.desc("n"), F.asc("k")], ranges=4).collect()}
    for i, (k, _) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0]))):
        assert got[k] == i


def test_seeded_rank(spark):
    df = spark.range(1500).select((F.col("id") % 2).alias("g"), F.col("id").alias("k")).repartition(4)
    got = {(r.g, r["rank"]): (r.k, r.total) for r in seeded_rank(df, ["k"], "g", 3).collect()}
    for g in (0, 1):
        keys = [k for k in range(1500) if k % 2 == g]
        keys.sort(key=lambda k: (hashlib.md5(f"3:{k}".encode()).hexdigest(), k))
        assert [got[g, i] for i in range(750)] == [(k, 750) for k in keys]
