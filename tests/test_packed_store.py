import random

import pytest

from quire.operators.packing import pack
from quire.sinks.packed_store import PackedStore

SCHEMA = "split string, doc_id string, tokens array<int>"


def _stories(draw, n, first):
    return [
        (draw.choice(["train", "train", "val"]), f"{first + i:06d}", [draw.randrange(1000) for _ in range(draw.choice([0, 1, 3, 9, 40]))])
        for i in range(n)
    ]


def _rows(df):
    return sorted((r.split, r.chunk_id, tuple(r.input_ids)) for r in df.collect())


def _at_once(spark, rows, length, overlap):
    return _rows(pack(spark.createDataFrame(rows, SCHEMA), length, overlap))


@pytest.mark.parametrize("length, overlap", [(8, 3), (10, 0), (7, 6)])
def test_appending_equals_packing_at_once(spark, folder, length, overlap):
    draw = random.Random(length)
    store, everything = PackedStore(spark, f"{folder}/s", length, overlap), []
    assert _rows(store.read()) == [] and store.ledger().collect() == []
    for number, n in enumerate((3, 12, 0, 1)):
        batch = _stories(draw, n, 100 * number)
        everything += batch
        assert store.append(spark.createDataFrame(batch, SCHEMA).repartition(3), f"b{number}")
        assert _rows(PackedStore(spark, f"{folder}/s", length, overlap).read()) == _at_once(spark, everything, length, overlap)
    totals = {r.split: r.total for r in store.ledger().collect()}
    assert totals == {s: t for s in ("train", "val") if (t := sum(len(r[2]) for r in everything if r[0] == s)) or s in totals}


def test_only_new_chunks_are_written(spark, folder):
    store = PackedStore(spark, folder, 8, 2)
    store.append(spark.createDataFrame([("train", f"{i:03d}", list(range(20))) for i in range(40)], SCHEMA), "a")
    store.append(spark.createDataFrame([("train", "100", [1, 2, 3])], SCHEMA), "b")
    assert spark.read.parquet(f"{folder}/chunks/1").count() <= 2
    assert spark.read.parquet(f"{folder}/chunks/0").count() > 100


def test_a_failed_job_changes_nothing(spark, folder, monkeypatch):
    store = PackedStore(spark, folder, 8, 2)
    first = [("train", "a", list(range(30))), ("val", "b", [7] * 6)]
    store.append(spark.createDataFrame(first, SCHEMA), "a")
    old = _rows(store.read())
    more = spark.createDataFrame([("train", "c", list(range(50, 90)))], SCHEMA)
    with monkeypatch.context() as broken:
        broken.setattr(PackedStore, "_mark", lambda *a, **k: (_ for _ in ()).throw(IOError("lost")))
        with pytest.raises(IOError):
            store.append(more, "b")
    assert _rows(store.read()) == old and len(store.generations()) == 1
    bad = spark.createDataFrame([("train", "c", ["x"])], "split string, doc_id string, tokens array<string>")
    with pytest.raises(Exception):
        store.append(bad.selectExpr("split", "doc_id", "transform(tokens, t -> cast(t as int)) tokens"), "b")
    assert _rows(store.read()) == old
    assert store.append(more, "b") and not store.append(more, "b") and not store.append(more, "a")
    assert _rows(store.read()) == _at_once(spark, first + [("train", "c", list(range(50, 90)))], 8, 2)


def test_missing_names_come_behind_the_open_chunk(spark, folder):
    store = PackedStore(spark, folder, 4, 1)
    store.append(spark.createDataFrame([("t", "z", [1, 2, 3, 4, 5])], SCHEMA), "a")
    store.append(spark.createDataFrame([("t", None, [6, 7]), ("t", "b", [8])], SCHEMA), "b")
    assert _rows(store.read()) == [("t", 0, (1, 2, 3, 4)), ("t", 1, (4, 5, 6, 7))]


def test_one_geometry_per_store(spark, folder):
    PackedStore(spark, folder, 8, 2).append(spark.createDataFrame([("t", "a", [1])], SCHEMA), "a")
    with pytest.raises(ValueError, match="packed with"):
        PackedStore(spark, folder, 8, 3)
