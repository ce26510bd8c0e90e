import os

import pytest
from pyspark.sql import functions as F

from quire.operators.cleaning import gate
from quire.sinks.text_files import write_text_files
from quire.sources.files import FileReader, read_files
from quire.sources.texts import read_texts


def _put(folder, name, content):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "wb") as f:
        f.write(content)


def test_an_outcome_per_file(spark, folder):
    _put(folder, "10.txt", b"ab\xff\xefc\r\nd\re")
    _put(folder, "a.b.txt", "é".encode())
    _put(folder, "big.txt", b"x" * 100)
    _put(folder, "empty.txt", b"")
    _put(folder, ".hidden.txt", b"no")
    _put(folder, "_part.txt", b"no")
    _put(folder, "skip.md", b"no")
    _put(folder + "/sub.txt", "deep.txt", b"no")
    got = {r.doc_id: (r.text, r.error) for r in read_files(spark, folder, max_bytes=99).collect()}
    assert got == {
        "10": ("abc\nd\ne", None), "a.b": ("é", None), "big": (None, "too large (100 bytes)"), "empty": ("", None)
    }
    small = read_files(spark, folder, max_bytes=100)
    same = {r.doc_id: r.text for r in read_texts(spark, folder).collect()}
    # Spark's own file readers pass over empty files.
    assert {r.doc_id: r.text for r in small.collect()} == {**same, "empty": ""}
    gated = {r.doc_id: (r.status, r.message) for r in gate(read_files(spark, folder, max_bytes=99), 3, error="error").collect()}
    assert gated["big"] == ("failed", "too large (100 bytes)") and gated["10"] == ("success", None)
    assert gated["a.b"] == ("skipped", "too short (0 chars)")


def test_a_file_that_went_away_has_a_row(folder):
    _put(folder, "1.txt", b"one")
    _put(folder, "2.txt", b"two")
    os.symlink("3.txt", f"{folder}/3.txt")  # a link to itself can be listed by none and opened by none
    reader = FileReader({"path": folder})
    (part,) = reader.partitions()
    os.rename(f"{folder}/1.txt", f"{folder}/1.old")
    part.paths.append(f"{folder}/3.txt")
    rows = [row for batch in reader.read(part) for row in batch.to_pylist()]
    assert [(os.path.basename(r["path"]), r["content"]) for r in rows] == [("1.txt", None), ("2.txt", b"two"), ("3.txt", None)]
    assert "No such file" in rows[0]["error"] and rows[1]["error"] is None and "symbolic links" in rows[2]["error"]


def test_files_are_dealt_by_bytes(folder):
    for i in range(40):
        _put(folder, f"{i:02}.txt", b"x" * (1000 if i else 50_000))
    parts = FileReader({"path": folder, "taskBytes": "8000"}).partitions()
    assert [p for part in parts for p in part.paths] == [f"{folder}/{i:02}.txt" for i in range(40)]
    assert len(parts[0].paths) == 1 and {len(p.paths) for p in parts[1:-1]} == {7}


def test_a_task_has_hundreds_of_tiny_files(folder):
    for i in range(1500):
        _put(folder, f"{i}.txt", b"")
    for task_bytes in (1 << 20, 128 << 20):
        parts = FileReader({"path": folder, "taskBytes": str(task_bytes)}).partitions()
        assert [len(p.paths) for p in parts] == [1024, 476]


def test_large_tasks_come_in_batches(folder, monkeypatch):
    monkeypatch.setattr("quire.sources.files.BATCH_BYTES", 2500)
    for i in range(7):
        _put(folder, f"{i}.txt", b"x" * (1000 if i != 3 else 9000))
    reader = FileReader({"path": folder})
    sizes = [b.num_rows for part in reader.partitions() for b in reader.read(part)]
    assert sizes == [2, 1, 1, 2, 1]


def test_empty_and_missing_folders(spark, folder):
    assert read_files(spark, folder).count() == 0
    with pytest.raises(Exception, match="none"):
        read_files(spark, f"{folder}/none").count()


def test_files_are_whole_and_may_be_written_again(spark, folder):
    docs = spark.createDataFrame([("1", "one\r\n"), ("2", "é"), ("3", None)], "doc_id string, text string")
    for _ in range(2):
        assert write_text_files(docs.repartition(3), f"{folder}/out") == 3
        assert sorted(os.listdir(f"{folder}/out")) == ["1.txt", "2.txt", "3.txt"]
    got = {r.doc_id: r.text for r in read_files(spark, f"{folder}/out").collect()}
    assert got == {"1": "one\n", "2": "é", "3": ""}
    for name in (None, "a/b", ""):
        with pytest.raises(Exception, match="not a file name"):
            write_text_files(docs.withColumn("doc_id", F.lit(name)), f"{folder}/bad")
    assert write_text_files(docs.filter("false"), f"{folder}/nothing") == 0


def test_nothing_is_written_or_shuffled(spark, folder):
    _put(folder, "1.txt", b"one")
    plan = gate(read_files(spark, folder), error="error")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "parquet" not in plan.lower()
