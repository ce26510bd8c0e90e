import io
import zipfile

import pytest

from quire.operators import acquisition as A
from quire.sources.ids import read_ids
from quire.sources.texts import zip_members

MARK = "Project Gutenberg"
FETCHED = "book_id string, kind string, priority int, member_idx int, member string, status int, body string"


def _ids(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "book_id string")


def _file(folder, text):
    path = f"{folder}/ids.txt"
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_reading_ids(spark, folder):
    path = _file(folder, "10\n 9 \n# x\n\n10\n007\n7\n  # y\n123456789012345678901234567890")
    assert [r.book_id for r in read_ids(spark, path).collect()] == [
        "007", "7", "9", "10", "123456789012345678901234567890"
    ]


@pytest.mark.parametrize("text", ["", "# only\n\n", "12\nabc\n"])
def test_bad_id_files(spark, folder, text):
    with pytest.raises(ValueError):
        read_ids(spark, _file(folder, text))


def test_candidates(spark):
    rows = A.candidates(_ids(spark, "12")).orderBy("priority").collect()
    assert [(r.priority, r.kind) for r in rows] == [(i, "text" if i < 6 else "zip") for i in range(9)]
    assert rows[0].url.endswith("/cache/epub/12/pg12.txt") and rows[8].url.endswith("/files/12/12-0.zip")
    plan = A.candidates(_ids(spark, "12"))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Cartesian" not in plan


def test_resume(spark):
    left = A.resume(_ids(spark, "1", "2", "3"), _ids(spark, "2", "9"))
    assert sorted(r.book_id for r in left.collect()) == ["1", "3"]


def test_first_valid_and_report(spark):
    rows = [
        ("1", "text", 0, None, None, 404, MARK),
        ("1", "text", 1, None, None, 200, "something else"),
        ("1", "zip", 6, 0, "a.md", 200, MARK + " no text member"),
        ("1", "zip", 6, 2, "b.txt", 200, MARK + " later"),
        ("1", "zip", 6, 1, "a.TXT", 200, MARK + " found"),
        ("2", "text", 3, None, None, 200, MARK + " third"),
        ("2", "text", 2, None, None, 200, MARK + " second"),
        ("2", "zip", 0, 0, "a.txt", 200, MARK + " zip"),
        ("3", "text", 0, None, None, 200, "project gutenberg"),
        ("4", "text", 0, None, None, None, None),
    ]
    fetched = spark.createDataFrame(rows, FETCHED).repartition(3)
    best = A.first_valid(fetched)
    assert {(r.book_id, r.kind, r.priority, r.body) for r in best.collect()} == {
        ("1", "zip", 6, MARK + " found"), ("2", "text", 2, MARK + " second")
    }
    asked = _ids(spark, "1", "2", "3", "4", "5")
    assert sorted(r.book_id for r in A.failures(asked, best).collect()) == ["3", "4", "5"]
    assert {tuple(r) for r in A.report(asked, best).collect()} == {("downloaded", 2), ("failed", 3)}


def test_zip_members(spark):
    def archive(members, compression=zipfile.ZIP_DEFLATED):
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", compression) as z:
            for name, content in members:
                z.writestr(name, content)
        return buffer.getvalue()

    good = archive([("x.md", b"no"), ("a.TXT", b"ab\xff\xefc"), ("b.txt", "é".encode())])
    stored = archive([("one.txt", b"first member"), ("two.txt", b"second member")], zipfile.ZIP_STORED)
    damaged = stored.replace(b"second member", b"second mEmber", 1)
    rows = [("1", 6, bytearray(good)), ("2", 7, bytearray(good[:40])), ("3", 8, bytearray(damaged)), ("4", 6, None)]
    df = spark.createDataFrame(rows, "book_id string, priority int, content binary")
    got = {tuple(r) for r in zip_members(df).collect()}
    assert got == {
        ("1", 6, 1, "a.TXT", "abc"), ("1", 6, 2, "b.txt", "é"), ("3", 8, 0, "one.txt", "first member")
    }
