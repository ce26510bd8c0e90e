import os

from pyspark.sql import functions as F

from quire.operators.cleaning import gate
from quire.operators.packing import pack
from quire.operators.splitting import exact_split
from quire.plans.corpus import CorpusSettings, build_corpus
from quire.operators.tokens import ByteTokenizer
from quire.sinks import tables
from quire.sources.packed import read_packed, split_counts
from quire.sources.texts import read_stories, read_texts
from quire.streaming.cleaning import clean_available, read_documents_stream, read_texts_stream


def _put(folder, name, content):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "wb") as f:
        f.write(content)


def test_reading_texts(spark, folder):
    _put(folder, "10.txt", b"ab\xff\xefc\r\nd\re")
    _put(folder, "a.b.txt", "é".encode())
    _put(folder, "blank.txt", b" \n ")
    _put(folder, "skip.md", b"no")
    _put(folder + "/sub", "deep.txt", b"no")
    assert {r.doc_id: r.text for r in read_texts(spark, folder).collect()} == {
        "10": "abc\nd\ne", "a.b": "é", "blank": " \n "
    }
    assert {r.doc_id for r in read_stories(spark, folder).collect()} == {"10", "a.b"}


def test_unreadable_files_are_reported(spark, folder):
    _put(folder, "1.txt", b"x" * 2000)
    _put(folder, "2.txt", b"y" * 2000)
    _put(folder, ".2.txt.crc", b"crc\x00\x00\x00\x02\x00\x00\x00\x00")  # does not match
    got = {r.doc_id: (r.status, r.message) for r in gate(read_texts(spark, folder)).collect()}
    assert got == {"1": ("success", None), "2": ("failed", "unreadable text")}


def test_stream_goes_on_where_it_stopped(spark, folder):
    source, out, progress = (f"{folder}/{n}" for n in ("in", "out", "progress"))
    _put(source, "1.txt", b"x" * 1200)
    _put(source, "2.txt", b"short text")

    def run():
        clean_available(read_texts_stream(spark, source), out, progress).awaitTermination()
        return {r.doc_id: (r.status, r.text) for r in spark.read.parquet(out).collect()}

    assert run() == {"1": ("success", "x" * 1200), "2": ("skipped", "short text")}
    _put(source, "3.txt", b"*** START OF THE PROJECT GUTENBERG EBOOK X ***\n" + b"y" * 1000)
    got = run()
    assert spark.read.parquet(out).count() == 3
    batch = {r.doc_id: (r.status, r.text) for r in gate(read_texts(spark, source)).collect()}
    assert got == batch and got["3"] == ("success", "y" * 1000)


def test_stream_of_a_table_in_many_files_or_one(spark, folder):
    rows = spark.createDataFrame([(i, "x" * 1200) for i in range(6)], "doc_id bigint, text string")
    rows.repartition(3).write.parquet(f"{folder}/many.parquet")
    rows.coalesce(1).write.parquet(f"{folder}/aside")
    os.makedirs(f"{folder}/one")
    part = next(f for f in os.listdir(f"{folder}/aside") if f.endswith(".parquet"))
    for name in ("docs [1].parquet", "other.parquet"):
        os.link(f"{folder}/aside/{part}", f"{folder}/one/{name}")
    for i, name in enumerate(("many.parquet", "one/docs [1].parquet")):
        stream = read_documents_stream(spark, f"{folder}/{name}", rows.schema)
        clean_available(stream, f"{folder}/out{i}", f"{folder}/progress{i}").awaitTermination()
        cleaned = spark.read.parquet(f"{folder}/out{i}").collect()
        assert sorted((r.doc_id, r.status) for r in cleaned) == [(n, "success") for n in range(6)]


def test_id_sink(spark, folder):
    ids = spark.createDataFrame([("9",), ("10",), ("9",), ("100",)], "book_id string").repartition(3)
    assert tables.write_ids(ids, f"{folder}/ids")
    parts = sorted(p for p in os.listdir(f"{folder}/ids") if p.startswith("part"))
    lines = [line for p in parts for line in open(f"{folder}/ids/{p}").read().splitlines()]
    assert lines == ["10", "100", "9"]
    assert not tables.write_ids(ids.filter("false"), f"{folder}/none")
    assert not os.path.exists(f"{folder}/none")


def test_document_sinks(spark, folder):
    docs = spark.createDataFrame([(str(i), "word " * (i * 50)) for i in range(10)], "doc_id string, text string")
    tables.write_documents(docs, f"{folder}/raw")
    assert spark.read.parquet(f"{folder}/raw").count() == 10
    tables.write_cleaned(gate(docs), f"{folder}/cleaned")
    cleaned = spark.read.parquet(f"{folder}/cleaned")
    assert sorted(r.doc_id for r in cleaned.collect()) == ["5", "6", "7", "8", "9"]
    tables.write_split(exact_split(cleaned, ratio=0.6), f"{folder}/split")
    assert sorted(os.listdir(f"{folder}/split"))[-2:] == ["split=train", "split=val"]
    counts = spark.read.parquet(f"{folder}/split").groupBy("split").count().collect()
    assert {tuple(r) for r in counts} == {("train", 3), ("val", 2)}


def test_packed_sink(spark, folder):
    rows = [("train", "a", list(range(30))), ("val", "b", list(range(9)))]
    packed = pack(spark.createDataFrame(rows, "split string, doc_id string, tokens array<int>"), 8, 2)
    both = tables.bundle(packed.filter("split = 'train'"), packed.filter("split = 'val'"))
    tables.write_packed(both, f"{folder}/packed")
    written = read_packed(spark, f"{folder}/packed")
    assert {tuple(r) for r in split_counts(written).collect()} == {("train", 5), ("validation", 1)}
    assert written.filter(F.col("labels") != F.col("input_ids")).count() == 0
    tables.write_packed(packed, f"{folder}/plain", labels=False)
    assert "labels" not in read_packed(spark, f"{folder}/plain").columns


def test_whole_way_with_bytes(spark):
    docs = spark.createDataFrame([(str(i), f"line {i} " * 200) for i in range(20)], "doc_id string, text string")
    packed = build_corpus(docs, CorpusSettings(max_length=128, overlap=16), ByteTokenizer())
    sizes = {r.split: r.n for r in packed.groupBy("split").agg(F.sum(F.size("input_ids")).alias("n")).collect()}
    assert set(sizes) == {"train", "val"}
    assert packed.filter(F.size("input_ids") > 128).count() == 0
