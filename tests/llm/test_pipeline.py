import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_decontamination import brute as contaminated
from test_line_dedup import brute as without_lines
from test_best_fit_packing import check as check_packing
from test_simhash import plain as fingerprint

import corpus_pipeline
from quire.llm import language_id
from quire.staging import stage


@pytest.fixture(scope="module")
def stages(spark, small):
    """The rows before and after every stage."""
    docs, out = spark.read.parquet(f"{small}/documents.parquet"), []
    extra = [(100_001, None, "en", "s", 0), (100_002, "123 456", "en", "s", 7), (100_003, "", None, None, None)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    item = spark.read.parquet(f"{small}/benchmark.parquet").first().text
    own = "eanor thin wordly passage that nobody else has written down here at all today. " * 4
    docs = docs.unionByName(spark.createDataFrame([(100_004, f"{own}\n{item}", "en", "s", 0), (100_005, item, "en", "s", 0)], docs.schema))
    for name, function in corpus_pipeline.STAGES:
        after = stage(function(spark, docs, small), name)
        out.append((docs, after))
        docs = after
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "simhash_dedup", "decontamination", "packing"]


def test_documents_keep_their_columns(stages):
    for before, after in stages[:-1]:
        assert after.dtypes == before.dtypes
        assert after.filter("length(text) != n_chars and doc_id < 100000").count() == 0


def test_languages(stages):
    before, after = map(texts, stages[0])
    assert set(before) - set(after) == {d for d, t in before.items() if not language_id.has_letter(t)}
    assert all(before[d] == t for d, t in after.items())


def test_lines(stages, union_find):
    before, after = map(texts, stages[1])
    expected = without_lines(sorted(before.items()), union_find)
    assert after == {d: t for d, t in expected.items() if t == before[d] or t.strip()}


def test_near_duplicates(stages, union_find):
    before, after = map(texts, stages[2])
    found, prints = union_find(), {d: fingerprint(t) for d, t in before.items()}
    for a in prints:
        found.find(a)
        for b in prints:
            if b < a and bin(prints[a] ^ prints[b]).count("1") <= 2:
                found.join(a, b)
    assert after == {d: t for d, t in before.items() if found.find(d) == d}


def test_rows_are_judged_by_their_own_text(spark, rows):
    a, b, c = ("a text of its own with some words", "another one that is not like it at all", "and a third text, different again")
    keep = lambda data: rows(corpus_pipeline.keep_one_near_duplicate(spark, spark.createDataFrame(data, "doc_id bigint, text string, x string"), ""))
    data = [(7, a, ""), (7, b, ""), (3, b, ""), (7, c, "2"), (7, c, "1"), (None, c, ""), (None, "x", None), (None, "x", "z")]
    assert keep(data) == sorted([(7, a, ""), (3, b, ""), (7, c, "1"), (None, "x", None)], key=repr)
    assert rows(corpus_pipeline.keep_one_near_duplicate(spark, spark.createDataFrame([(1, None, None), (2, "", None)], "doc_id bigint, text string, x string"), ""), "doc_id") == [(1,)]


def test_benchmark(stages, spark, small):
    before, after = map(texts, stages[3])
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    assert 100_004 in after and 100_005 not in after
    for d, text in before.items():
        n, hit, _ = contaminated(text, items)
        if not hit:
            assert after[d] == text
        else:
            assert (d in after) == (len(hit) <= 0.5 * n)
            assert d not in after or not contaminated(after[d], items)[1]


def test_packing(stages):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    before, after = stages[4]
    check_packing(after.collect(), texts(before), tokenizer)


def test_run_is_all_stages(spark, small):
    rows = corpus_pipeline.run(spark, small)
    assert rows.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert rows.count() > 100


def test_empty_and_repeated_rows(spark, small, rows):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    empty = docs.limit(0)
    for _, function in corpus_pipeline.STAGES[:-1]:
        empty = stage(function(spark, empty, small), "empty")
        assert empty.count() == 0
    one = docs.filter("doc_id in (1, 2)")
    nameless = docs.filter("doc_id in (3, 5)").withColumn("doc_id", F.lit(None).cast("bigint"))
    kept = corpus_pipeline.keep_one_near_duplicate(spark, one.unionByName(one).unionByName(nameless).unionByName(nameless), small)
    assert rows(kept, "doc_id") == sorted([(1,), (2,), (None,), (None,)], key=repr)
