import os

import pytest
from pyspark.sql import functions as F

from quire.fixed_values import ALL_BANDS, CURATED_SHELVES
from quire.functions.catalog import file_key, score, score_band
from quire.operators import catalog as K
from quire.sources.catalog import read_catalog

HEAD = (
    '<?xml version="1.0" encoding="utf-8"?>\n<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" '
    'xmlns:pgterms="http://www.gutenberg.org/2009/pgterms/" xmlns:dcterms="http://purl.org/dc/terms/">\n'
)


def _described(tag, *values):
    inner = "".join(f'<rdf:Description><rdf:value rdf:datatype="x">{v}</rdf:value></rdf:Description>' for v in values)
    return f"<{tag}>{inner}</{tag}>"


def _ebook(langs=("en",), shelves=(), notes=()):
    return (
        "<pgterms:ebook>"
        + "".join(_described("dcterms:language", v) for v in langs)
        + "".join(_described("pgterms:bookshelf", v) for v in shelves)
        + "".join(f"<pgterms:marc908>{n}</pgterms:marc908>" for n in notes)
        + "<dcterms:title>ignored</dcterms:title></pgterms:ebook>"
    )


def _write(folder, name, *ebooks, cut=None):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    text = HEAD + "".join(ebooks) + "</rdf:RDF>"
    with open(path, "w", encoding="utf-8") as f:
        f.write(text[:cut] if cut else text)


def test_reading_documents(spark, folder):
    _write(folder, "cache/epub/1/pg1.rdf", _ebook(["en", "fr"], ["Folklore", "Folklore", ""], ["Score 90.9", "second"]))
    _write(folder, "cache/epub/2/pg2.rdf", _ebook(["fr", "en"]), _ebook(["en"], ["Fantasy"]))
    _write(folder, "other.rdf", _ebook([], ["Mythology &amp; more"], [""]))
    _write(folder, "cache/epub/4/pg4.rdf", _ebook(["en"], ["Folklore"]), _ebook(["en"]), cut=-60)
    _write(folder, "pg5.xml", _ebook())
    rows = sorted(
        (r.book_id, r.lang or "", r.shelves, r.marc908 or "") for r in read_catalog(spark, folder).collect()
    )
    assert rows == [
        ("1", "en", ["Folklore", "Folklore"], "Score 90.9"),
        ("2", "en", ["Fantasy"], ""),
        ("2", "fr", [], ""),
        ("other", "", ["Mythology & more"], ""),
    ]


def test_values_are_taken_as_they_stand(spark, folder):
    _write(folder, "pg1.rdf", _ebook(["", "en"], [" Fantasy "], [" "]))
    _write(folder, "pg2.rdf", _ebook([" en "]))
    empty = "<dcterms:language><rdf:Description/></dcterms:language>"
    _write(folder, "pg3.rdf", f"<pgterms:ebook>{empty}{_described('dcterms:language', 'en')}</pgterms:ebook>")
    rows = {r.book_id: (r.lang or None, r.shelves, r.marc908) for r in read_catalog(spark, folder).collect()}
    assert rows == {"1": (None, [" Fantasy "], None), "2": (" en ", [], None), "3": ("en", [], None)}


def test_languages_at_any_depth(spark, folder):
    inside = lambda lang: f"<dcterms:hasFormat><pgterms:file a='1'>{_described('dcterms:language', lang)}</pgterms:file></dcterms:hasFormat>"
    entry = lambda *parts: "<pgterms:ebook rdf:about='x'>" + "".join(parts) + "</pgterms:ebook >"
    direct = lambda lang: _described("dcterms:language", lang)
    _write(folder, "pg1.rdf", entry(inside("en")), entry(inside("fr"), direct("en")), entry(direct("de"), inside("en")))
    _write(folder, "pg2.rdf", "<!-- <pgterms:ebook></pgterms:ebook> --><pgterms:ebook/>", entry("<a/>", inside("a &amp; b"), "<!-- x -->"))
    _write(folder, "pg3.rdf", entry(inside("en")), entry(inside("en")), cut=-30)
    rows = sorted((r.book_id, r.lang or "") for r in read_catalog(spark, folder).collect())
    assert rows == [("1", "de"), ("1", "en"), ("1", "fr"), ("2", ""), ("2", "a & b")]


def test_curated_shelves_as_a_table(spark, ebooks):
    table = spark.createDataFrame([("Fantasy",), ("Folklore",), ("Fantasy",), ("None",)], "shelf string")
    names = ["Fantasy", "Folklore", "None"]
    for by in (K.books_per_shelf, K.score_histogram, K.qualified):
        rows = [sorted(map(repr, (r.asDict() for r in by(ebooks, c).collect()))) for c in (table, names)]
        assert rows[0] == rows[1]


def test_ids_that_are_no_numbers_come_last(spark):
    books = spark.createDataFrame([("b", i) for i in ("readme", "10", "9", "a", None)], "band string, book_id string")
    assert [r.book_id for r in K.top_ids(books, 4).orderBy("position").collect()] == ["9", "10", None, "a"]


def test_no_documents(spark, folder):
    assert read_catalog(spark, folder).count() == 0


@pytest.fixture(scope="module")
def ebooks(spark):
    rows = [
        ("10", "en", ["Folklore", "Folklore"], "Reading ease score: 80.7 (6th grade)"),
        ("9", "en", ["Fantasy", "Other"], "score 81.0"),
        ("2", "en", ["Fantasy", "Folklore"], "score 90.9"),
        ("100", "en", ["Christmas"], "score 104.2"),
        ("100", "en", ["Christmas"], "score 104.2"),
        ("5", "en", ["Other"], "score 99"),
        ("6", "en", ["Fantasy"], "-5.3"),
        ("7", "en", ["Fantasy"], None),
        ("8", "en", ["Fantasy"], "none given"),
        ("11", "en", [], "score 99"),
        ("12", "fr", ["Fantasy"], "score 99"),
        ("13", None, ["Fantasy"], "score 99"),
        ("14", "EN", ["apples"], "score 99"),
    ]
    return spark.createDataFrame(rows, "book_id string, lang string, shelves array<string>, marc908 string")


def test_scores(spark):
    cases = {
        "Reading ease score: 80.7 (6th grade)": (80.0, 80.7, "71-80"),
        "81.0": (81.0, 81.0, "81-90"),
        "x 90.9 y": (90.0, 90.9, "81-90"),
        "104.2": (104.0, 104.2, "91-100"),
        "-5.3": (5.0, 5.3, "0-30"),
        "": (None, None, "unknown"),
        "no digits": (None, None, "unknown"),
        None: (None, None, "unknown"),
    }
    df = spark.createDataFrame([(c,) for c in cases], "n string")
    s = score(F.col("n"))
    for r in df.select("n", s.alias("s"), score(F.col("n"), True).alias("e"), score_band(s).alias("b")).collect():
        assert (r.s, r.e, r.b) == cases[r.n]


def test_band_borders(spark):
    borders = {30: 0, 31: 1, 50: 1, 51: 2, 60: 2, 61: 3, 70: 3, 71: 4, 80: 4, 81: 5, 90: 5, 91: 6, 300: 6}
    df = spark.createDataFrame([(float(b),) for b in borders], "s double")
    for r in df.select("s", score_band(F.col("s")).alias("b")).collect():
        assert r.b == ALL_BANDS[borders[r.s]]


def test_file_keys(spark):
    names = {"pg123.rdf": "123", "pgx.rdf": "pgx", "a.b.rdf": "a.b", "plain": "plain", ".rdf": ".rdf", "xpg7.rdf": "7"}
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert {r.n: r.k for r in df.select("n", file_key(F.col("n")).alias("k")).collect()} == names


def test_counts(ebooks):
    assert K.english_total(ebooks).first()[0] == 10
    counts = {r.shelf: r.n for r in K.shelf_counts(ebooks).collect()}
    assert counts == {"Folklore": 3, "Fantasy": 5, "Other": 2, "Christmas": 2}
    assert K.distinct_shelves(ebooks).first()[0] == 4
    assert [r.shelf for r in K.first_shelves(ebooks, 2).collect()] == ["Christmas", "Fantasy"]
    per_shelf = {r.shelf: r.n_books for r in K.books_per_shelf(ebooks).collect()}
    assert len(per_shelf) == len(CURATED_SHELVES) == 35
    assert {k: v for k, v in per_shelf.items() if v} == {"Folklore": 2, "Fantasy": 5, "Christmas": 1}


def test_order_of_shelves(spark):
    df = spark.createDataFrame([("b",), ("A",), ("a",), ("C",)], "shelf string")
    assert [r.shelf for r in K.by_name(df).collect()] == ["A", "a", "b", "C"]


def test_histogram(ebooks):
    rows = K.score_histogram(ebooks).orderBy("position").collect()
    assert [(r.band, r.n_books) for r in rows] == [
        ("0-30", 1), ("31-50", 0), ("51-60", 0), ("61-70", 0), ("71-80", 1), ("81-90", 2), ("91-100", 2), ("unknown", 2)
    ]


def test_qualified(ebooks):
    books = K.qualified(ebooks)
    assert sorted(r.book_id for r in books.collect()) == ["100", "100", "2", "9"]
    assert {(r.band, r.n_books) for r in K.qualified_per_band(books).collect()} == {("81-90", 2), ("91-100", 2), (None, 4)}
    per_shelf = {r.shelf: r.n_books for r in K.qualified_per_shelf(books).collect()}
    assert {k: v for k, v in per_shelf.items() if v} == {"Fantasy": 2, "Folklore": 1, "Christmas": 1}
    assert {r.book_id for r in K.union_of_bands(books, ["81-90", "91-100"]).collect()} == {"2", "9", "100"}
    assert K.qualified_ids(books).count() == 3
    assert sorted(r.book_id for r in K.qualified(ebooks, exact=True).collect()) == ["10", "100", "100", "2", "9"]


def test_top_ids_are_cut_before_the_shuffle(ebooks):
    top = K.top_ids(K.qualified(ebooks), 2)
    assert [(r.band, r.book_id) for r in top.orderBy("band", "position").collect()] == [
        ("81-90", "2"), ("81-90", "9"), ("91-100", "100"), ("91-100", "100")
    ]
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def test_any_number_of_curated_shelves(ebooks):
    assert K.books_per_shelf(ebooks, []).count() == 0
    many = [f"s{i}" for i in range(20_000)] + ["Fantasy"]
    assert {r.shelf: r.n_books for r in K.books_per_shelf(ebooks, many).collect() if r.n_books} == {"Fantasy": 5}