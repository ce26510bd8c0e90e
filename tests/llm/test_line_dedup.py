import random

from pyspark.sql import functions as F

from quire.llm import line_dedup as L


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_edit_distance():
    for seed in range(300):
        random.seed(seed)
        a = [random.choice("abc") for _ in range(random.randint(0, 12))]
        b = [random.choice("abc") for _ in range(random.randint(0, 12))]
        assert L.edit_distance(a, b) == plain_distance(a, b)
    a = [str(i) for i in range(3000)]
    assert L.edit_distance(a, a[:1000] + ["x"] + a[1001:]) == 1


def test_similar():
    a = list("abcdefghij")
    assert L.similar(a, list("abcdefghXY")) and not L.similar(a, list("abcdefgXYZ"))
    assert L.similar(a, a[:8]) and not L.similar(a, a[:7])


def brute(docs, union_find):
    """Texts after dedup, by edit similarity of all pairs of distinct lines."""
    lines, places = {}, {}
    for doc_id, text in docs:
        for at, words in enumerate(L.line_words(text)) if text else ():
            if len(words) >= L.MIN_WORDS:
                lines[tuple(words)] = None
                places.setdefault(tuple(words), []).append((doc_id, at))
    every = list(lines)
    found = union_find()
    for i, a in enumerate(every):
        found.find(i)
        for j in range(i):
            b = every[j]
            if 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)) and L.similar(a, b):
                found.join(i, j)
    groups = {}
    for i, a in enumerate(every):
        groups.setdefault(found.find(i), []).extend(places[a])
    gone = {p for members in groups.values() for p in sorted(members)[1:]}
    return {
        d: text and "\n".join(x for at, x in enumerate(text.split("\n")) if (d, at) not in gone) for d, text in docs
    }


def edited(words, edits, draw):
    out = list(words)
    for _ in range(edits):
        out[random.randrange(len(out))] = draw()
    return out


def test_against_all_pairs(spark, union_find):
    random.seed(4)
    draw = lambda: "".join(random.choice("abcdefgh") for _ in range(5))
    docs, bases = [], [[draw() for _ in range(30)] for _ in range(6)]
    for d in range(60):
        texts = []
        for _ in range(6):
            kind = random.random()
            words = edited(random.choice(bases), random.randint(0, 3), draw) if kind < 0.6 else [draw() for _ in range(12)]
            texts.append(" ".join(words[:3] if kind > 0.9 else words))
        docs.append((d, "\n".join(texts)))
    expected = brute(docs, union_find)
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {r.doc_id: r.text for r in L.deduped_lines(df).collect()}
    assert got == expected
    assert sum(map(len, got.values())) < 0.9 * sum(len(t) for _, t in docs)


def test_given_documents(spark, small, union_find):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    got = {r.doc_id: r.text for r in L.deduped_lines(spark.read.parquet(f"{small}/documents.parquet")).collect()}
    assert got == brute(docs, union_find)


def test_one_of_each_group_stays(spark, rows):
    line = "The same Line, of seven words here."
    data = [
        (3, f"first\n{line}\nlast"),
        (1, f"{line.upper()}\nown words in another line here"),
        (2, f"{line}\n{line}\nshort one\nshort one"),
        (9, None),
        (8, ""),
        (None, f"x\n{line}"),
        (5, "five words in a row\r\n"),
        (6, "five words in a row!"),
    ]
    docs = spark.createDataFrame(data, "doc_id bigint, text string").withColumn("removed", F.lit("own")).withColumn("at", F.lit(1))
    got = rows(L.deduped_lines(docs), "doc_id", "n_lines", "n_removed", "text")
    assert got == sorted(
        [
            (None, 2, 0, f"x\n{line}"),
            (1, 2, 1, "own words in another line here"),
            (2, 4, 3, "short one"),
            (3, 3, 1, "first\nlast"),
            (5, 2, 0, "five words in a row\r\n"),
            (6, 1, 1, ""),
            (8, 1, 0, ""),
            (9, 0, 0, None),
        ],
        key=repr,
    )
    assert L.deduped_lines(docs.limit(0)).count() == 0


def test_signatures_beyond_the_shared_limit(spark, rows, monkeypatch):
    random.seed(9)
    bases = [[f"w{random.randrange(10**6)}" for _ in range(n)] for n in (5, 20, 90, 400)]
    texts = [" ".join(edited(b, len(b) // 12, lambda: "new")) for b in bases for _ in range(6)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    shared = rows(L.deduped_lines(docs))
    monkeypatch.setattr(L, "MAX_SHARED_SIGNATURES", 0)
    assert rows(L.deduped_lines(docs)) == shared
    assert sum(r[2] for r in shared) == len(texts) - len(bases)


def test_words_with_equal_short_hashes_differ(spark, rows):
    """``w73`` and ``w239`` agree in 16 bits of their hashes."""
    data = [(1, "w73 b c d e"), (2, "w239 b c d x")]
    docs = spark.createDataFrame(data, "doc_id bigint, text string")
    assert rows(L.deduped_lines(docs), "doc_id", "text") == data


def test_equal_rows_are_one_document(spark, rows):
    text = "one two three four five\none two three four five"
    docs = spark.createDataFrame([(1, text), (1, text)], "doc_id bigint, text string")
    assert rows(L.deduped_lines(docs), "text") == [("one two three four five",)] * 2
