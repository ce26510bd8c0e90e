import random
import re
from collections import Counter

import duckdb
import pytest

from quire.llm.collocations import ORACLE, collocations, stripe_entries

SCHEMA = "doc_id bigint, text string, lang string, phrase string, n string"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(rows, top=2000, least=10):
    """One pass in plain Python over ``(text, lang)``."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n-\r]", lowered(text)):
            words = re.findall(r"[^ \t]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                f.update((lang, *words[i : i + k]) for i in range(len(words) - k + 1))
    found = {g: a for g, a in f.items() if len(g) > 2 and a >= least}
    out = {}
    for (lang, *g), a in found.items():
        longer = [b for (other, *h), b in found.items() if other == lang and len(h) > len(g) and g in (h[:2], h[1:])]
        if any(100 * b >= 50 * a for b in longer):
            continue
        cuts = [(1000000 * a * a // (f[lang, *g[:k]] * f[lang, *g[k:]]), k) for k in range(1, len(g))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(g).encode(), f[lang, *g[:k]], f[lang, *g[k:]]))
    result = []
    for lang, phrases in out.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(phrases)[:top], 1):
            result.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(result)


def made_up(seed, docs=150):
    draw = random.Random(seed)
    words = ["New", "york", "CITY", "é", "É", "漢字", "a\x00b", "x\x85y", "x y", "ﬁ", "\x1c", "\x7f", "the", "of"]
    ends = [" ", " ", " ", "  ", "\t", ". ", "\n", "\x0b", ";", "! ", "\r\n"]
    rows = []
    for i in range(docs):
        text = "".join(draw.choice(words[: 4 + i % 11]) + draw.choice(ends) for _ in range(draw.randrange(0, 60)))
        rows.append((draw.choice([1, 2, None, i]), text, draw.choice(["en", "de", None, "und", ""]), "p", "n"))
    return rows + [(5, None, "en", "p", "n"), (6, "", None, "p", "n"), (7, " . \n", "xx", None, None), *rows[:20]]


@pytest.mark.parametrize("options", [{}, {"shared": 3, "chunk_words": 40, "bits": 64}, {"least": 2, "top": 7}])
def test_against_brute_force(spark, rows, options):
    data = made_up(4)
    got = rows(collocations(spark.createDataFrame(data, SCHEMA).repartition(5), **options))
    assert got == sorted(brute([(r[1], r[2]) for r in data], options.get("top", 2000), options.get("least", 10)), key=repr)
    assert got


def test_same_as_sql_on_odd_texts(spark, rows):
    data = [(r[1], r[2]) for r in made_up(9) if "\x00" not in (r[1] or "")]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (text VARCHAR, lang VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", data)
    got = rows(collocations(spark.createDataFrame(data, "text string, lang string")))
    assert got == sorted(con.execute(ORACLE).fetchall(), key=repr)


def test_one_structure_holds_all_counts(spark):
    table = spark.createDataFrame([(1, "a b a b c. a", "en", "", "")] * 10, SCHEMA)
    ones, twos = stripe_entries(table)
    got = {(r.prefix, r.next): r.n for r in ones.collect()}
    assert got == {("", ""): 60, ("a", ""): 30, ("b", ""): 20, ("c", ""): 10, ("a", "b"): 20, ("b", "a"): 10, ("b", "c"): 10}
    assert {(r.prefix, r.next): r.n for r in twos.collect()} == {("a b", "a"): 10, ("b a", "b"): 10, ("a b", "c"): 10}


def test_scores_beyond_64_bits(spark, rows):
    """1,000,000 * a * a passes 2**63 from about three million on."""
    from quire.llm.collocations import scored_phrases

    a, left, right = 3_000_000_019, 3_000_000_020, 7_000_000_001
    entries = [("en", "", "", 9 * right), ("en", "p", "", left), ("en", "q", "", right), ("en", "p", "q", a)]
    schema = "lang string, prefix string, next string, n bigint"
    scored = scored_phrases(spark.createDataFrame(entries, schema), spark.createDataFrame([], schema))
    assert rows(scored) == [("en", "p q", a, left, right, 1000000 * a * a // (left * right))]


def test_tie_of_cuts_goes_to_the_smallest(spark, rows):
    table = spark.createDataFrame([(1, "p q r", "en", "", "")] * 10, SCHEMA)
    assert rows(collocations(table)) == [("en", 1, "p q r", 10, 10, 10, 30, 1000000)]


def test_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert collocations(empty).collect() == []
    assert collocations(spark.createDataFrame([(1, "one two three", "en", "", "")], SCHEMA)).collect() == []
