import random
import re

import pytest
from pyspark.sql import functions as F

from quire.fixed_values import WHITESPACE
from quire.functions import cleaning as C
from quire.functions.text import decode_lossy, strip, universal_newlines
from quire.operators.cleaning import accepted, gate, rejected, report

START = "*** START OF THE PROJECT GUTENBERG EBOOK X ***"
END = "*** END OF THE PROJECT GUTENBERG EBOOK X ***"
SIXTY = "\n".join(["license"] * 60)
WORDS = "\n".join(["word"] * 60)

WHOLE = [
    (f"hdr\n{START}\nBody here\n{END}\nlic", "Body here"),
    ("hdr\n***start of the project gutenberg ebook x ***\nBody here\n***END OF PROJECT GUTENBERG EBOOK***\nlic", "Body here"),
    ("*** START OF PROJECT GUTENBERG EBOOK ***\nkeep ***\n***START OF PROJECT GUTENBERG EBOOK***\nrest", "keep ***\n***START OF PROJECT GUTENBERG EBOOK***\nrest"),
    ("***START OF PROJECT GUTENBERG EBOOK***\nmid\n*** START OF PROJECT GUTENBERG EBOOK ***\nrest", "rest"),
    (f"one\n{END}\n{START}\ntwo", ""),
    ("*** START OF PROJECT GUTENBERG EBOOK *** END OF PROJECT GUTENBERG EBOOK ***\nx", ""),
    ("The Project Gutenberg eBook\n\nOnce upon", "Once upon"),
    ("*** START OF THE PROJECT\nGUTENBERG EBOOK X ***\nfirst words", "*** START OF THE PROJECT\nGUTENBERG EBOOK X ***\nfirst words"),
    (SIXTY, SIXTY),
    ("license abc\nabc\ntail", "abc\nabc\ntail"),
    ("\n".join(["license"] * 50) + "\nfound\nmore", "found\nmore"),
    ("\n".join(["license"] * 51) + "\nfound\nmore", "\n".join(["license"] * 51) + "\nfound\nmore"),
    ("abc [ILLUSTRATION: a\nb] def", "abc  def"),
    ("abc [Illustration] def", "abc  def"),
    ("abc [sidenote: q] def", "abc [sidenote: q] def"),
    ("abc [Sidenote: q\nr] def", "abc  def"),
    ("abc [Footnote 1: see [a] b] def", "abc  b] def"),
    ("Intro\n\nTranscriber's Notes: x\ny\n\nStory", "Intro\n\n\nStory"),
    ("Intro\n\nTranscriber's Note: x", "Intro"),
    ("Intro Transcriber’s Note: x", "Intro Transcriber’s Note: x"),
    ("Front\nContents\nI\nII\n\nCHAPTER 1", "Front\n\nCHAPTER 1"),
    ("Front\n \n TABLE of Contents \nI\nII\n\n\nthe", "Front\n\n\nthe"),
    (f"Front\nContents\n{WORDS}", f"Front\nContents\n{WORDS}"),
    ("Front\n\n Contents\na\n\nCHAPTER 1\nContents\nb\n\n\nX", "Front\n\nCHAPTER 1\n\n\nX"),
    ("Front\nContents\na\n\nX", "Front\nContents\na\n\nX"),
    ("Front\nContents\na\n\n\nContents\nb\n\n\nX", "Front\n\n\nX"),
    ("abc\n\n\ndef", "abc\n\n\ndef"),
    ("abc\n\n\n\ndef", "abc\n\n\ndef"),
    ("abc\n \n\n \n  def", "abc\n\n\n  def"),
    ("A\n\n--\n  Real line", "  Real line"),
    ("ab\nc", ""),
    ("ab\na b\nrest", "a b\nrest"),
    ("　\x1c\x85 abc  ", "abc"),
    ("a\U0001F600\nx\U0001F600y\nz", "x\U0001F600y\nz"),
    ("", ""),
    (None, None),
]


def test_whole_chain(spark):
    rows = [(i, text) for i, (text, _) in enumerate(WHOLE)]
    df = spark.createDataFrame(rows, "i int, text string")
    got = {r.i: r.c for r in df.select("i", C.clean(F.col("text")).alias("c")).collect()}
    for i, (text, expected) in enumerate(WHOLE):
        assert got[i] == expected, (text, got[i], expected)


def test_whitespace_set_is_the_unicode_one():
    assert sorted(WHITESPACE) == [chr(c) for c in range(0x110000) if chr(c).isspace()]


def _short_lines_dropped(text):
    lines = text.split("\n")
    keep = next((i for i, line in enumerate(lines) if len(line.strip()) >= 3), None)
    return "" if keep is None else "\n".join(lines[keep:])


def _runs_collapsed(text):
    out, i = [], 0
    while i < len(text):
        j = i
        while j < len(text) and text[j].isspace():
            j += 1
        run = text[i:j]
        if run.count("\n") >= 4:
            out.append(run[: run.index("\n")] + "\n\n\n" + run[run.rindex("\n") + 1 :])
        else:
            out.append(run)
        if j < len(text):
            out.append(text[j])
        i = j + 1
    return "".join(out)


def test_line_rules_on_random_text(spark):
    rng = random.Random(5)
    alphabet = ["\n", "\n", "\n", " ", "\t", "a", "b", "\U0001F600", " ", "\x1c", "."]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    t = F.col("t")
    rows = df.select(
        "i",
        C.drop_short_leading_lines(t).alias("short"),
        C.collapse_blank_runs(t).alias("runs"),
        strip(t).alias("strip"),
    ).collect()
    for r in rows:
        assert r.short == _short_lines_dropped(texts[r.i]), repr(texts[r.i])
        assert r.runs == _runs_collapsed(texts[r.i]), repr(texts[r.i])
        assert r.strip == texts[r.i].strip()


def test_contents_block_after_short_and_long_runs(spark):
    rng = random.Random(11)
    pieces = ["\n", "\n", " ", "Contents", "table of contents", "x", "\n\nChapter", "\nCHAPTER", "\n\nA"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 40))) for _ in range(5000)]
    long = [("\n" * 1200 if i % 50 == 0 else "") + text for i, text in enumerate(texts)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(zip(texts, long))], "i int, a string, b string")
    rows = df.select("i", C.drop_contents_block(F.col("a")).alias("a"), C.drop_contents_block(F.col("b")).alias("b"))
    pattern = re.compile(
        r"\n\s*(?:Contents|Table of Contents)\s*\n(?:.*?\n){1,50}?(?=\n\n[A-Z]|\nCHAPTER)", re.I
    )
    changed = 0
    for r in rows.collect():
        assert r.a == pattern.sub("\n", texts[r.i])
        assert r.b == pattern.sub("\n", long[r.i])
        changed += r.a != texts[r.i]
    assert changed > 100


def test_long_runs_need_no_stack(spark):
    text = "abc" + "\n" * 300_000 + "def"
    df = spark.createDataFrame([(text,), ("a\n" * 100_000 + "whole",)], "text string")
    got = [r.c for r in df.select(C.clean(F.col("text")).alias("c")).collect()]
    assert got == ["abc\n\n\ndef", "whole"]


def test_decoding(spark):
    rng = random.Random(7)
    pool = b"\x61\x41\x42\x01\xff\xef\xbf\xbd\xe2\x82\xac\xf0\x9f\x98\x80\xed\xa0\x80\xc0\xaf\xf4\x90\x0a\x0d"
    cases = [b"ab\xff\xefc", b"a\r\nb\rc", "�\x01B\x01A".encode(), b"\x01\xff", b""]
    cases += [bytes(rng.choice(pool) for _ in range(rng.randint(0, 16))) for _ in range(5000)]
    df = spark.createDataFrame([(i, bytearray(b)) for i, b in enumerate(cases)], "i int, b binary")
    rows = df.select("i", universal_newlines(decode_lossy(F.col("b"))).alias("t")).collect()
    for r in rows:
        text = cases[r.i].decode("utf-8", "ignore").replace("\r\n", "\n").replace("\r", "\n")
        assert r.t == text, cases[r.i]


def test_gate(spark):
    rows = [("a", "x" * 999), ("b", "x" * 1000), ("c", None), ("d", "x" * 1500)]
    gated = gate(spark.createDataFrame(rows, "doc_id string, text string"))
    got = {r.doc_id: (r.status, r.n_chars, r.message) for r in gated.collect()}
    assert got == {
        "a": ("skipped", 999, "too short (999 chars)"),
        "b": ("success", 1000, None),
        "c": ("failed", None, "unreadable text"),
        "d": ("success", 1500, None),
    }
    assert {r.doc_id for r in accepted(gated).collect()} == {"b", "d"}
    assert {r.doc_id for r in rejected(gated).collect()} == {"a", "c"}
    assert {(r.status, r.n_docs, r.n_chars) for r in report(gated).collect()} == {
        ("success", 2, 2500), ("skipped", 1, None), ("failed", 1, None)
    }


def test_filter_does_not_repeat_the_chain(spark):
    df = spark.createDataFrame([("a", "x")], "doc_id string, text string")
    plan = accepted(gate(df))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Footnote") == 1
