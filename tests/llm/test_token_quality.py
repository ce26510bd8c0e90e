import math
import random
import re
from collections import Counter

import public_tokenizers
import pytest

from quire.llm.packing import vocabulary
from quire.llm.token_quality import STEP, judged, measured, quality_rows, repeated_words, script_of

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
WORD = re.compile(r"[^ \t-\r]+")
SCHEMA = "doc_id bigint, text string, lang string, kept string, n int"


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    dup = sum(line in lines[:i] for i, line in enumerate(lines))
    counts = len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(repeated)
    return counts, len(words) < 50 or 100 * len(repeated) > 50 * len(words)


@pytest.fixture(scope="module")
def meter():
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True

    def measures(text):
        if not text:
            return None, None, None
        ids, pieces = a.encode(text, add_special_tokens=False).ids, b.encode(text)
        n, counts = len(ids), Counter(ids)
        entropy = -sum(k / n * math.log2(k / n) for k in counts.values()) / math.log2(min(n, 1024)) if n > 1 else None
        return len(text) / n, sum(map(b.is_byte, pieces)) / len(pieces) if pieces else None, entropy

    return measures


def verdicts(rows):
    """``kept`` by plain medians of the measures in ``(band, base_failed, measures)``."""
    usual = {}
    for band in {r[0] for r in rows}:
        for m in range(3):
            steps = sorted(math.floor(r[2][m] / STEP) for r in rows if r[0] == band and not r[1] and r[2][m] is not None)
            usual[band, m] = steps[(len(steps) - 1) // 2] * STEP if steps else None
    out = []
    for band, failed, (chars, fallback, entropy) in rows:
        low, byte, even = (usual[band, m] for m in range(3))
        bad = chars is not None and low is not None and (chars * 1.5 < low or chars > (low + STEP) * 1.5)
        bad |= fallback is not None and byte is not None and fallback > (byte + STEP) * 3 + 0.1
        bad |= entropy is not None and even is not None and entropy < even * 0.6
        out.append(not failed and not bad)
    return out


def made_up(seed):
    draw = random.Random(seed)
    texts = []
    for i in range(60):
        alphabet = ["abcdefgh", "бвгджзик", "漢字語文学", "กขคงจฉ"][i % 4]
        word = lambda: "".join(draw.choice(alphabet) for _ in range(draw.randrange(1, 7)))
        texts.append("".join(word() + draw.choice([" ", " ", "\n", "\t", ", "]) for _ in range(draw.randrange(20, 120))))
    junk = "".join(chr(draw.randrange(0x2500, 0x25FF)) + draw.choice("ab ") for _ in range(300))
    codes = " ".join("%064x" % draw.getrandbits(256) for _ in range(60))
    texts += [None, "", " \n ", "# $ 1 2", "a a a a", "x\x85y x\x1cy\x1fz", "one two three " * 40, junk, codes]
    texts += ["same line here\n" * 3 + "\n\nsame line here ", "p q r\np q r\nq r s", texts[0], texts[0]]
    return list(enumerate(texts))


@pytest.mark.parametrize("shared", [500_000, 1])
def test_against_brute_force(spark, meter, small, shared):
    draw = random.Random(6)
    data = [(i, t, draw.choice([None, None, "aa", "bb"])) for i, t in made_up(8) + [(None, "no id here"), (4, "id four again")]]
    data += [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{small}/documents.parquet").limit(80).collect()]
    table = spark.createDataFrame([(*row, "y", 3) for row in data], SCHEMA)
    got = judged(measured(table.repartition(3), A, B), shared=shared).collect()
    expected = [(lang or script_of(t or ""), base(t)[1], meter(t)) for _, t, lang in data]
    kept = verdicts(expected)
    key = lambda row: tuple(round(v, 9) if isinstance(v, float) else v for v in row)
    mine = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept, r.chars_per_token, r.fallback_share, r.entropy_share) for r in got]
    plain = [(i, *base(t)[0], e[1], k, *e[2]) for (i, t, _), e, k in zip(data, expected, kept)]
    assert sorted(map(key, mine), key=repr) == sorted(map(key, plain), key=repr)


def test_bands_reject_junk_and_keep_prose(spark, small):
    clean = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang")
    draw = random.Random(2)
    junk = [
        (-1, " ".join("%064x" % draw.getrandbits(256) for _ in range(80)), "en"),
        (-2, "".join(chr(draw.randrange(0x2500, 0x25FF)) + draw.choice("ab ") for _ in range(900)), "en"),
        (-3, " ".join(f"aa{i} bb{i}" for i in range(5)) + " z" * 3, "en"),
    ]
    rows = quality_rows(clean.unionByName(spark.createDataFrame(junk, clean.schema)), A, B).collect()
    by_id = {r.doc_id: r for r in rows}
    assert not by_id[-1].base_failed and not by_id[-1].kept
    assert by_id[-2].rejected_by and by_id[-3].base_failed
    passed = [r for r in rows if r.doc_id >= 0 and not r.base_failed]
    assert sum(r.kept for r in passed) == len(passed)


def test_many_words():
    words = [b"%d" % i for i in range((1 << 21) + 5)]
    assert repeated_words(words) == 0 and repeated_words(words + words[7:10]) == 6


def test_a_long_text_is_not_less_even(spark, small):
    texts = [r.text for r in spark.read.parquet(f"{small}/documents.parquet").filter("lang = 'en' and n_chars > 800").collect()]
    rows = [(i, t, "en") for i, t in enumerate(texts)] + [(-1, "\n".join(texts * 8), "en")]
    judged_rows = judged(measured(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), A, B)).collect()
    assert {r.rejected_by for r in judged_rows if r.doc_id == -1} == {""}


def test_scripts():
    assert script_of("Straße") == "latin" and script_of("Жук a") == "cyrillic" and script_of("漢字かな") == "han"
    assert script_of("12 3!") == "none" and script_of("") == "none" and script_of("ab бв") == "cyrillic"


def test_no_rows(spark):
    assert quality_rows(spark.createDataFrame([], "doc_id bigint, text string, lang string"), A, B).collect() == []


def test_vocabulary_covers_all_bytes():
    assert {bytes([b]) for b in range(256)} <= set(vocabulary(A))
