import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from quire.llm.alignment import Tokenizers, align, alignment_rows, gallop
from quire.llm.byte_tokens import plain_encoder
from quire.llm.packing import vocabulary

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def plain():
    """A function from a text to its tokens' ids and bytes by both libraries themselves."""
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    content = {i: t for t, i in vocabulary(A).items()}

    def of_piece(i):
        return bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()

    def both(text):
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        return [(i, content[i]) for i in ids_a], [(i, of_piece(i)) for i in ids_b]

    return both


def grouped(plain, text):
    """Groups ``(ids of A, ids of B)`` of a text, one byte at a time."""
    if not text:
        return []
    sides = plain(text)
    if any(b"".join(t for _, t in side) != b" " + text.encode() for side in sides):
        return []
    ends = [[], []]
    for side, out in zip(sides, ends):
        at = 0
        for i, token in side:
            at += len(token)
            out.append((at, i))
    common = sorted({e for e, _ in ends[0]} & {e for e, _ in ends[1]})
    groups, low = [], 0
    for high in common:
        groups.append(tuple([i for e, i in out if low < e <= high] for out in ends))
        low = high
    return groups


def brute(plain, rows):
    all_groups = [grouped(plain, text) for _, text in rows]
    links = [Counter((a, b) for x, y in groups for a in x for b in y) for groups in all_groups]
    documents = Counter(link for found in links for link in found)
    most = defaultdict(int)
    for (a, _), n in documents.items():
        most[a] = max(most[a], n)
    out = []
    for (doc_id, _), groups, found in zip(rows, all_groups, links):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        best = sum(n for link, n in found.items() if documents[link] == most[link[0]])
        out.append((
            doc_id, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(found.values()), best,
            sum(n * documents[link] for link, n in found.items()), hashlib.sha256(text.encode()).hexdigest() if groups else "",
        ))
    return sorted(out, key=repr)


def odd_texts(seed, n):
    draw = random.Random(seed)
    letters = "ab \n\t  éß漢字語ก<|endoftext|>▁12345<s> \x00'llé"
    return ["".join(draw.choice(letters) for _ in range(draw.randrange(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("shared", [500_000, 3])
def test_against_brute_force(spark, rows, plain, small, shared):
    texts = [r.text for r in spark.read.parquet(f"{small}/documents.parquet").limit(60).collect()]
    data = list(enumerate(texts + odd_texts(5, 150) + [None, "", "<|endoftext|> x </s>"]))
    data += [(None, "the end"), (3, "the end"), (3, "the end")]
    table = spark.createDataFrame([(i, t, "x", 7) for i, t in data], "doc_id bigint, text string, links string, a int")
    assert rows(alignment_rows(table.repartition(4), A, B, shared=shared)) == brute(plain, data)


def test_texts_without_tokens(plain):
    t = Tokenizers(vocabulary(A), open(B, "rb").read())
    columns = [c.to_pylist() for c in align(t, [None, "", "▁", "a ▁b", "ok"])]
    assert [row[:5] for row in zip(*columns)][:4] == [(0, 0, 0, 0, "")] * 4
    assert columns[0][4] and len(columns[4][4]) == 64


@pytest.mark.parametrize("text", ["7" * 4000, "漢" * 900, "ก็" * 700, "a" * 9000, "=-" * 3000])
def test_few_common_ends(plain, text):
    t = Tokenizers(vocabulary(A), open(B, "rb").read())
    (n_a,), (n_b,), (n_groups,), (n_links,), _, (links,) = (c.to_pylist() for c in align(t, [text]))
    groups = grouped(plain, text)
    expected = sum((Counter((a, b) for a in x for b in y) for x, y in groups), Counter())
    assert (n_a, n_b, n_groups) == (sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups))
    assert {(link["a"], link["b"]): link["n"] for link in links} == expected and n_links == expected.total()


def test_gallop():
    draw = np.random.default_rng(1)
    for _ in range(200):
        ends = np.unique(draw.integers(0, 300, draw.integers(1, 80)))
        wanted = draw.integers(0, ends[-1] + 1, 30)
        found = gallop(wanted, ends, draw.integers(0, len(ends), 30))
        place = {e: i for i, e in enumerate(ends.tolist())}
        assert found.tolist() == [place.get(w, -1) for w in wanted.tolist()]


def test_long_runs_of_blanks():
    """The same ids as for short runs, whose pattern they share."""
    encode, ranks = plain_encoder(vocabulary(A)), vocabulary(A)
    content = {i: t for t, i in ranks.items()}
    for text in (" " * 700_000, "a" + " " * 700_000 + "b\n", "\n" * 300_000 + "  " + "x" * 10):
        ids = encode(text)
        assert b"".join(content[i] for i in ids.tolist()) == text.encode()
    import quire.llm.byte_tokens as module

    texts = ["a" + " " * n + end for n in range(1, 40) for end in ("", "b", "\n", "　c", ".")]
    expected = [encode(t).tolist() for t in texts]
    old = module._LONG_RUN, module._BLANKS
    try:
        module._LONG_RUN, module._BLANKS = 0, module.re.compile(module._BLANKS.pattern.replace("100000", "3"))
        assert [encode(t).tolist() for t in texts] == expected
    finally:
        module._LONG_RUN, module._BLANKS = old


def test_no_rows(spark):
    assert alignment_rows(spark.createDataFrame([], "doc_id bigint, text string"), A, B).collect() == []
