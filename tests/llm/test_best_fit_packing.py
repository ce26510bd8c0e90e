import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from quire.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(PATH)
    return model


def item_by_item(lengths, capacity):
    """Best-two-fit one sequence at a time."""
    left, out = sorted(lengths), []
    while left:
        room, taken = capacity, []
        while fits := [x for x in left if x <= room]:
            taken.append(fits[-1])
            left.remove(fits[-1])
            room -= fits[-1]
        if room:
            gap = room + taken[-1]
            pairs = [
                (a + b, a, b) for j, a in enumerate(left) for b in left[:j] if taken[-1] < a + b <= gap
            ]
            if pairs:
                _, a, b = max(pairs)
                left.remove(a)
                left.remove(b)
                left = sorted([*left, taken.pop()])
                taken += [a, b]
        out.append(sorted(taken))
    return sorted(out)


def test_plan_is_item_by_item_packing():
    for seed in range(30):
        random.seed(seed)
        lengths = [random.randint(1, 40) for _ in range(60)]
        counts = {x: lengths.count(x) for x in set(lengths)}
        plan = packing.best_two_fit(counts, 50)
        got = sorted(sorted(sizes) for sizes, copies in plan for _ in range(copies))
        assert got == item_by_item(lengths, 50)


def test_two_replace_the_smallest():
    assert packing.best_two_fit({6: 1, 3: 1, 2: 2}, 10) == [([6, 2, 2], 1), ([3], 1)]


def test_bounds():
    assert packing.piece_bounds(3, 4) == [0, 3]
    assert packing.piece_bounds(4, 4) == [0, 4]
    assert packing.piece_bounds(9, 4) == [0, 1, 5, 9]
    assert packing.piece_bounds(8, 4) == [0, 4, 8]


def check(rows, texts, tokenizer):
    by_doc, by_sequence, total = {}, {}, 0
    for r in sorted(rows, key=lambda r: (r.doc_id, r.piece)):
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(by_doc) == set(texts)
    for key, text in texts.items():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        total += len(ids)
        at = 0
        for number, r in enumerate(by_doc[key]):
            assert (r.piece, r.start) == (number, at)
            assert r.length == 1024 or number == 0
            at += r.length
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : at], "<u4").tobytes())
        assert at == len(ids)
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    return len(by_sequence), -(-total // 1024)


def test_documents(spark, small, tokenizer):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    used, bound = check(packing.packed_pieces(docs, PATH).collect(), texts, tokenizer)
    assert used <= bound * 1.05


def test_odd_texts(spark, tokenizer):
    odd = ["", None, "\0", " ", "a  b\n\n \tc", "don't <|endoftext|> don’t", "\x1c\x85　x", "é́ß 日本 👩‍🚀",
           "word " * 3000, "x" * 5000, "\r\n" * 40, "same", "same"]
    docs = spark.createDataFrame(list(enumerate(odd)), "doc_id bigint, text string").withColumn("length", F.lit("x"))
    check(packing.packed_pieces(docs, PATH).collect(), dict(enumerate(odd)), tokenizer)
    assert packing.packed_pieces(docs.limit(0), PATH).count() == 0


def test_repeated_rows_are_packed_each(spark):
    docs = spark.createDataFrame([(1, "a b c")] * 5 + [(None, "d")], "doc_id bigint, text string")
    rows = packing.packed_pieces(docs, PATH).collect()
    assert len(rows) == 6
    assert len({(r.sequence_id, r.offset) for r in rows}) == 6


def test_sequences_hold_the_ids(spark, tokenizer):
    docs = spark.createDataFrame([(i, f"text {i} " * (i + 1)) for i in range(30)], "doc_id bigint, text string")
    placed = packing.place(packing.pieces(docs, PATH, capacity=64), capacity=64)
    for r in packing.sequences(placed).collect():
        assert len(r.input_ids) == sum(r.lengths) <= 64
        assert len(r.doc_ids) == len(r.lengths)
    total = sum(len(tokenizer.encode(f"text {i} " * (i + 1)).ids) + 1 for i in range(30))
    assert sum(len(r.input_ids) for r in packing.sequences(placed).collect()) == total
