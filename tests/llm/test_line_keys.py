"""Keys of lines: few, not those of common phrases, and never too few."""

import random

import numpy as np

from quire.llm import line_dedup as L


def test_phrases_of_rare_words_are_no_keys(spark, monkeypatch):
    """The words of the phrase are rarer than those around it, but its pairs of words are not."""
    draw = random.Random(2)
    phrase = " ".join(f"p{i}" for i in range(8))
    words = [f"w{i}" for i in range(200)]
    texts = []
    for i in range(1_200):
        own = " ".join(draw.choices(words, k=40))
        texts.append(f"{own} {phrase} {draw.choice(words)}" if i % 20 == 0 else own)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    most, stage = [], L.stage

    def watched(df, name):
        table = stage(df, name)
        if name == "met-keys":
            most.append(table.agg({"lines": "max"}).first()[0] or 0)
        return table

    monkeypatch.setattr(L, "stage", watched)
    assert all(r.n_removed == 0 for r in L.deduped_lines(docs).collect())
    assert max(most) < 20


def keys_of(words, levels):
    rows, keys = L.gram_keys(np.array(words, "<u4"), np.array([len(words)]), levels)
    return set(keys.tolist())


def test_edits_of_the_keys_leave_one():
    """The allowed edits, spent where they change most of a line's keys."""
    draw = random.Random(8)
    for n in [*range(5, 45), 58, 77, 120]:
        for kind in range(12):
            words = draw.sample(range(1 << 31), n)
            levels = np.array([draw.randrange(64) for _ in range(1 << 10)], np.uint8) if kind % 2 else None
            own = keys_of(words, levels)
            # A pair of words is a key of the line if it is one of a line's keys.
            hashes = L._pair_hashes(np.array(words, "<u4"), np.arange(n - 1))
            left = {i for i, h in enumerate(hashes.tolist()) if any(k & (1 << L._HASH_BITS) - 1 == h for k in own)}
            added = kind % 3
            longer = n + (n // 8 if added else 0)
            edits, inserted, changed = longer // 5, set(), set()
            for _ in range(edits - len(range(n, longer))):
                at = max(range(n), key=lambda j: len({j - 1, j} & left))
                left -= {at - 1, at}
                changed.add(at)
            for at in sorted(left)[: longer - n]:
                inserted.add(at)
            other = []
            for i, w in enumerate(words):
                other.append(draw.getrandbits(31) if i in changed else w)
                if i in inserted:
                    other.append(draw.getrandbits(31))
            if L.similar(words, other):
                assert own & keys_of(other, levels), (n, kind)


def test_fewer_keys_than_pairs_that_two_edits_each_change():
    draw = random.Random(9)
    sizes = np.array([draw.randrange(5, 120) for _ in range(500)])
    words = np.array([draw.getrandbits(32) for _ in range(sizes.sum())], "<u4")
    rows, keys = L.gram_keys(words, sizes)
    assert len(keys) < 0.9 * L.prefix_sizes(sizes).sum()
    assert (np.bincount(rows, minlength=len(sizes)) > 0).all()


def test_lines_that_meet_only_the_commonest_are_not_written(spark, monkeypatch):
    """Two lines that share a key but are not near to each other need no row."""
    base = [[f"a{i}x{j}" for j in range(30)] for i in range(20)]
    texts = [" ".join(b) for b in base] + [" ".join([*b[:12], *(f"b{i}x{j}" for j in range(18))]) for i, b in enumerate(base)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows, stage = [], L.stage

    def counted(df, name):
        table = stage(df, name)
        if name == "met-keys":
            rows.append(table.count())
        return table

    monkeypatch.setattr(L, "stage", counted)
    assert all(r.n_removed == 0 for r in L.deduped_lines(docs).collect())
    assert sum(rows) == 0
