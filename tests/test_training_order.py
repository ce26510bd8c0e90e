import hashlib

import pytest

from quire.operators.training_order import collate, epoch_plan

SCHEMA = "split string, chunk_id bigint, input_ids array<int>"


@pytest.fixture(scope="module")
def packed(spark):
    rows = [("train", i, list(range(1, 9 if i != 40 else 6))) for i in range(41)]
    rows += [("val", i, [7, 0, 7]) for i in range(5)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_plan(packed):
    got = {}
    for r in epoch_plan(packed, 0.5, 2, 3).collect():
        got.setdefault(r.split, {})[r["rank"]] = (r.chunk_id, r.batch_id, r.step_id)
    for split, n, kept in (("train", 41, 21), ("val", 5, 3)):
        order = sorted(range(n), key=lambda c: (hashlib.md5(f"42:{c}".encode()).hexdigest(), c))
        assert got[split] == {i: (order[i], i // 2, i // 6) for i in range(kept)}


def test_whole_epochs_and_bad_fraction(packed):
    assert epoch_plan(packed, 1.0).count() == 46
    with pytest.raises(ValueError):
        epoch_plan(packed, 0)


@pytest.mark.parametrize("mode", ["position", "token"])
def test_collate(packed, mode):
    plan = epoch_plan(packed, 1.0, 4, 2)
    longest = {}
    for r in plan.collect():
        key = (r.split, r.batch_id)
        longest[key] = max(longest.get(key, 0), r.n_tokens)
    padded = 0
    for r in collate(packed, plan, 0, mask_pad_by=mode).collect():
        n = longest[r.split, r.batch_id]
        ids = [7, 0, 7] if r.split == "val" else list(range(1, 9 if r.chunk_id != 40 else 6))
        missing = n - len(ids)
        padded += missing
        assert r.input_ids == ids + [0] * missing
        assert r.attention_mask == [1] * len(ids) + [0] * missing
        labels = [-100 if mode == "token" and t == 0 else t for t in ids]
        assert r.labels == labels + [-100] * missing
    assert padded == 3


def test_mode_is_checked(packed):
    with pytest.raises(ValueError):
        collate(packed, epoch_plan(packed), 0, mask_pad_by="other")
