import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import embedding_dedup as E


def test_nearest_e8_is_nearest():
    points = np.concatenate([np.zeros((1, 8)), E.shortest_vectors()])
    assert len(points) == 241
    random = np.random.default_rng(3)
    for x in random.normal(scale=0.35, size=(300, 8)):
        found = E.nearest_e8(x[None])[0]
        assert ((x - found) ** 2).sum() <= ((x - points) ** 2).sum(1).min() + 1e-9
        assert np.allclose(found * 2, np.rint(found * 2)) and found.sum() % 2 == 0


def pairs_at(cosine, n, dimension, seed):
    random = np.random.default_rng(seed)
    a = random.normal(size=(n, dimension))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = random.normal(size=(n, dimension))
    b -= (a * b).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    return a, cosine * a + np.sqrt(1 - cosine**2) * b


@pytest.mark.parametrize("dimension", [16, 64, 300])
def test_recall_at_the_threshold(dimension):
    a, b = pairs_at(0.93, 1000, dimension, 4)
    labels = np.zeros(1000, np.int64)
    shared = [bool(set(x) & set(y)) for x, y in zip(E.lattice_keys(a, labels).tolist(), E.lattice_keys(b, labels).tolist())]
    assert np.mean(shared) >= 0.98
    a, b = pairs_at(0.97, 1000, dimension, 5)
    shared = [bool(set(x) & set(y)) for x, y in zip(E.lattice_keys(a, labels).tolist(), E.lattice_keys(b, labels).tolist())]
    assert np.mean(shared) >= 0.999


def brute(data, union_find, threshold=0.93):
    found, links = union_find(), {}
    usable = [
        (i, np.array(v, float), label)
        for i, v, label in data
        if i is not None and v and label is not None and all(c is not None and np.isfinite(c) for c in v) and any(v)
    ]
    for (i, v, a), (j, w, b) in itertools.combinations(usable, 2):
        if a == b and len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= threshold:
            found.join(i, j)
            links[i] = links.get(i, 0) + 1
            links[j] = links.get(j, 0) + 1
    return {i: (links.get(i, 0), found.find(i), found.find(i) == i) for i, _, _ in data}


def got(df):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in df.collect()}


@pytest.mark.parametrize("block", [E.BLOCK, 8])
def test_against_all_pairs(spark, union_find, monkeypatch, block):
    monkeypatch.setattr(E, "BLOCK", block)
    random = np.random.default_rng(block)
    data, i = [], 0
    for group in range(12):
        base = random.normal(size=32)
        for _ in range(25):
            data.append((i, (base + random.normal(scale=0.15, size=32)).tolist(), group % 3))
            i += 1
    data += [(i + k, data[0][1], 0) for k in range(4)]
    df = spark.createDataFrame(data, "vec_id bigint, embedding array<double>, label int")
    assert got(E.near_vectors(df)) == brute(data, union_find)


def test_given_vectors(spark, small, union_find):
    df = spark.read.parquet(f"{small}/embeddings.parquet")
    data = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    assert got(E.near_vectors(df)) == brute(data, union_find)


def test_odd_rows(spark, union_find):
    good = [float(x) for x in range(1, 9)]
    data = [
        (1, good, 1), (2, good, 1), (3, good, 2), (4, good, None), (5, None, 1), (6, [], 1), (7, [0.0] * 8, 1),
        (8, [*good[:7], None], 1), (9, [*good[:7], float("nan")], 1), (10, [*good[:7], float("inf")], 1),
        (11, [*good, 1.0], 1), (12, [2 * x for x in good], 1), (13, [5.0], 1), (14, [7.0], 1),
    ]
    df = spark.createDataFrame(data, "vec_id bigint, embedding array<double>, label int")
    extra = df.withColumn("keys", F.lit("x")).withColumn("rep", F.lit("y"))
    assert got(E.near_vectors(extra)) == brute(data, union_find)
    assert E.near_vectors(df.limit(0)).count() == 0
