import random

from quire.llm.components import components


def test_random_graphs(spark, rows, union_find):
    for seed in range(3):
        random.seed(seed)
        edges = [(random.randrange(300), random.randrange(300)) for _ in range(170)]
        found = union_find()
        for a, b in edges:
            found.join(a, b)
        joined = {x for e in edges if e[0] != e[1] for x in e}
        expected = sorted(((x, found.find(x)) for x in joined), key=repr)
        df = spark.createDataFrame(edges, "a bigint, b bigint")
        assert rows(components(df), "id", "component") == expected


def test_chain_hub_and_odd_edges(spark, rows):
    chain = [(i, i + 1) for i in range(200)]
    hub = [(1000, 1000 + i) for i in range(1, 300)]
    odd = [(None, 3), (4, None), (5000, 5000), (3, 2), (2, 3)]
    df = spark.createDataFrame(chain + hub + odd, "a bigint, b bigint")
    expected = [(i, 0) for i in range(201)] + [(1000 + i, 1000) for i in range(300)]
    assert rows(components(df), "id", "component") == sorted(expected, key=repr)


def test_no_edges(spark):
    df = spark.createDataFrame([], "a bigint, b bigint")
    assert components(df).count() == 0
