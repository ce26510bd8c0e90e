import pytest
from compare import connect, difference

import __spark_entry__ as entry_file
from quire.plans.oracles import ORACLES as SQL
from quire.plans.queries import QUERIES
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def engine(small):
    return connect(small)


def test_every_query_has_sql():
    # Merges are beyond SQL: tests/test_subwords.py compares with another encoder.
    assert set(QUERIES) - set(SQL) == {"tokens_subword_ids", "tokens_subword_counts"} and set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, engine, small, name):
    df = QUERIES[name](spark, small)
    types = {n: TYPES[t] for n, t in df.dtypes}
    assert types == {d[0]: str(d[1]) for d in engine.execute(SQL[name]).description}
    assert difference(df, engine, SQL[name]) is None


def test_entry(spark):
    assert entry_file.entry(spark).count() > 0
