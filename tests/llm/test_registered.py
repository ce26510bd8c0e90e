import re

import pytest
from compare import connect, difference

import __spark_entry__ as entry_file
from quire.llm.queries import ORACLES, QUERIES

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def test_all_are_registered():
    names = entry_file.queries()
    assert set(QUERIES) | {"pipeline"} <= set(names)
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(entry_file.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, name):
    folder = "/root/testdata/sf0.01"
    df, engine = QUERIES[name](spark, folder), connect(folder)
    assert {n: TYPES[t] for n, t in df.dtypes} == {d[0]: str(d[1]) for d in engine.execute(ORACLES[name]).description}
    assert difference(df, engine, ORACLES[name]) is None
