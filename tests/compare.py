"""Run registered queries against their SQL counterparts: ``python tests/compare.py SF [NAME...]``."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _plain(value):
    return value.item() if hasattr(value, "item") else value


def difference(spark_df, con, sql):
    """None when both give the same rows (in any order), else a description."""
    columns = sorted(spark_df.columns)
    got = sorted((tuple(_plain(v) for v in r) for r in spark_df.select(*[f"`{c}`" for c in columns]).collect()), key=repr)
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return f"columns {columns} != {sorted(names)}"
    at = [names.index(c) for c in columns]
    expected = sorted((tuple(row[i] for i in at) for row in result.fetchall()), key=repr)
    if got == expected:
        return None
    pairs = [(a, b) for a, b in zip(got, expected) if a != b][:2]
    return f"{len(got)} rows against {len(expected)}; {columns}; first differences {pairs}"


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from quire.session import local_session

    folder = f"/root/testdata/sf{sys.argv[1]}"
    spark, con, sqls = local_session(8), connect(folder), oracle_sql()
    for name, query in queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        started = time.time()
        try:
            df = query(spark, folder)
            problem = difference(df, con, sqls[name]) if name in sqls else f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - started:.1f}s {problem or ''}", flush=True)
