"""Queries that SQL can express, against their SQL."""

import os

import duckdb
import pytest

from relmod.llm import queries as Q

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")
@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    want = db.execute(Q.SQL[name])
    names = [d[0] for d in want.description]
    got = Q.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(names)
    assert _rows(got.columns, [tuple(r) for r in got.collect()]) == _rows(names, want.fetchall())
