"""Each query with SQL equals it on the same tables; every query keeps its promised columns."""

import math
import os

import duckdb
import pytest

from changeflow.llm.queries import ORACLE, QUERIES

DATA = os.environ.get("LLM_TEST_DATA", "/root/testdata/sf0.001")


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for file in os.listdir(DATA):
        con.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM read_parquet('{DATA}/{file}')")
    got = QUERIES[name](spark, DATA)
    want = con.execute(ORACLE[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    assert rows_of(got.columns, got.collect()) == rows_of(names, want.fetchall())
