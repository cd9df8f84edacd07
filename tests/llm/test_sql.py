"""Queries with SQL counterparts on small tables."""

import duckdb
import pytest

from replyloom.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "benchmark"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    cursor = duck.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    want = sorted(map(repr, cursor.fetchall()))
    frame = QUERIES[name](spark, SF)
    assert sorted(frame.columns) == sorted(names)
    assert sorted(repr(tuple(r)) for r in frame.select(*names).collect()) == want


def test_every_operator_is_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
