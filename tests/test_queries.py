"""Every registered query on the smallest tables, against its SQL where there is one."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_point
from replyloom.plans.oracles import oracle_sql
from replyloom.plans.queries import QUERIES
from replyloom.session import tune

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
ORACLES = oracle_sql()
WITHOUT_SQL = {"tfidf_lr_metrics", "kmeans_topics", "nmf_topics"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def text(value):
        if value is None or isinstance(value, float) and math.isnan(value):
            return "null"
        return f"{type(value).__name__}:{value!r}"

    return sorted(tuple(text(row[i]) for i in order) for row in rows)


def test_every_query_but_the_fitted_ones_has_sql():
    assert set(QUERIES) - set(ORACLES) == WITHOUT_SQL and set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLES) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    frame = QUERIES[name](spark, SF)
    cursor = duck.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(frame.columns) == sorted(names)
    assert canonical(frame.columns, frame.collect()) == canonical(names, cursor.fetchall())


@pytest.mark.parametrize("name", sorted(WITHOUT_SQL))
def test_fitted_query_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


def test_hot_joins_are_split(spark):
    assert tune(spark).conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "true"
