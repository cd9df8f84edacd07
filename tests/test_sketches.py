"""Sketches: unions equal one sketch of all rows, estimates lie within their bounds."""

import pytest
from pyspark.sql import functions as F

from replyloom.operators import sketches


@pytest.fixture(scope="module")
def rows(spark):
    """80,000 values in two overlapping sets, with repeats and nulls, and a small set."""
    a = spark.range(0, 50_000).select(F.lit("a").alias("k"), (F.col("id") % 12).alias("m"), F.col("id").alias("v"))
    b = spark.range(20_000, 80_000).select(F.lit("b").alias("k"), (F.col("id") % 12).alias("m"), F.col("id").alias("v"))
    c = spark.range(100).select(F.lit("c").alias("k"), F.lit(0).cast("bigint").alias("m"), (F.col("id") % 10).alias("v"))
    nulls = c.withColumn("v", F.lit(None).cast("bigint"))
    return a.unionByName(a).unionByName(b).unionByName(c).unionByName(nulls)


def test_union_of_parts_is_the_whole(spark, rows):
    parts = sketches.distinct_sketches(rows, ["k", "m"], "v")
    joined = {r.k: r[1:] for r in sketches.estimates(sketches.united(parts, ["k"]), ["k"]).collect()}
    whole = {r.k: r[1:] for r in sketches.estimates(sketches.distinct_sketches(rows, ["k"], "v"), ["k"]).collect()}
    exact = {"a": 50_000, "b": 60_000, "c": 10}
    for k, n in exact.items():
        assert joined[k][1] == pytest.approx(whole[k][1], rel=sketches.THETA_BOUND)
        assert abs(joined[k][0] - n) <= sketches.HLL_BOUND * n + 0.5 and abs(joined[k][1] - n) <= sketches.THETA_BOUND * n + 0.5
    assert joined["c"][1] == 10


def test_overlaps(rows):
    found = {(r.left_set, r.right_set): r for r in sketches.shared(sketches.distinct_sketches(rows, ["k"], "v"), "k").collect()}
    assert set(found) == {("a", "b"), ("a", "c"), ("b", "c")}
    assert abs(found["a", "b"].shared - 30_000) <= sketches.THETA_BOUND * 80_000
    assert abs(found["a", "b"].together - 80_000) <= sketches.THETA_BOUND * 80_000
    assert found["b", "c"].shared == 0


def test_nothing(rows):
    assert sketches.distinct_sketches(rows.limit(0), ["k"], "v").count() == 0


def test_within(spark):
    row = spark.range(1).select(
        sketches.within(F.lit(103), F.lit(100), 0.03), sketches.within(F.lit(104), F.lit(100), 0.03),
        sketches.within(F.lit(5), F.lit(0), 0.03, F.lit(200)), sketches.within(F.lit(0), F.lit(0), 0.03),
    ).first()
    assert tuple(row) == (True, False, True, True)
