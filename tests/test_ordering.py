import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from replyloom.operators import ordering, profile
from replyloom.operators.ordering import group_quantiles


def frame(spark, values, kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}").repartition(5)


RNG = np.random.RandomState(3)
SAMPLES = {
    "uniform": RNG.rand(5000).tolist(),
    "one hot value": [0.25] * 3000 + RNG.rand(2000).tolist(),
    "outliers": [-1.7e308, 1.7e308, *RNG.rand(3000).tolist()],
    "two values": [1.0, 2.0] * 50,
    "single": [7.0],
}


@pytest.mark.parametrize("name", SAMPLES)
def test_order_statistics(spark, name):
    values = SAMPLES[name]
    ranks = sorted({0, len(values) // 4, len(values) // 2, len(values) - 1})
    got = ordering.order_statistics(frame(spark, values), "v", ranks, buckets=16)
    assert got == [sorted(values)[r] for r in ranks]


def test_order_statistics_need_finite_values(spark):
    with pytest.raises(ValueError, match="not finite"):
        ordering.order_statistics(frame(spark, [1.0, float("nan"), 2.0]), "v", [0])


def test_order_statistics_of_big_integers(spark):
    values = [2**62 + i for i in range(400)]
    got = ordering.order_statistics(frame(spark, values, "bigint"), "v", [0, 123, 399], buckets=16)
    assert got == [values[0], values[123], values[399]]


def test_neighbouring_doubles_are_told_apart(spark):
    values = [1.0 + i * 2.0**-52 for i in range(70)] + [-(2.0**-1074), 0.0, 2.0**-1074]
    got = ordering.order_statistics(frame(spark, values), "v", [0, 1, 2, 3, 40, 72], buckets=16)
    assert got == [sorted(values)[r] for r in (0, 1, 2, 3, 40, 72)]


@pytest.mark.parametrize("rows", [5, 777])
def test_quantiles_refuse_nan_at_every_size(spark, rows):
    df = frame(spark, [*SAMPLES["uniform"][:rows], float("nan")])
    with pytest.raises(ValueError, match="not finite"):
        ordering.quantiles(df, "v", [0.5])
    assert spark.range(1).select(*ordering.quantiles(frame(spark, [None]), "v", [0.5])).first()[0] is None


@pytest.mark.parametrize("rows", [5, 777])
def test_quantiles_interpolate(spark, rows):
    values = SAMPLES["uniform"][:rows] + [None, None]
    df = frame(spark, values)
    columns = ordering.quantiles(df, "v", [0.25, 0.5, 0.75])
    got = list(df.agg(*[c.alias(f"q{i}") for i, c in enumerate(columns)]).first())
    assert got == pytest.approx(np.percentile(values[:-2], [25, 50, 75]).tolist(), abs=1e-12)


def test_time_cutoffs(spark):
    df = spark.range(1000).select(
        F.timestamp_add("SECOND", F.col("id") * 37 % 1000, F.lit("2017-10-01 00:00:00").cast("timestamp_ntz")).alias("at")
    )
    row = profile.time_cutoffs(df, F.col("at")).first()
    texts = [str(row[c]) for c in ("earliest", "cutoff_70", "cutoff_85", "latest")]
    assert row.dated_rows == 1000
    assert texts == ["2017-10-01 00:00:00", "2017-10-01 00:11:40", "2017-10-01 00:14:10", "2017-10-01 00:16:39"]


def test_number_rows_with_a_hot_group(spark):
    rows = [("hot", i) for i in range(500)] + [(f"k{i % 40}", i) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, i int").repartition(6)
    got = ordering.number_rows(df, ["k"], ["i"], "n", slice_rows=60).collect()
    assert len(got) == 700
    by_key = {}
    for r in sorted(got, key=lambda r: (r.k, r.i)):
        by_key.setdefault(r.k, []).append(r.n)
    assert all(numbers == list(range(1, len(numbers) + 1)) for numbers in by_key.values())
    dense = ordering.number_rows(df.withColumn("u", F.monotonically_increasing_id()).select("k", "i"), [], ["k", "i"], "n", slice_rows=60)
    assert sorted(r.n for r in dense.collect()) == list(range(1, 701))


def test_many_blocks_of_slices_number_as_one(spark, monkeypatch):
    rows = [(f"k{i % 3}" if i % 5 else None, i) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, i int").repartition(6)
    whole = sorted(map(str, ordering.number_rows(df, ["k"], ["i"], "n").collect()))
    monkeypatch.setattr(ordering, "SLICES_PER_BLOCK", 2)
    assert sorted(map(str, ordering.number_rows(df, ["k"], ["i"], "n", slice_rows=20).collect())) == whole
    assert sorted(r.n for r in ordering.number_rows(df, [], ["i"], "n", slice_rows=20).collect()) == list(range(1, 301))


def test_first_rows_limits_groups_before_the_shuffle(spark):
    df = spark.range(10_000).select((F.col("id") % 3).alias("k"), "id")
    firsts = ordering.first_rows(df, ["k"], ["id"], 2)
    assert sorted((r.k, r.id) for r in firsts.collect()) == [(0, 0), (0, 3), (1, 1), (1, 4), (2, 2), (2, 5)]
    plan = firsts._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def interpolated(values, p):
    values = sorted(values)
    at = p * (len(values) - 1)
    low = int(at)
    return values[low] + (at - low) * (values[min(low + 1, len(values) - 1)] - values[low])


@pytest.mark.parametrize("kind, make", [
    ("bigint", lambda rng: rng.choice([rng.randint(-5, 5), rng.randint(-(2**40), 2**40), 7])),
    ("bigint", lambda rng: 2**62 + rng.randint(0, 3)),
    ("double", lambda rng: rng.choice([rng.random(), rng.gauss(0, 1e200), 0.5, 5e-324 * rng.randint(0, 3)])),
])
@pytest.mark.parametrize("buckets", [2, 256])
def test_group_quantiles(spark, kind, make, buckets):
    rng = random.Random(9)
    rows = [("hot", 1, make(rng)) for _ in range(200)] + [("", None, 3), (None, None, 4), (None, None, 5), ("null", 1, None)]
    rows += [(f"g{i}", i % 2, make(rng)) for i in range(12) for _ in range(i)]
    rows = [(a, b, None if v is None else (float(v) if kind == "double" else v)) for a, b, v in rows]
    df = spark.createDataFrame(rows, f"a string, b int, v {kind}").repartition(4)
    names = {"least": 0.0, "third": 1 / 3, "median": 0.5, "most": 1.0}
    got = {(r.a, r.b): tuple(r)[2:] for r in group_quantiles(df, ["a", "b"], "v", names, buckets).collect()}
    groups = {}
    for a, b, v in rows:
        if v is not None:
            groups.setdefault((a, b), []).append(v)
    assert set(got) == set(groups)
    for key, values in groups.items():
        want = [len(values), *[interpolated(values, p) for p in names.values()]]
        assert list(got[key]) == pytest.approx(want, rel=1e-12)


def test_small_groups_need_no_pass_over_all_rows(spark, monkeypatch):
    """Groups of one to seven rows are settled where they are gathered; only larger ones are narrowed."""
    df = spark.range(0, 400).select((F.col("id") % 100 % 61).alias("a"), ((F.col("id") * 37) % 101).alias("v"))
    names = {"p25": 0.25, "m": 0.5}
    expected = sorted(map(tuple, group_quantiles(df, ["a"], "v", names, 3).collect()))

    def refused(*_):
        raise AssertionError("a pass over all rows")

    monkeypatch.setattr(ordering, "_narrowed", refused)
    found = sorted(map(tuple, group_quantiles(df, ["a"], "v", names, 8).collect()))
    assert found == expected and len(found) == 61 and {r[1] for r in found} == {4, 8}


def test_group_quantiles_of_nothing_and_of_infinities(spark):
    df = spark.createDataFrame([], "a string, v double")
    assert group_quantiles(df, ["a"], "v", {"m": 0.5}).collect() == []
    for bad in (float("nan"), float("inf")):
        with pytest.raises(ValueError, match="not finite"):
            group_quantiles(spark.createDataFrame([("x", 1.0), ("x", bad)], "a string, v double"), ["a"], "v", {"m": 0.5})
