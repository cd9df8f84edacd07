"""Frequent runs: bounds of the summaries on adversarial input, exact results for any number of counters."""

import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from replyloom.operators import frequent


def exact(rows, top):
    out = []
    for n, k in top.items():
        counts = Counter(" ".join(w[i : i + n]) for w in rows if w for i in range(len(w) - n + 1))
        out += [(n, t, c) for t, c in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:k]]
    return sorted(out)


def adversarial(counters):
    """Every frequent word stands between more distinct words than there are counters."""
    rng = random.Random(counters)
    rows = []
    for block in range(12):
        words = [f"once{block}x{i}" for i in range(3 * counters)] + ["hot"] * 9 + ["warm", "mild"] * 4 + [f"late{block % 3}"] * 5
        rng.shuffle(words)
        rows += [words[i : i + 7] for i in range(0, len(words), 7)]
    return [*rows, [], None]


@pytest.mark.parametrize("counters", [1, 4, 50])
def test_counters_are_never_too_high_and_never_too_low_by_more_than_the_error(counters, monkeypatch):
    monkeypatch.setattr(frequent, "WAITING", 20)
    summary = frequent.Summary(counters)
    rows = adversarial(counters)
    for row in rows:
        if row:
            summary.add(pa.array(row))
    summary.settle()
    true = Counter(w for row in rows if row for w in row)
    held = dict(zip(summary.terms.to_pylist(), summary.counts.tolist()))
    assert len(held) <= counters and summary.error > 0
    assert all(true[t] - summary.error <= held.get(t, 0) <= true[t] for t in true)
    # The error of counters lowered together is bounded by the number of items.
    assert summary.error * (counters + 1) <= sum(true.values())


@pytest.mark.parametrize("counters", [(1,), (3, 5), (40,), (40, 400), (1 << 17,)])
def test_top_runs_are_exact(spark, monkeypatch, counters):
    monkeypatch.setattr(frequent, "WAITING", 25)
    rows, top = adversarial(12), {1: 3, 2: 4, 3: 5}
    df = spark.createDataFrame([(r,) for r in rows], "w array<string>").repartition(5)
    assert sorted(tuple(r) for r in frequent.top_runs(df, "w", top, counters).collect()) == exact(rows, top)


def test_all_ties_and_fewer_terms_than_asked_for(spark):
    rows = [["b", "a"], ["d", "c"], ["a"]]
    df = spark.createDataFrame([(r,) for r in rows], "w array<string>")
    for counters in ((1,), (100,)):
        for top in ({1: 2}, {1: 99, 2: 1}):
            assert sorted(tuple(r) for r in frequent.top_runs(df, "w", top, counters).collect()) == exact(rows, top)
    assert frequent.top_runs(df.limit(0), "w", {1: 3}).collect() == []
    assert frequent.top_runs(df, "w", {1: 0}).collect() == []


def test_what_is_shuffled_is_bounded_by_the_summaries(spark):
    """20 tasks of distinct words: no more rows leave a task than it has counters, and few are counted again."""
    df = spark.range(0, 40_000, 1, 20).select(F.array(F.concat(F.lit("w"), F.col("id").cast("string")), F.lit("all")).alias("w"))
    rows = frequent.summaries(df, "w", [1, 2], 16).groupBy(F.spark_partition_id(), "n").count().collect()
    assert len(rows) == 40 and all(r["count"] <= 17 for r in rows)
    assert [tuple(r) for r in frequent.top_runs(df, "w", {1: 1}, (16,)).collect()] == [(1, "all", 40_000)]


def test_a_task_joins_the_words_of_a_bounded_slice(spark, monkeypatch):
    """A batch of long rows: no run is built over more words than a slice may hold."""
    rows = spark.range(0, 60, 1, 1).select(F.transform(F.sequence(F.lit(1), F.lit(10_000)), lambda i: F.concat(F.lit("w"), (i % 11).cast("string"))).alias("w"))
    runs, most = frequent.word_runs, 1 << 19

    def checked(words, n):
        assert len(words.flatten()) <= most
        return runs(words, n)

    monkeypatch.setattr(frequent, "word_runs", checked)
    found = frequent.top_runs(rows, "w", {1: 2, 2: 1}, (1, 20)).collect()
    assert sorted(tuple(r) for r in found) == [(1, "w0", 60 * 909), (1, "w1", 60 * 910), (2, "w0 w1", 60 * 909)]


def test_runs_stay_inside_rows():
    words = pa.array([["a", "b", "c"], [], None, ["d"], ["e", "f"]], pa.list_(pa.string()))
    assert frequent.word_runs(words, 2).to_pylist() == ["a b", "b c", "e f"]
    assert frequent.word_runs(words.slice(3), 1).to_pylist() == ["d", "e", "f"]
    assert frequent.word_runs(words, 3).to_pylist() == ["a b c"] and len(frequent.word_runs(words, 9)) == 0
