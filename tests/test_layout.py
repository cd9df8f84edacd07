"""Stored layouts: the same rows, and plans without an exchange."""

import pytest
from pyspark.sql import functions as F

from replyloom.operators import pairs, splits, threads
from replyloom.sources import layout
from replyloom.sources.messages import BRAND, messages

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tweets(spark):
    return messages(spark, SF)


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_pairs_join_bucket_by_bucket(spark, tweets, no_broadcast):
    stored = pairs.joined_pairs(*layout.stored_pair_sides(tweets, BRAND))
    assert "Exchange" not in plan(stored) and "SortMergeJoin" in plan(stored)
    assert sorted(stored.collect()) == sorted(pairs.support_pairs(tweets, BRAND).collect())
    assert "Exchange" in plan(pairs.support_pairs(tweets, BRAND))


def test_lengths_and_splits_need_no_exchange(spark, tweets, no_broadcast):
    found = threads.extract_brand(tweets, BRAND).select("tweet_id", "conversation_id")
    kept = layout.stored_threads(found)
    assert "Exchange" not in plan(threads.thread_length(kept))
    assert sorted(threads.thread_length(kept).collect()) == sorted(threads.thread_length(found).collect())
    assigned = found.select("conversation_id", F.when(F.col("conversation_id") % 3 == 0, "test").otherwise("train").alias("split"))
    counts = splits.split_tweet_counts(layout.stored_threads(assigned), kept)
    # Only the finished counts, one row per split and task, are exchanged.
    assert plan(counts).split("== Initial Plan ==")[0].count("Exchange") == 1
    assert sorted(counts.collect()) == sorted(splits.split_tweet_counts(assigned, found).collect())


def test_one_file_a_bucket_and_empty_tables(spark, tweets):
    kept = layout.stored(tweets.select("tweet_id", "text"), ["tweet_id"], 5)
    assert len(kept.inputFiles()) <= 5 and kept.count() == tweets.count()
    assert layout.stored(tweets.limit(0), ["tweet_id"]).count() == 0
