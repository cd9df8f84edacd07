"""One parent, thread or class holding most rows, with AQE's size limits lowered to the size of the fixture."""

import contextlib

import pytest
from pyspark.sql import functions as F

from replyloom.operators import pairs, quality, threads
from replyloom.session import default_stage_folder, tune

LOWERED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20kb",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20kb",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@contextlib.contextmanager
def lowered(spark):
    before = {k: spark.conf.get(k, None) for k in LOWERED}
    tune(spark)
    for k, v in LOWERED.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def tweets(spark):
    """20,000 replies to question 0 and 10,000 questions with one reply each, spread over several map tasks."""
    hot = spark.range(20_000, numPartitions=12).select(
        (F.col("id") + 1_000_000).alias("tweet_id"), F.lit(0).cast("bigint").alias("parent"), F.lit(False).alias("inbound")
    )
    cold = spark.range(10_000, numPartitions=12).select(
        F.explode(
            F.array(
                F.struct(F.col("id").alias("tweet_id"), F.lit(None).cast("bigint").alias("parent"), F.lit(True).alias("inbound")),
                F.struct((F.col("id") + 5_000_000).alias("tweet_id"), F.col("id").alias("parent"), F.lit(False).alias("inbound")),
            )
        ).alias("r")
    ).select("r.*")
    return hot.unionByName(cold).select(
        "tweet_id",
        F.when(F.col("inbound"), "7").otherwise("Brand").alias("author_id"),
        "inbound",
        F.lit("Tue Oct 31 22:10:47 +0000 2017").alias("created_at"),
        F.concat(F.lit("some text of the message "), F.sha2(F.col("tweet_id").cast("string"), 256)).alias("text"),
        F.lit(None).cast("string").alias("response_tweet_id"),
        F.col("parent").alias("in_response_to_tweet_id"),
    )


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pair_join_splits_the_hot_question(spark, tweets):
    with lowered(spark):
        found = pairs.support_pairs(tweets, "Brand")
        assert len(found.select("pair_id", "response_text", "customer_text").collect()) == 30_000
        joined = found.select("pair_id", "response_text", "customer_text")
        joined.collect()
        assert "skew=true" in executed(joined)


def test_hot_duplicates_and_thread(spark, tweets):
    with lowered(spark):
        found = pairs.support_pairs(tweets, "Brand")
        flagged = quality.quality_flags(found).groupBy("quality_reason").count().collect()
        assert {r.quality_reason: r["count"] for r in flagged} == {"valid": 10_000, "duplicate_customer_turn": 20_000}
        threaded = threads.thread_length(tweets.join(threads.thread_roots(tweets), "tweet_id"))
        assert threaded.filter("conversation_id = 0").agg(F.min("conversation_length"), F.count("*")).first() == (20_002, 20_002)
        cut = threads.conversation_records(threaded, turns_per_record=1000, slice_rows=3000)
        sizes = [r.n for r in cut.filter("conversation_id = 0").select(F.size("tweets").alias("n")).collect()]
        assert sorted(sizes) == [2, *[1000] * 20]


def test_stage_folders_of_one_machine_are_refused_on_a_cluster():
    assert default_stage_folder("file:/w", "local[4]") == "file:/w/replyloom-stages"
    assert default_stage_folder("hdfs://a/w", "yarn") == "hdfs://a/w/replyloom-stages"
    for warehouse in ("file:/w", "file:///w", "/w"):
        with pytest.raises(ValueError, match="checkpoint.dir"):
            default_stage_folder(warehouse, "spark://a:7077")
