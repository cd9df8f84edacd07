"""Tables laid out for the joins that are made again and again.

A table that is bucketed by its join key is shuffled once, when it is written. Joins, counts and distinct values by that key then read bucket
against bucket without an exchange. Rows of one key share a bucket, so this is for keys with few rows each: tweets by id, replies by the
tweet they answer, turns by conversation. A key with a large share of all rows belongs in a plain table, where a join can split it.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame

from replyloom.operators.pairs import brand_replies, inbound_questions
from replyloom.session import new_stage


def stored(df: DataFrame, keys: Sequence[str], buckets: int | None = None) -> DataFrame:
    """``df`` as a table bucketed and sorted by ``keys``, one file a bucket, below the stage folder; ``drop_stages`` removes its files.

    Tables that are to be joined must have the same number of buckets, by default the session's number of shuffle partitions.
    """
    spark = df.sparkSession
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"stored_{uuid.uuid4().hex}"
    dealt = df.repartition(count, *keys).sortWithinPartitions(*keys)
    dealt.write.bucketBy(count, *keys).sortBy(*keys).option("path", new_stage(spark)).saveAsTable(name)
    return spark.table(name)


def stored_pair_sides(tweets: DataFrame, brand: str, buckets: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Replies of the brand and questions, both bucketed by the question's id, for ``joined_pairs``."""
    key = ["customer_tweet_id"]
    return stored(brand_replies(tweets, brand), key, buckets), stored(inbound_questions(tweets), key, buckets)


def stored_threads(tweets: DataFrame, buckets: int | None = None) -> DataFrame:
    """Tweets (or pairs) with their conversation, bucketed by it, for lengths and split counts."""
    return stored(tweets, ["conversation_id"], buckets)
