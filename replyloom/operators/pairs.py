"""Question/reply pairs and their integrity checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyloom.functions.text import mask_links, normalize_question, normalize_reply, parse_created_at, seconds_between
from replyloom.operators.ordering import number_rows
from replyloom.session import materialize
from replyloom.operators.rules import signal_flags
from replyloom.operators.threads import brand_outbound


def brand_replies(tweets: DataFrame, brand: str) -> DataFrame:
    """The reply side of the pairs: what the brand answered, and to which tweet; thread columns are carried along."""
    thread = [c for c in ("conversation_id", "conversation_length") if c in tweets.columns]
    return tweets.filter(brand_outbound(brand) & F.col("in_response_to_tweet_id").isNotNull()).select(
        F.col("tweet_id").alias("response_tweet_id"),
        F.col("in_response_to_tweet_id").alias("customer_tweet_id"),
        F.col("text").alias("response_text"),
        F.col("created_at").alias("response_timestamp"),
        *thread,
    )


def inbound_questions(tweets: DataFrame) -> DataFrame:
    """The question side of the pairs."""
    return tweets.filter("inbound").select(
        F.col("tweet_id").alias("customer_tweet_id"),
        F.col("author_id").alias("customer_author_id"),
        F.col("text").alias("customer_text"),
        F.col("created_at").alias("customer_timestamp"),
    )


def support_pairs(tweets: DataFrame, brand: str) -> DataFrame:
    """Every brand reply joined to the inbound message it answers.

    The reply id serves as ``pair_id``; ``number_pairs`` gives dense numbers when a file needs them.
    Thread columns are carried along when ``tweets`` has them.
    """
    return joined_pairs(brand_replies(tweets, brand), inbound_questions(tweets))


def joined_pairs(replies: DataFrame, questions: DataFrame) -> DataFrame:
    """Pairs of ``brand_replies`` and ``inbound_questions``, which may be stored by the question's id."""
    thread = [c for c in ("conversation_id", "conversation_length") if c in replies.columns]
    delay = seconds_between(parse_created_at(F.col("response_timestamp")), parse_created_at(F.col("customer_timestamp")))
    joined = replies.join(questions, "customer_tweet_id").withColumns({
        "pair_id": F.col("response_tweet_id"),
        "customer_text_normalized": normalize_question(F.col("customer_text")),
        "response_text_normalized": normalize_question(F.col("response_text")),
        "turn_delay_seconds": delay,
    })
    flagged = signal_flags(joined)
    return flagged.select(
        "pair_id",
        *thread[:1],
        "customer_tweet_id",
        "response_tweet_id",
        "customer_author_id",
        "customer_text",
        "response_text",
        "customer_text_normalized",
        "response_text_normalized",
        "customer_timestamp",
        "response_timestamp",
        "turn_delay_seconds",
        "response_has_url",
        "response_requests_dm",
        "response_mentions_genius_bar",
        "response_has_troubleshooting",
        *thread[1:],
    )


def number_pairs(pairs: DataFrame, slice_rows: int = 1_000_000) -> DataFrame:
    """Replace ``pair_id`` by 1..n in reply-id order.

    The pairs are computed once; only their reply ids, which are unique, are put in order.
    """
    written = materialize(pairs)
    numbers = number_rows(written.select("response_tweet_id"), [], ["response_tweet_id"], "pair_id", slice_rows)
    return written.drop("pair_id").join(numbers, "response_tweet_id").select(*pairs.columns)


def normalize_pairs(pairs: DataFrame) -> DataFrame:
    """Cleaned copies of both texts beside the untouched originals."""
    return pairs.withColumns({
        "customer_text_normalized": normalize_question(F.col("customer_text")),
        "response_text_normalized": normalize_reply(F.col("response_text")),
    }).withColumns({
        "customer_text_url_norm": mask_links(F.col("customer_text_normalized")),
        "response_text_url_norm": mask_links(F.col("response_text_normalized")),
    })


def text_preserved(raw: DataFrame, clean: DataFrame, key: str = "pair_id") -> DataFrame:
    """How many clean rows exist in raw, and how many of them changed an original text."""
    left = clean.select(key, F.col("customer_text").alias("c1"), F.col("response_text").alias("r1"))
    right = raw.select(key, F.col("customer_text").alias("c0"), F.col("response_text").alias("r0"))
    same = F.col("c1").eqNullSafe(F.col("c0")) & F.col("r1").eqNullSafe(F.col("r0"))
    return left.join(right, key).agg(
        F.count(F.lit(1)).alias("compared"), F.count_if(~same).alias("changed")
    )


def pair_references(pairs: DataFrame, tweets: DataFrame, brand: str) -> DataFrame:
    """Per side: ids without a tweet, tweets with the wrong direction, tweets of the wrong author."""
    sides = pairs.select(
        F.inline(
            F.array(
                F.struct(F.lit("customer").alias("side"), F.col("customer_tweet_id").alias("tweet_id")),
                F.struct(F.lit("response").alias("side"), F.col("response_tweet_id").alias("tweet_id")),
            )
        )
    )
    known = tweets.select("tweet_id", "author_id", "inbound", F.lit(True).alias("_known"))
    is_reply = F.col("side") == "response"
    return (
        sides.join(known, "tweet_id", "left")
        .groupBy("side")
        .agg(
            F.count(F.lit(1)).alias("references"),
            F.count_if(F.col("_known").isNull()).alias("missing"),
            F.count_if(F.col("inbound") == is_reply).alias("wrong_direction"),
            F.count_if(is_reply & (F.col("author_id") != brand)).alias("wrong_author"),
        )
    )
