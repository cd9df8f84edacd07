"""Table schemas and load-time expectations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TWEETS = T.StructType([
    T.StructField("tweet_id", T.LongType()),
    T.StructField("author_id", T.StringType()),
    T.StructField("inbound", T.BooleanType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("response_tweet_id", T.StringType()),
    T.StructField("in_response_to_tweet_id", T.LongType()),
])

THREADED_TWEETS = T.StructType(
    TWEETS.fields
    + [T.StructField("conversation_id", T.LongType()), T.StructField("conversation_length", T.LongType())]
)

TURN = T.StructType([
    T.StructField("tweet_id", T.LongType()),
    T.StructField("author_id", T.StringType()),
    T.StructField("inbound", T.BooleanType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("in_response_to_tweet_id", T.LongType()),
    T.StructField("response_tweet_id", T.StringType()),
])

CONVERSATIONS = T.StructType([
    T.StructField("conversation_id", T.LongType()),
    T.StructField("conversation_length", T.LongType()),
    T.StructField("part", T.LongType()),
    T.StructField("first_position", T.LongType()),
    T.StructField("tweets", T.ArrayType(TURN)),
])

SUPPORT_PAIRS = T.StructType([
    T.StructField("pair_id", T.LongType()),
    T.StructField("conversation_id", T.LongType()),
    T.StructField("customer_tweet_id", T.LongType()),
    T.StructField("response_tweet_id", T.LongType()),
    T.StructField("customer_author_id", T.StringType()),
    T.StructField("customer_text", T.StringType()),
    T.StructField("response_text", T.StringType()),
    T.StructField("customer_text_normalized", T.StringType()),
    T.StructField("response_text_normalized", T.StringType()),
    T.StructField("customer_timestamp", T.StringType()),
    T.StructField("response_timestamp", T.StringType()),
    T.StructField("turn_delay_seconds", T.LongType()),
    T.StructField("response_has_url", T.BooleanType()),
    T.StructField("response_requests_dm", T.BooleanType()),
    T.StructField("response_mentions_genius_bar", T.BooleanType()),
    T.StructField("response_has_troubleshooting", T.BooleanType()),
    T.StructField("conversation_length", T.LongType()),
])

TAXONOMY_ENTRY = T.StructType([
    T.StructField("description", T.StringType()),
    T.StructField("in_scope", T.StringType()),
    T.StructField("out_of_scope", T.StringType()),
    T.StructField("confusable_intents", T.ArrayType(T.StringType())),
    T.StructField("decision_boundary", T.StringType()),
])


def expectations(
    df: DataFrame,
    required: Sequence[str] = (),
    not_null: Sequence[str] = (),
    domains: dict[str, Sequence[str]] | None = None,
    row_count: int | None = None,
) -> DataFrame:
    """One row per check with the number of violations, from a single pass over ``df``."""
    present = set(df.columns)
    checks = [(f"column:{c}", F.lit(0 if c in present else 1)) for c in required]
    checks += [(f"not_null:{c}", F.count_if(F.col(c).isNull())) for c in not_null if c in present]
    for column, allowed in (domains or {}).items():
        checks.append((f"domain:{column}", F.count_if(~F.col(column).isin(list(allowed)))))
    if row_count is not None:
        checks.append(("row_count", F.abs(F.count(F.lit(1)) - row_count)))
    results = [
        F.struct(F.lit(name).alias("check_name"), count.cast("bigint").alias("violations")) for name, count in checks
    ]
    return df.agg(F.array(*results).alias("results")).select(F.inline("results"))


def require(df: DataFrame, **checks) -> DataFrame:
    """Return ``df``, or raise with the checks that failed."""
    failed = expectations(df, **checks).filter("violations > 0").collect()
    if failed:
        raise ValueError("; ".join(f"{r.check_name}: {r.violations}" for r in failed))
    return df
