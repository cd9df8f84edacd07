"""Message tables in the raw layout, derived from a table of numbered conversation turns.

The turn table has no reply pointers, handles, signatures or dates, so they are derived from
``conv_id`` and ``turn`` by fixed expressions over every row. The derivation is narrow: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BRAND = "HelpDesk"
OTHER_BRAND = "OtherCare"
#: A message id is the conversation above 32 bits, then the turn, then a bit for the second reply.
STRIDE = 2**32
SECOND_REPLY = 1
#: Every so many conversations, the first turn answers the second one: a cycle of replies.
CYCLE_EVERY = 45
#: Of every sixty conversations, these answer the first turn of the one before: a long chain of replies.
CHAIN_OF, CHAIN_FROM, CHAIN_TO = 60, 33, 47
EPOCH = "2016-12-20 00:00:00"

COMPLAINTS = [
    "my battery drain is bad",
    "question mark box when i type i",
    "autocorrect keeps changing words",
    "charger not charging",
    "apple id password reset",
    "app store refund please",
    "bluetooth will not pair",
    "screen is cracked",
    "camera and speaker sound broken",
    "apps keep freezing and crash",
    "update to ios 11.1 failed to install",
    "when does the shop open",
    "phone turns off at 20%",
    "spinning wheel, so slow",
    "glitchy bugs everywhere",
    "the cables died, sign in blocked",
]

ANSWERS = [
    "Please restart and check Settings.",
    "Send us a DM.",
    "Visit an Apple Store for an appointment.",
    "What happens then?",
    "Restart, then DM us the iOS 11 version.",
    "See the article.",
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``conversations`` table as raw messages."""
    return from_turns(read_table(spark, sf_dir, "conversations"))


def from_turns(turns: DataFrame) -> DataFrame:
    conv, turn, role, tid = F.col("conv_id"), F.col("turn"), F.col("role"), F.col("tweet_id")
    first_id = conv * STRIDE + turn * 2
    answered_twice = (role == "assistant") & (conv % 10 == 0)
    ids = F.when(answered_twice, F.array(first_id, first_id + SECOND_REPLY)).otherwise(F.array(first_id))
    numbered = turns.withColumn("tweet_id", F.explode(ids))
    copy = (tid % 2).cast("int")

    customer = (conv + 100_000).cast("string")
    author = (
        F.when(role == "user", customer)
        .when(role == "system", "system")
        .when(conv % 5 == 4, OTHER_BRAND)
        .otherwise(BRAND)
    )
    next_id = (tid + 2).cast("string")
    children = (
        F.when((copy == 1) | ((conv + turn) % 4 == 0), F.lit(None))
        .when(conv % 10 == 0, F.concat(next_id, F.lit(", "), (tid + 2 + SECOND_REPLY).cast("string"), F.lit(",x")))
        .otherwise(next_id)
    )
    parent = (
        F.when(turn > 0, conv * STRIDE + (turn - 1) * 2)
        .when(conv % CYCLE_EVERY == 1, conv * STRIDE + 2)
        .when((conv % CHAIN_OF).between(CHAIN_FROM, CHAIN_TO), (conv - 1) * STRIDE)
    )
    return numbered.select(
        "tweet_id",
        author.alias("author_id"),
        (role == "user").alias("inbound"),
        _created_at(conv, turn, copy, tid, role).alias("created_at"),
        _text(conv, turn, copy, tid, role, customer).alias("text"),
        children.alias("response_tweet_id"),
        parent.alias("in_response_to_tweet_id"),
    )


def _created_at(conv: Column, turn: Column, copy: Column, tid: Column, role: Column) -> Column:
    early = F.when((role == "assistant") & (tid % 29 == 0), 9000).otherwise(0)
    seconds = (conv % 20_000) * 25_980 + turn * 3600 + (conv * 31 + turn * 17) % 3000 + copy * 120 - early
    at = F.timestamp_add("SECOND", seconds, F.lit(EPOCH).cast("timestamp_ntz"))
    # Only the date goes through a formatter: formatting a clock time depends on the session's zone.
    day, clock = F.date_format(at.cast("date"), "EEE MMM dd"), F.substring(at.cast("string"), 12, 8)
    written = F.concat_ws(" ", day, clock, F.lit("+0000"), F.year(at).cast("string"))
    return F.when(tid % 97 == 0, "not a date").otherwise(written)


def _text(conv: Column, turn: Column, copy: Column, tid: Column, role: Column, customer: Column) -> Column:
    handle = F.concat(F.lit("@"), customer)
    complaint = F.get(F.array(*[F.lit(c) for c in COMPLAINTS]), ((conv * 7 + turn) % len(COMPLAINTS)).cast("int"))
    answer = F.get(F.array(*[F.lit(a) for a in ANSWERS]), ((conv + turn) % len(ANSWERS)).cast("int"))
    asked = (
        F.when(tid % 53 == 0, F.lit(None))
        .when(tid % 17 == 0, F.concat(handle, F.lit(" https://t.co/u"), conv.cast("string")))
        .when(tid % 19 == 0, "@1 ok")
        .when(tid % 23 == 0, F.concat(handle, F.lit(" thanks")))
        .otherwise(
            F.concat(
                handle,
                F.lit(" "),
                F.when(tid % 7 == 0, f"@{BRAND} ").otherwise(""),
                F.col("text"),
                F.lit(" "),
                complaint,
            )
        )
    )
    replied = F.when(tid % 59 == 0, "").otherwise(
        F.concat(
            F.when(copy == 1, "Following up. ").otherwise(""),
            handle,
            F.lit(" "),
            F.col("text"),
            F.lit(" "),
            answer,
            F.when(conv % 2 == 0, " https://t.co/x1").otherwise(""),
            F.when(turn % 3 == 0, " ^AB").when(turn % 5 == 0, " /LS").otherwise(""),
        )
    )
    return F.when(role == "user", asked).when(role == "assistant", replied).otherwise(F.col("text"))
