"""Seeded samples and conversation-level splits by hash order."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from replyloom.session import materialize

TRAIN, VALIDATION, TEST = "train", "validation", "test"
PREFIX_DIGITS = 4


def shuffle_key(column: str, seed: int) -> Column:
    """A reproducible random order that does not depend on partitioning."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(column).cast("string")))


def seeded_sample(df: DataFrame, key: str, n: int = 250, seed: int = 42) -> DataFrame:
    """Exactly min(n, rows) rows; every task keeps at most ``n`` before the final merge."""
    return df.orderBy(shuffle_key(key, seed), key).limit(n)


def error_sample(df: DataFrame, text: str, true: str, predicted: str, key: str, n: int = 20, seed: int = 42) -> DataFrame:
    """Up to ``n`` mis-predicted rows as (query, true_intent, predicted_intent)."""
    errors = df.filter(F.col(true) != F.col(predicted))
    return seeded_sample(errors, key, n, seed).select(
        key,
        F.col(text).alias("query"),
        F.col(true).alias("true_intent"),
        F.col(predicted).alias("predicted_intent"),
    )


@dataclass(frozen=True)
class ConversationSplit:
    """Two cut points in hash order. Assigning a row is a column expression and needs no shuffle."""

    seed: int
    key: str
    train_until: str | None
    validation_until: str | None

    def column(self, golden: Column) -> Column:
        """Split name for rows of this table; ``golden`` marks protected conversations."""
        position = _position(self.key, self.seed)

        def before(cut: str | None) -> Column:
            return F.lit(False) if cut is None else position <= cut

        return (
            F.when(golden, TEST)
            .when(before(self.train_until), TRAIN)
            .when(before(self.validation_until), VALIDATION)
            .otherwise(TEST)
        )


def _position(key: str, seed: int) -> Column:
    # The whole key after the hash breaks ties, so the order is total.
    return F.concat(shuffle_key(key, seed), F.col(key).cast("string"))


def mark_golden(df: DataFrame, golden: DataFrame, key: str = "conversation_id") -> DataFrame:
    """Add ``_golden``; Spark broadcasts the golden ids only when their measured size allows it."""
    ids = golden.select(key).distinct().withColumn("_golden", F.lit(True))
    return df.join(ids, key, "left").withColumn("_golden", F.coalesce("_golden", F.lit(False)))


def fit_conversation_split(
    clean: DataFrame,
    golden: DataFrame,
    train_share: float = 0.70,
    validation_share: float = 0.15,
    seed: int = 42,
    key: str = "conversation_id",
) -> ConversationSplit:
    """Find the cuts so that the split sizes are exact.

    Sizes are shares of all conversations, golden ones included, rounded half-even; train and
    validation are drawn from the rest. Conversations are counted per hash prefix, ``PREFIX_DIGITS`` digits at a
    time, until the prefix that holds a cut holds one conversation: at most 65,536 counts reach the
    driver in each pass, and no conversations are sorted.
    """
    found = mark_golden(clean.select(key).distinct(), golden, key)
    conversations = materialize(found.select("_golden", _position(key, seed).alias("p")))
    total = conversations.count()
    n_train, n_validation = round(train_share * total), round(validation_share * total)
    free = conversations.filter(~F.col("_golden")).select("p")

    def cut(rank: int) -> str | None:
        """Position of the ``rank``-th free conversation, counted from one."""
        if rank <= 0:
            return None
        prefix, inside = "", free
        while True:
            digits = len(prefix) + PREFIX_DIGITS
            counts = inside.groupBy(F.substring("p", 1, digits).alias("prefix")).agg(
                F.count(F.lit(1)).alias("n"), F.min("p").alias("least"), F.max("p").alias("most")
            )
            for row in sorted(counts.collect(), key=lambda r: r.prefix):
                if rank <= row.n:
                    break
                rank -= row.n
            else:
                return "g"  # after every hexadecimal digit: all free conversations lie before the cut
            if row.n == rank or rank == 1:
                return row.most if row.n == rank else row.least
            prefix, inside = row.prefix, inside.filter(F.col("p").startswith(row.prefix))

    return ConversationSplit(seed, key, cut(n_train), cut(n_train + n_validation))


def assign_split(df: DataFrame, golden: DataFrame, split: ConversationSplit) -> DataFrame:
    """Add ``split`` to every row of a table that has the conversation key."""
    return mark_golden(df, golden, split.key).withColumn("split", split.column(F.col("_golden"))).select(
        *df.columns, "split"
    )


def split_tweet_counts(pairs: DataFrame, tweets: DataFrame, key: str = "conversation_id") -> DataFrame:
    """Tweets represented in each split, counting every conversation once."""
    conversations = pairs.select(key, "split").distinct()
    sizes = tweets.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return (
        conversations.join(sizes, key, "left")
        .groupBy("split")
        .agg(F.sum(F.coalesce("n", F.lit(0))).cast("bigint").alias("tweets"))
    )


def split_summary(pairs: DataFrame, tweets: DataFrame, key: str = "conversation_id") -> DataFrame:
    """Conversations, pairs, tweets and their percentages per split."""
    per_conversation = pairs.groupBy(key, "split").agg(F.count(F.lit(1)).alias("pairs"))
    sizes = tweets.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    per_split = (
        per_conversation.join(sizes, key, "left")
        .groupBy("split")
        .agg(
            F.count(F.lit(1)).alias("conversations"),
            F.sum("pairs").cast("bigint").alias("pairs"),
            F.sum(F.coalesce("n", F.lit(0))).cast("bigint").alias("tweets"),
        )
    )
    # There are three splits at most.
    share = lambda c: F.round(F.col(c) * 100.0 / F.sum(c).over(Window.partitionBy()), 2)
    return per_split.withColumns({"conversations_pct": share("conversations"), "pairs_pct": share("pairs")})


def retrieval_corpus(assigned: DataFrame) -> DataFrame:
    """Training rows only, so nothing held out can be looked up."""
    return assigned.filter(F.col("split") == TRAIN).drop("split")


def leakage(named: dict[str, DataFrame], key: str = "conversation_id") -> DataFrame:
    """Shared conversations of every two named tables, from one aggregation over all of them."""
    names = list(named)
    tagged = None
    for i, name in enumerate(names):
        part = named[name].select(key, F.lit(1 << i).alias("bit"))
        tagged = part if tagged is None else tagged.unionByName(part)
    masks = tagged.groupBy(key).agg(F.bit_or("bit").alias("mask"))
    pairs = [(i, j) for i in range(len(names)) for j in range(i + 1, len(names))]
    shared = masks.agg(
        *[
            F.count_if(F.col("mask").bitwiseAND((1 << i) | (1 << j)) == ((1 << i) | (1 << j))).alias(f"s{i}_{j}")
            for i, j in pairs
        ]
    )
    rows = [
        F.struct(F.lit(names[i]).alias("left_set"), F.lit(names[j]).alias("right_set"), F.col(f"s{i}_{j}").alias("shared"))
        for i, j in pairs
    ]
    return shared.select(F.inline(F.array(*rows)))


def missing_keys(left: DataFrame, right: DataFrame, key: str = "conversation_id") -> DataFrame:
    """Distinct keys of ``left`` that ``right`` does not have."""
    return left.select(key).distinct().join(right.select(key), key, "left_anti")
