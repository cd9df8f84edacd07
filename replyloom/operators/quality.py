"""Quality cascade over support pairs, and the audits around it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from replyloom.functions.text import (
    SIGNATURE_CARET,
    SIGNATURE_SLASH,
    strip,
    substantive,
)
from replyloom.operators.ordering import first_rows
from replyloom.operators.rules import matches

MIN_QUESTION = 3
MIN_REPLY = 5


def later_copies(df: DataFrame, value: str, key: str) -> DataFrame:
    """The ``key`` of every row whose ``value`` a row with a smaller key has too; nulls are equal.

    Rows are grouped by two 64-bit hashes and the length of the value. Only values whose hashes repeat travel, and
    are then compared as they are. ``key`` is unique.
    """
    size = F.coalesce(F.length(value), F.lit(-1))
    hashed = df.select(
        key, value, F.xxhash64(value).alias("_h1"), F.xxhash64(F.lit(1), value).alias("_h2"), size.alias("_size")
    )
    hashes = ["_h1", "_h2", "_size"]
    again = hashed.groupBy(*hashes).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    same = Window.partitionBy(*hashes, value).orderBy(key)
    return (
        hashed.join(again, hashes, "left_semi")
        .withColumn("_rank", F.row_number().over(same))
        .filter("_rank > 1")
        .select(key)
    )


def mark_duplicates(
    df: DataFrame, keys: Sequence[str], order: str, output: str = "is_duplicate", keep_first: bool = True
) -> DataFrame:
    """True for the rows of a repeated key, except the one with the smallest ``order`` when ``keep_first``.

    Only repeated keys are kept from the pre-aggregated first ids, so the join has a small right side.
    """
    firsts = (
        df.groupBy(*keys)
        .agg(F.min(order).alias("_first"), F.count(F.lit(1)).alias("_copies"))
        .filter("_copies > 1")
        .drop("_copies")
    )
    repeated = F.col(order) > F.col("_first") if keep_first else F.col("_first").isNotNull()
    marked = df.join(firsts, list(keys), "left").withColumn(output, F.coalesce(repeated, F.lit(False)))
    return marked.select(*df.columns, output)


def quality_flags(pairs: DataFrame) -> DataFrame:
    """Add ``quality_status`` and ``quality_reason``; the first failing check names the reason.

    Duplicates are marked before any other check, so a later reply stays a duplicate even when the
    first one is itself unusable. An unknown delay passes.
    """
    marked = mark_duplicates(pairs, ["customer_tweet_id"], "pair_id", "_duplicate").withColumns({
        "_question": F.length(substantive(F.col("customer_text"))),
        "_question_raw": F.length(strip(F.coalesce("customer_text", F.lit("")))),
        "_reply_raw": F.length(strip(F.coalesce("response_text", F.lit("")))),
    })
    reason = (
        F.when(F.col("_question_raw") == 0, "empty_customer_text")
        .when(F.col("_question") == 0, "url_or_mention_only_customer")
        .when(F.col("_question") < MIN_QUESTION, "ultra_short_customer_message")
        .when(F.col("_reply_raw") == 0, "empty_response_text")
        .when(F.col("turn_delay_seconds") < 0, "impossible_chronology")
        .when(F.col("_duplicate"), "duplicate_customer_turn")
        .otherwise("valid")
    )
    status = F.when(F.col("quality_reason") == "valid", "clean").otherwise("flagged")
    return (
        marked.withColumn("quality_reason", reason)
        .withColumn("quality_status", status)
        .select(*pairs.columns, "quality_status", "quality_reason")
    )


def keep_clean(flagged: DataFrame) -> DataFrame:
    return flagged.filter(F.col("quality_status") == "clean")


def pair_audit(pairs: DataFrame) -> DataFrame:
    """One row of counts over the source pairs: references, chronology, repeats, unusable texts."""
    question, reply = F.length(substantive(F.col("customer_text"))), F.length(substantive(F.col("response_text")))
    broken = F.col("customer_tweet_id").isNull() | F.col("response_tweet_id").isNull()
    # Repeats = rows minus distinct keys, summed over the pre-aggregated keys.
    by_pair = pairs.groupBy("customer_tweet_id", "response_tweet_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(broken).alias("broken"),
        F.count_if(F.col("turn_delay_seconds") < 0).alias("negative"),
        F.count_if(question == 0).alias("q_empty"),
        F.count_if((question > 0) & (question < MIN_QUESTION)).alias("q_short"),
        F.count_if(reply == 0).alias("r_empty"),
        F.count_if((reply > 0) & (reply < MIN_REPLY)).alias("r_short"),
    )
    sums = ["rows", "broken", "negative", "q_empty", "q_short", "r_empty", "r_short"]
    by_question = by_pair.groupBy("customer_tweet_id").agg(
        *[F.sum(c).alias(c) for c in sums], F.count(F.lit(1)).alias("pairs")
    )

    def total(column, name):
        return F.coalesce(F.sum(column), F.lit(0)).cast("bigint").alias(name)

    return by_question.agg(
        total("rows", "total_pairs"),
        total("broken", "broken_references"),
        total("negative", "negative_delays"),
        total(F.col("rows") - F.col("pairs"), "duplicate_pairs"),
        total(F.col("rows") - 1, "repeated_customer_turns"),
        total(F.when(F.col("rows") > 1, F.col("rows")).otherwise(0), "rows_of_repeated_turns"),
        total("q_empty", "empty_customer"),
        total("q_short", "ultra_short_customer"),
        total("r_empty", "empty_response"),
        total("r_short", "ultra_short_response"),
    )


def signature_rate(pairs: DataFrame) -> DataFrame:
    """Replies with a ``^XX`` or ``/XX`` agent signature, count and percent."""
    counts = pairs.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(matches(F.col("response_text"), SIGNATURE_CARET, ignore_case=False)).alias("caret"),
        F.count_if(matches(F.col("response_text"), SIGNATURE_SLASH, ignore_case=False)).alias("slash"),
    )
    return counts.select(
        F.inline(
            F.array(
                F.struct(F.lit("caret").alias("signature"), F.col("caret").alias("replies"), _pct("caret")),
                F.struct(F.lit("slash").alias("signature"), F.col("slash").alias("replies"), _pct("slash")),
            )
        )
    )


def _pct(column: str):
    return F.round(F.try_divide(F.col(column) * 100.0, F.col("total")), 2).alias("pct")


def category_examples(pairs: DataFrame, question_words: Sequence[str] = ("battery", "apple id|password|account")) -> DataFrame:
    """First pair (smallest id) of each of five response categories.

    ``question_words`` are the case-insensitive patterns the question must hold in the first two categories.
    """
    help_words, account_words = question_words
    dm, helps, url = F.col("response_requests_dm"), F.col("response_has_troubleshooting"), F.col("response_has_url")
    conditions = {
        "Pure Troubleshooting": ~dm & helps & matches(F.col("customer_text"), help_words),
        "Immediate Escalation": dm & ~helps & matches(F.col("customer_text"), account_words),
        "Troubleshooting + Escalation": dm & helps,
        "Documentation / Help Article URL": url & ~dm & ~helps,
        "General Inquiry / Clarification": ~url & ~dm & F.coalesce(F.col("response_text"), F.lit("")).contains("?"),
    }
    hits = F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in conditions.items()]))
    tagged = pairs.select(
        F.explode(hits).alias("category"),
        "pair_id",
        "customer_tweet_id",
        "customer_text",
        "response_tweet_id",
        "response_text",
    )
    return first_rows(tagged, ["category"], ["pair_id"])
