"""Rules held as data, compiled to column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replyloom.functions.dialect import unicode_regex
from replyloom.vocabulary import (
    FALLBACK,
    INTENT_PATTERNS,
    INTENT_RULES,
    NO_RULE,
    REPLY_SIGNALS,
    RESPONSE_TYPES,
    Rule,
)

LOWERED = "_lowered"


def matches(text: Column, pattern: str, ignore_case: bool = True) -> Column:
    return F.coalesce(text, F.lit("")).rlike(unicode_regex(pattern, ignore_case))


def signal_flags(df: DataFrame, text: str = "response_text", signals: Mapping[str, str] = REPLY_SIGNALS) -> DataFrame:
    """One boolean column per named pattern."""
    return df.withColumns({name: matches(F.col(text), pattern) for name, pattern in signals.items()})


def response_type(labels: Sequence[str] = RESPONSE_TYPES) -> Column:
    """Exclusive five-way label from the four reply signals."""
    both, trouble, handover, article, other = labels
    helps = F.col("response_has_troubleshooting")
    hands_over = F.col("response_requests_dm") | F.col("response_mentions_genius_bar")
    return (
        F.when(helps & hands_over, both)
        .when(helps, trouble)
        .when(hands_over, handover)
        .when(F.col("response_has_url"), article)
        .otherwise(other)
    )


def label_intent(
    df: DataFrame,
    text: str = "customer_text_normalized",
    patterns: Mapping[str, str] = INTENT_PATTERNS,
    fallback: str = FALLBACK,
    output: str = "intent",
) -> DataFrame:
    """First pattern that matches the lower-cased text names the label."""
    lowered = F.lower(F.coalesce(F.col(text), F.lit("")))
    hits = [F.when(F.col(LOWERED).rlike(unicode_regex(p)), label) for label, p in patterns.items()]
    return df.withColumn(LOWERED, lowered).withColumn(output, F.coalesce(*hits, F.lit(fallback))).drop(LOWERED)


def rule_predict(
    df: DataFrame,
    text: str = "customer_text",
    rules: Sequence[Rule] = INTENT_RULES,
    no_rule: Rule = NO_RULE,
) -> DataFrame:
    """Add ``predicted_intent``, ``confidence`` and ``matched_rule`` of the first rule that matches."""

    def outcome(rule: Rule) -> Column:
        return F.struct(
            F.lit(rule.label).alias("predicted_intent"),
            F.lit(float(rule.confidence)).alias("confidence"),
            F.lit(rule.name).alias("matched_rule"),
        )

    lowered = F.lower(F.coalesce(F.col(text), F.lit("")))
    hits = [F.when(F.col(LOWERED).rlike(unicode_regex(rule.pattern)), outcome(rule)) for rule in rules]
    return (
        df.withColumn(LOWERED, lowered)
        .withColumn("_hit", F.coalesce(*hits, outcome(no_rule)))
        .select(*df.columns, "_hit.*")
    )


def majority_label(train: DataFrame, label: str = "intent") -> DataFrame:
    """The most frequent label (ties: alphabetical) as a one-row table."""
    counts = train.groupBy(label).count()
    return counts.orderBy(F.desc("count"), label).limit(1).select(F.col(label).alias("majority_label"))


def majority_predict(df: DataFrame, train: DataFrame | None = None, label: str = "intent", constant: str = FALLBACK) -> DataFrame:
    """Predict one label for every row: the mode of ``train`` when given, else ``constant``."""
    guess = F.lit(constant) if train is None else majority_label(train, label).scalar()
    return df.withColumn("predicted_intent", guess)
