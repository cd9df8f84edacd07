"""Corpus, thread, brand and vocabulary profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from replyloom.functions.text import (
    MENTION_NAME,
    ascii_words,
    is_ascii,
    micros_since_epoch,
    modelling_text,
    parse_created_at,
)
from replyloom.operators.frequent import top_runs
from replyloom.operators.ordering import order_statistics, quantiles
from replyloom.operators.rules import matches
from replyloom.operators.threads import brand_outbound
from replyloom.session import materialize
from replyloom.vocabulary import COURTESY_DOMAIN, DOMAIN_PATTERNS, REPLY_SIGNALS


def frequency(df: DataFrame, column: str, within: Sequence[str] = (), digits: int = 2) -> DataFrame:
    """Value counts with their percent of all rows (or of the rows of the same ``within`` group).

    Totals are taken over the counts, one row per value, not over ``df``. The total of all rows is a scalar, so that
    no task holds all values.
    """
    counts = df.groupBy(*within, column).agg(F.count(F.lit(1)).alias("n"))
    if within:
        total = F.sum("n").over(Window.partitionBy(*within))
    else:
        counts = materialize(counts)
        total = F.lit(counts.agg(F.sum("n")).first()[0])
    return counts.withColumn("pct", F.round(F.col("n") * 100.0 / total, digits)).select(*within, column, "n", "pct")


def direction_counts(tweets: DataFrame, brand: str) -> DataFrame:
    """Tweets by side: the brand, customers, and everybody else."""
    side = F.when(F.col("inbound"), "customer").when(brand_outbound(brand), "brand").otherwise("other")
    return tweets.groupBy(side.alias("side")).agg(F.count(F.lit(1)).alias("tweets"))


def thread_starters(tweets: DataFrame) -> DataFrame:
    """Inbound tweets that answer nothing."""
    return tweets.filter(F.col("inbound") & F.col("in_response_to_tweet_id").isNull())


def profile_core(tweets: DataFrame) -> DataFrame:
    """Rows, repeated ids, authors on each side, and the date range.

    Distinct counts are taken over pre-aggregated keys: one aggregation per id column.
    """
    ids = tweets.groupBy("tweet_id").agg(F.count(F.lit(1)).alias("rows")).agg(
        F.struct(
            F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("total_rows"),
            F.count("tweet_id").alias("unique_ids"),
        )
    )
    at = parse_created_at(F.col("created_at"))
    authors = (
        tweets.groupBy("author_id", "inbound")
        .agg(F.count(F.lit(1)).alias("n"), F.min(at).alias("first_at"), F.max(at).alias("last_at"))
        .agg(
            F.count_if("inbound").alias("customers"),
            F.count_if(~F.col("inbound")).alias("brands"),
            F.coalesce(F.sum(F.when(F.col("inbound"), F.col("n"))), F.lit(0)).cast("bigint").alias("inbound_rows"),
            F.coalesce(F.sum(F.when(~F.col("inbound"), F.col("n"))), F.lit(0)).cast("bigint").alias("outbound_rows"),
            F.min("first_at").alias("first_at"),
            F.max("last_at").alias("last_at"),
        )
    )
    return authors.withColumn("ids", ids.scalar()).select(
        F.col("ids.total_rows").alias("total_rows"),
        F.col("ids.unique_ids").alias("unique_ids"),
        (F.col("ids.total_rows") - F.col("ids.unique_ids")).alias("duplicate_ids"),
        "customers",
        "brands",
        "inbound_rows",
        "outbound_rows",
        "first_at",
        "last_at",
    )


def column_profile(df: DataFrame) -> DataFrame:
    """Type, null count and null percent of every column, and the number of repeated whole rows.

    Nulls need no shuffle. Repeats are looked for among rows whose two 64-bit hashes occur again, so only
    those rows travel whole; they are then compared by value.
    """
    columns = df.columns
    first, second = F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns)
    hashes = df.select(first.alias("_h1"), second.alias("_h2"))
    again = hashes.groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    suspects = df.withColumns({"_h1": first, "_h2": second}).join(again, ["_h1", "_h2"], "left_semi")
    copies = suspects.groupBy(*columns).agg((F.count(F.lit(1)) - 1).alias("_copies"))
    repeated = copies.agg(F.coalesce(F.sum("_copies"), F.lit(0)).cast("bigint"))
    stats = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"_nulls{i}") for i, c in enumerate(columns)],
    ).withColumn("_repeated", repeated.scalar())
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(df.schema[c].dataType.simpleString()).alias("data_type"),
            F.col(f"_nulls{i}").alias("nulls"),
            F.round(F.try_divide(F.col(f"_nulls{i}") * 100.0, F.col("_rows")), 2).alias("null_pct"),
            F.col("_rows").alias("total_rows"),
            F.col("_repeated").alias("duplicate_rows"),
        )
        for i, c in enumerate(columns)
    ]
    return stats.select(F.inline(F.array(*rows)))


def thread_sizes(tweets: DataFrame) -> DataFrame:
    return tweets.groupBy("conversation_id").agg(F.count(F.lit(1)).alias("turns"))


def thread_length_stats(tweets: DataFrame) -> DataFrame:
    sizes = materialize(thread_sizes(tweets))
    (median,) = quantiles(sizes, "turns", [0.5])
    return sizes.agg(
        F.count(F.lit(1)).alias("conversations"),
        F.round(F.avg("turns"), 2).alias("mean_turns"),
        median.alias("median_turns"),
        F.round(F.stddev_samp("turns"), 2).alias("std_turns"),
        F.min("turns").alias("min_turns"),
        F.max("turns").alias("max_turns"),
    )


def thread_length_buckets(tweets: DataFrame) -> DataFrame:
    """Threads with 1, 2, 3, 4 and 5 or more turns; empty buckets stay."""
    buckets = {
        "1 turn (unanswered/single)": F.col("turns") == 1,
        "2 turns (single Q&A pair)": F.col("turns") == 2,
        "3 turns": F.col("turns") == 3,
        "4 turns": F.col("turns") == 4,
        "5+ turns (extended dialogue)": F.col("turns") >= 5,
    }
    counts = thread_sizes(tweets).agg(
        F.array(
            *[F.struct(F.lit(name).alias("bucket"), F.count_if(c).alias("conversations")) for name, c in buckets.items()]
        ).alias("rows")
    )
    return counts.select(F.inline("rows"))


def signal_rates(pairs: DataFrame, signals: Sequence[str] = tuple(REPLY_SIGNALS)) -> DataFrame:
    rates = [
        F.struct(
            F.lit(s).alias("signal"),
            F.count_if(s).alias("replies"),
            F.round(F.try_divide(F.count_if(s) * 100.0, F.count(F.lit(1))), 2).alias("pct"),
        )
        for s in signals
    ]
    return pairs.agg(F.array(*rates).alias("rows")).select(F.inline("rows"))


def delay_stats(pairs: DataFrame) -> DataFrame:
    """Mean and median reply delay in minutes over known delays."""
    delays = materialize(pairs.select("turn_delay_seconds"))
    (median,) = quantiles(delays, "turn_delay_seconds", [0.5])
    return delays.agg(
        F.count("turn_delay_seconds").alias("known_delays"),
        F.round(F.avg("turn_delay_seconds") / 60, 1).alias("mean_minutes"),
        F.round(median / 60, 1).alias("median_minutes"),
    )


def year_counts(df: DataFrame, at: Column) -> DataFrame:
    counts = df.groupBy(F.year(at).cast("bigint").alias("year")).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("year").isNotNull()).orderBy("year")


def month_counts(df: DataFrame, at: Column, year: int) -> DataFrame:
    inside = df.filter(F.year(at) == year)
    return inside.groupBy(F.month(at).cast("bigint").alias("month")).agg(F.count(F.lit(1)).alias("n")).orderBy("month")


def time_cutoffs(df: DataFrame, at: Column, shares: Sequence[float] = (0.70, 0.85)) -> DataFrame:
    """First, last and the values at int(share * n) of the time order, found without a global sort."""
    micros = df.select(micros_since_epoch(at).alias("us"))
    rows = micros.agg(F.count("us")).first()[0]
    if not rows:
        raise ValueError("no dated rows")
    ranks = [0, *[min(int(rows * s), rows - 1) for s in shares], rows - 1]
    names = ["earliest", *[f"cutoff_{round(s * 100)}" for s in shares], "latest"]
    values = order_statistics(micros, "us", ranks)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return df.sparkSession.range(1).select(
        F.lit(rows).cast("bigint").alias("dated_rows"),
        *[F.timestamp_add("MICROSECOND", F.lit(v), epoch).alias(n) for n, v in zip(names, values)],
    )


def text_length_stats(df: DataFrame, text: str = "customer_text_normalized") -> DataFrame:
    """Words and characters per cleaned text: mean, median, min, max."""
    cleaned = modelling_text(F.col(text))
    cleaned_rows = df.select(cleaned.alias("t"))
    cleaned = F.col("t")
    counted = cleaned_rows.select(
        F.when(cleaned == "", 0).otherwise(F.size(F.split(cleaned, " "))).cast("bigint").alias("words"),
        F.length(cleaned).cast("bigint").alias("chars"),
    )
    sizes = materialize(counted)
    (word_median,), (char_median,) = quantiles(sizes, "words", [0.5]), quantiles(sizes, "chars", [0.5])
    return sizes.agg(
        *[
            F.struct(
                F.lit(unit).alias("unit"),
                F.round(F.avg(unit), 1).alias("mean"),
                median.alias("median"),
                F.min(unit).alias("min"),
                F.max(unit).alias("max"),
            ).alias(unit)
            for unit, median in (("words", word_median), ("chars", char_median))
        ]
    ).select(F.inline(F.array("words", "chars")))


def confidence_stats(predictions: DataFrame, column: str = "confidence", digits: int = 6) -> DataFrame:
    """Mean, median, population deviation, range and quartiles of a score."""
    scores = materialize(predictions.select(column))
    p25, median, p75 = quantiles(scores, column, [0.25, 0.5, 0.75])
    stats = {
        "mean": F.avg(column), "median": median, "std": F.stddev_pop(column),
        "min": F.min(column), "max": F.max(column), "p25": p25, "p75": p75,
    }
    return scores.agg(*[F.round(value, digits).alias(name) for name, value in stats.items()])


def top_ngrams(
    df: DataFrame,
    text: str = "customer_text_normalized",
    stop_words: Sequence[str] = (),
    top: Mapping[int, int] = {1: 20, 2: 20, 3: 15},
) -> DataFrame:
    """The most frequent word runs of each length (ties: alphabetical).

    Exact, though only summaries of bounded size and the counts of their candidates are shuffled; ``top_runs`` says how.
    """
    return top_runs(df.select(ascii_words(F.col(text), stop_words).alias("words")), "words", top)


def link_brands(tweets: DataFrame) -> DataFrame:
    """Brand of every inbound tweet and how it was found: ``reply``, ``mention`` or ``unmatched``.

    A reply is the smallest brand reply pointing at the tweet; a mention is the first ``@Name`` in the
    text that is an outbound author.
    """
    inbound = tweets.filter("inbound")
    replies = (
        tweets.filter(~F.col("inbound") & F.col("in_response_to_tweet_id").isNotNull())
        .groupBy(F.col("in_response_to_tweet_id").alias("tweet_id"))
        .agg(F.min_by("author_id", "tweet_id").alias("_replier"))
    )
    brands = tweets.filter(~F.col("inbound")).select(F.col("author_id").alias("_name")).distinct()
    names = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(MENTION_NAME), 1)
    mentions = (
        inbound.select("tweet_id", F.posexplode(names).alias("_at", "_name"))
        .join(brands, "_name")
        .groupBy("tweet_id")
        .agg(F.min_by("_name", "_at").alias("_mentioned"))
    )
    found = F.when(F.col("_replier").isNotNull(), "reply").when(F.col("_mentioned").isNotNull(), "mention")
    # Both right sides are already partitioned by tweet_id, so the inbound rows move once.
    return (
        inbound.join(replies, "tweet_id", "left")
        .join(mentions, "tweet_id", "left")
        .withColumn("brand", F.coalesce("_replier", "_mentioned"))
        .withColumn("link", F.coalesce(found, F.lit("unmatched")))
        .select(*tweets.columns, "brand", "link")
    )


def brand_profile(
    tweets: DataFrame, min_total: int = 25_000, target_dm_pct: float = 35.0, top: int | None = None
) -> DataFrame:
    """Volume, reach, hand-over and text figures per brand, best-known brands first, all or the first ``top``.

    Distinct customers are counted over pre-aggregated (brand, customer) rows, so one brand with most of
    the traffic spreads over its customers.
    """
    at = parse_created_at(F.col("created_at"))
    text = F.coalesce("text", F.lit(""))
    outbound = tweets.filter(~F.col("inbound")).select("*", F.col("author_id").alias("brand"))
    both = outbound.unionByName(link_brands(tweets).drop("link")).filter(F.col("brand").isNotNull())
    per_author = both.groupBy("brand", "author_id", "inbound").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("in_response_to_tweet_id").isNull()).alias("starters"),
        F.count_if(matches(text, REPLY_SIGNALS["response_requests_dm"])).alias("dm"),
        F.count_if(matches(text, REPLY_SIGNALS["response_has_url"])).alias("url"),
        F.sum(F.length(text)).alias("chars"),
        F.count_if(is_ascii(text)).alias("ascii"),
        F.min(at).alias("first_at"),
        F.max(at).alias("last_at"),
    )

    def total(column: str, side: Column) -> Column:
        return F.coalesce(F.sum(F.when(side, F.col(column))), F.lit(0)).cast("bigint")

    inbound, sent = F.col("inbound"), ~F.col("inbound")
    out_n, in_n = total("n", sent), total("n", inbound)
    ranked = (
        per_author.groupBy("brand")
        .agg(
            F.sum("n").cast("bigint").alias("total_tweets"),
            out_n.alias("outbound_tweets"),
            in_n.alias("inbound_tweets"),
            total("starters", inbound).alias("inbound_first_turn"),
            F.count_if(inbound).alias("unique_customers"),
            F.round(total("dm", sent) * 100.0 / out_n, 2).alias("pct_outbound_dm"),
            F.round(total("url", sent) * 100.0 / out_n, 2).alias("pct_outbound_url"),
            F.round(total("chars", sent) * 1.0 / out_n, 2).alias("avg_outbound_char_len"),
            F.round(F.try_divide(total("chars", inbound) * 1.0, in_n), 2).alias("avg_inbound_char_len"),
            F.round(F.sum("ascii") * 100.0 / F.sum("n"), 2).alias("pct_ascii"),
            F.min("first_at").alias("first_at"),
            F.max("last_at").alias("last_at"),
        )
        .filter(F.col("total_tweets") >= min_total)
        .withColumn("escalation_balance_score", F.round(100 - F.abs(F.col("pct_outbound_dm") - target_dm_pct), 2))
        .orderBy(F.desc("total_tweets"), "brand")
    )
    return ranked if top is None else ranked.limit(top)


def domain_hits(df: DataFrame, text: str = "customer_text_normalized", domains: Mapping[str, str] = DOMAIN_PATTERNS) -> DataFrame:
    """Rows matching each of several overlapping patterns, most frequent first."""
    lowered = df.select(F.lower(F.coalesce(F.col(text), F.lit(""))).alias("t"))
    hits = [
        F.struct(
            F.lit(name).alias("domain"),
            F.count_if(matches(F.col("t"), pattern)).alias("hits"),
            F.round(F.try_divide(F.count_if(matches(F.col("t"), pattern)) * 100.0, F.count(F.lit(1))), 2).alias("pct"),
        )
        for name, pattern in domains.items()
    ]
    return lowered.agg(F.array(*hits).alias("rows")).select(F.inline("rows")).orderBy(F.desc("hits"), "domain")


def covered(text: str, domains: Mapping[str, str] = DOMAIN_PATTERNS) -> Column:
    """True when any technical domain matches; the courtesy pattern does not count."""
    lowered = F.lower(F.coalesce(F.col(text), F.lit("")))
    any_hit = F.lit(False)
    for name, pattern in domains.items():
        if name != COURTESY_DOMAIN:
            any_hit = any_hit | matches(lowered, pattern)
    return any_hit


def domain_coverage(df: DataFrame, text: str = "customer_text_normalized", domains: Mapping[str, str] = DOMAIN_PATTERNS) -> DataFrame:
    hit = df.select(covered(text, domains).alias("hit"))
    total = F.count(F.lit(1))
    return hit.agg(
        total.alias("total"),
        F.count_if("hit").alias("matched"),
        F.round(F.try_divide(F.count_if("hit") * 100.0, total), 2).alias("matched_pct"),
        F.count_if(~F.col("hit")).alias("unmatched"),
        F.round(F.try_divide(F.count_if(~F.col("hit")) * 100.0, total), 2).alias("unmatched_pct"),
    )


def unmatched_examples(df: DataFrame, key: str, text: str = "customer_text_normalized", n: int = 15) -> DataFrame:
    """The first ``n`` rows no technical domain matches."""
    return df.filter(~covered(text)).orderBy(key).limit(n)
