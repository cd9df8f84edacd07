"""File-to-file jobs: each stage reads the tables of the one before and writes its own.

Layout below the output folder: ``tweets``, ``conversations`` (JSON lines), ``support_pairs``,
``manual_sample``, ``support_pairs_clean``, ``splits`` and ``intents`` (one partition per split),
``retrieval_train``, and JSON or CSV documents under ``reports``.
"""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from replyloom import schemas
from replyloom import vocabulary as V
from replyloom.functions.text import parse_created_at
from replyloom.operators import classifiers, metrics, pairs, profile, quality, rules, splits, threads, topics
from replyloom.schemas import require
from replyloom.session import drop_stages, materialize, stages
from replyloom.sources.files import (
    read_taxonomy,
    taxonomy_rows,
    write_confusion,
    write_document,
    write_records,
    write_table,
    write_taxonomy,
)

EMPTY_MAP = "map<string,bigint>"
REPLIES = ["customer_text", "response_text"]


def _map(counts: DataFrame, key: str, value: str = "n"):
    """A small count table as a map column."""
    entries = F.collect_list(F.struct(F.col(key).cast("string"), F.col(value)))
    return counts.agg(F.map_from_entries(entries).cast(EMPTY_MAP)).scalar()


def _record(df: DataFrame):
    """A one-row table as a struct column."""
    return df.select(F.struct("*")).scalar()


def _document(spark: SparkSession, **parts) -> DataFrame:
    return spark.range(1).select(*[value.alias(name) for name, value in parts.items()])


CLEAN_PAIRS = [
    *schemas.SUPPORT_PAIRS,
    T.StructField("customer_text_url_norm", T.StringType()),
    T.StructField("response_text_url_norm", T.StringType()),
    T.StructField("quality_status", T.StringType()),
    T.StructField("quality_reason", T.StringType()),
    T.StructField("response_type", T.StringType()),
]
SPLIT = T.StructField("split", T.StringType())
#: Columns and types of every table that a job reads.
TABLES = {
    "tweets": list(schemas.THREADED_TWEETS),
    "support_pairs": list(schemas.SUPPORT_PAIRS),
    "manual_sample": list(schemas.SUPPORT_PAIRS),
    "support_pairs_clean": CLEAN_PAIRS,
    "splits": [*CLEAN_PAIRS, SPLIT],
    "intents": [*CLEAN_PAIRS, SPLIT, T.StructField("intent", T.StringType())],
}


def _read(spark: SparkSession, out: str, name: str) -> DataFrame:
    """A table of an earlier job. A column that is missing or has another type stops the job."""
    found = spark.read.parquet(f"{out}/{name}")
    types = {f.name: f.dataType for f in found.schema}
    wrong = [f.name for f in TABLES[name] if types.get(f.name) != f.dataType]
    if wrong:
        raise ValueError(f"table {name} has no column, or one of another type, for: {', '.join(wrong)}")
    return found


def stage_tables_dropped(job):
    """Run a job and remove the stage tables it wrote; its results are in the output folder."""

    @functools.wraps(job)
    def run(*args, **options):
        spark = args[0] if isinstance(args[0], SparkSession) else args[0].sparkSession
        mark = stages()
        try:
            return job(*args, **options)
        finally:
            drop_stages(spark, mark)

    return run


@stage_tables_dropped
def extract(
    tweets: DataFrame, out: str, brand: str, hops: int = 3, sample_size: int = 250, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """One brand's threads, nested conversations, question/reply pairs and manual sample."""
    threaded = write_table(threads.extract_brand(tweets, brand, hops), f"{out}/tweets")
    write_records(threads.conversation_records(threaded), f"{out}/conversations")
    found = write_table(pairs.number_pairs(pairs.support_pairs(threaded, brand)), f"{out}/support_pairs")
    write_table(splits.seeded_sample(found, "pair_id", sample_size, seed), f"{out}/manual_sample")
    return threaded, found


@stage_tables_dropped
def clean_and_split(
    spark: SparkSession, out: str, train_share: float = 0.70, validation_share: float = 0.15, seed: int = 42, month_year: int = 2017
) -> DataFrame:
    """Normalised, flagged, typed and split pairs, the retrieval corpus and the statistics document."""
    raw, tweets, golden = (_read(spark, out, n) for n in ("support_pairs", "tweets", "manual_sample"))
    flagged = materialize(quality.quality_flags(pairs.normalize_pairs(raw)))
    typed = quality.keep_clean(flagged).withColumn("response_type", rules.response_type())
    clean = write_table(typed, f"{out}/support_pairs_clean")
    fitted = splits.fit_conversation_split(clean, golden, train_share, validation_share, seed)
    assigned = write_table(splits.assign_split(clean, golden, fitted), f"{out}/splits", partition_by=["split"])
    retrieval = write_table(splits.retrieval_corpus(assigned), f"{out}/retrieval_train")

    replied_at = parse_created_at(F.col("response_timestamp"))
    summary = splits.split_summary(assigned, tweets)
    conversations = clean.select("conversation_id").distinct()
    protected = conversations.join(golden.select("conversation_id"), "conversation_id", "left_semi")
    count = F.count(F.lit(1))
    stats = _document(
        spark,
        total_raw_pairs=raw.agg(count).scalar(),
        clean_pairs_count=clean.agg(count).scalar(),
        flagged_pairs_count=flagged.agg(F.count_if(F.col("quality_status") == "flagged")).scalar(),
        flag_breakdown=_map(profile.frequency(flagged, "quality_reason"), "quality_reason"),
        response_type_distribution=_map(profile.frequency(clean, "response_type"), "response_type"),
        total_clean_convs=conversations.agg(count).scalar(),
        golden_convs_protected=protected.agg(count).scalar(),
        split_conversations=_map(summary, "split", "conversations"),
        split_support_pairs=_map(summary, "split", "pairs"),
        split_tweets=_map(summary, "split", "tweets"),
        retrieval_corpus_size=retrieval.agg(count).scalar(),
        temporal_analysis=F.struct(
            clean.agg(F.min(replied_at)).scalar().alias("earliest_timestamp"),
            clean.agg(F.max(replied_at)).scalar().alias("latest_timestamp"),
            _map(profile.year_counts(clean, replied_at), "year").alias("yearly_distribution"),
            _map(profile.month_counts(clean, replied_at, month_year), "month").alias(f"monthly_{month_year}"),
        ),
    )
    write_document(stats, f"{out}/reports/cleaning_stats")
    return assigned


@stage_tables_dropped
def label_intents(
    spark: SparkSession,
    out: str,
    patterns: Mapping[str, str] = V.INTENT_PATTERNS,
    taxonomy: Mapping[str, Mapping] | str = V.TAXONOMY,
) -> DataFrame:
    """Intent labels for every split, their distribution and the taxonomy, given as a mapping or as a file."""
    rows = read_taxonomy(spark, taxonomy) if isinstance(taxonomy, str) else taxonomy_rows(spark, taxonomy)
    write_taxonomy(rows, f"{out}/reports/intent_taxonomy")
    labelled = rules.label_intent(_read(spark, out, "splits"), patterns=patterns)
    written = write_table(labelled, f"{out}/intents", partition_by=["split"])
    shares = profile.frequency(written, "intent", within=["split"])
    entry = F.struct("intent", "n", "pct")
    per_split = shares.groupBy("split").agg(
        F.sum("n").alias("total"), F.sort_array(F.collect_list(entry)).alias("distribution")
    )
    per_split.coalesce(1).write.mode("overwrite").json(f"{out}/reports/intent_distribution_stats")
    return written


def _checked(spark: SparkSession, out: str, split: str, text: str, labels: Sequence[str]) -> DataFrame:
    rows = _read(spark, out, "intents").filter(F.col("split") == split)
    return require(rows, required=[text, "intent"], not_null=[text, "intent"], domains={"intent": labels})


def _report(spark: SparkSession, out: str, name: str, counts: DataFrame, labels: Sequence[str], **extra) -> DataFrame:
    """Metrics document and confusion matrix of one model."""
    per_class = metrics.in_label_order(metrics.per_class(counts, labels), labels, "label")
    per_class = per_class.agg(F.collect_list(F.struct("label", "precision", "recall", "f1", "support")))
    parts = {"metrics": _record(metrics.overall(counts, labels)), "per_class": per_class.scalar(), **extra}
    document = _document(spark, model=F.lit(name), test_size=counts.agg(F.sum("n")).scalar(), **parts)
    write_confusion(metrics.confusion_matrix(counts, labels), labels, f"{out}/reports/{name}_confusion_matrix")
    return _written(document, f"{out}/reports/{name}_results")


def _written(document: DataFrame, path: str) -> DataFrame:
    """A report, read back from where it was written."""
    write_document(document, path)
    return document.sparkSession.read.schema(document.schema).json(path)


def _parameters(**values):
    """Model settings as a map of text."""
    pairs = [F.struct(F.lit(k).alias("key"), F.lit(str(v)).alias("value")) for k, v in sorted(values.items())]
    return F.map_from_entries(F.array(*pairs))


@stage_tables_dropped
def evaluate_baselines(
    spark: SparkSession, out: str, labels: Sequence[str] = V.INTENTS, majority: str = V.FALLBACK, seed: int = 42
) -> DataFrame:
    """Majority and rule predictions on the test split: reports, comparison and an error sample."""
    test = _checked(spark, out, splits.TEST, "customer_text", labels)
    scored = materialize(rules.rule_predict(test))
    by_rule = materialize(metrics.confusion_counts(scored))
    by_majority = metrics.confusion_counts(rules.majority_predict(test, constant=majority))
    _report(spark, out, "majority_baseline", by_majority, labels)
    _report(spark, out, "rule_based", by_rule, labels)
    sample = splits.error_sample(scored, "customer_text", "intent", "predicted_intent", "pair_id", 20, seed)
    write_table(sample, f"{out}/reports/rule_based_errors", "json")
    delta = metrics.model_delta({"majority": by_majority, "rule_based": by_rule}, labels, "majority")
    return write_table(delta, f"{out}/reports/baseline_comparison", "json")


@stage_tables_dropped
def evaluate_tfidf_logistic(
    spark: SparkSession,
    out: str,
    labels: Sequence[str] = V.INTENTS,
    stop_words: Sequence[str] | None = None,
    text: str = "customer_text_normalized",
    **options,
) -> DataFrame:
    """TF-IDF and logistic regression fitted on the training split, scored on the test split."""
    train, test = (_checked(spark, out, s, text, labels) for s in (splits.TRAIN, splits.TEST))
    stops = V.english_stop_words() if stop_words is None else stop_words
    model = classifiers.fit_tfidf_logistic(train, text, "intent", labels, stops, **options)
    counts = materialize(metrics.confusion_counts(model.predict(test, text)))
    settings = _parameters(
        **options, features=len(model.tfidf.terms), max_n=model.tfidf.max_n, stop_words=len(stops), class_weight="balanced"
    )
    size = F.lit(model.tfidf.rows).cast("bigint")
    return _report(spark, out, "tfidf_lr", counts, labels, train_size=size, parameters=settings)


@stage_tables_dropped
def evaluate_centroids(
    spark: SparkSession, out: str, embeddings: DataFrame, labels: Sequence[str] = V.INTENTS, vector: str = "embedding"
) -> DataFrame:
    """Nearest class centroid; ``embeddings`` holds a unit vector per ``pair_id``."""
    vectors = embeddings.select("pair_id", vector)
    train, test = (
        _checked(spark, out, s, "customer_text", labels).join(vectors, "pair_id") for s in (splits.TRAIN, splits.TEST)
    )
    model = classifiers.fit_centroids(train, labels, "intent", vector)
    scored = materialize(model.predict(test, vector).select("pair_id", "intent", "predicted_intent", "confidence"))
    counts = metrics.confusion_counts(scored)
    confidence = _record(profile.confidence_stats(scored))
    sizes = _map(profile.frequency(train, "intent"), "intent")
    return _report(
        spark, out, "embedding_classifier", counts, labels, intent_counts=sizes, confidence_stats=confidence,
        train_size=train.agg(F.count(F.lit(1))).scalar(), parameters=_parameters(classes=len(model.labels), score="cosine"),
    )


@stage_tables_dropped
def evaluate_manual_labels(
    spark: SparkSession,
    predictions: DataFrame,
    human: DataFrame,
    out: str,
    key: str = "pair_id",
    label: str = "manual_intent_label",
    labels: Sequence[str] = V.INTENTS,
) -> DataFrame:
    """Scores predictions against human labels, with the rows missing on either side."""
    aligned = materialize(metrics.align_labels(predictions, human, key, "predicted_intent", label))
    matched = aligned.filter("intent IS NOT NULL AND predicted_intent IS NOT NULL")
    alignment = _record(metrics.alignment_report(aligned, labels))
    return _report(spark, out, "manual_labels", metrics.confusion_counts(matched), labels, alignment=alignment)


@stage_tables_dropped
def brand_report(spark: SparkSession, out: str, brand: str) -> DataFrame:
    """Size, thread, delay, signal and vocabulary figures of the extracted brand."""
    tweets, found = _read(spark, out, "tweets"), _read(spark, out, "support_pairs")
    named = found.withColumn("response_type", rules.response_type(V.PROFILE_RESPONSE_TYPES))
    ngrams = profile.top_ngrams(found, stop_words=V.profile_stop_words())
    document = _document(
        spark,
        sides=_map(profile.direction_counts(tweets, brand), "side", "tweets"),
        profile=_record(profile.profile_core(tweets)),
        threads=_record(profile.thread_length_stats(tweets)),
        length_breakdown=_map(profile.thread_length_buckets(tweets), "bucket", "conversations"),
        customers_in_pairs=found.select("customer_author_id").distinct().agg(F.count(F.lit(1))).scalar(),
        delays=_record(profile.delay_stats(found)),
        signals=_map(profile.signal_rates(found), "signal", "replies"),
        response_categories=_map(profile.frequency(named, "response_type"), "response_type"),
        # At most 55 rows by the limits of the n-gram report.
        ngrams=ngrams.agg(F.sort_array(F.collect_list(F.struct("n", "occurrences", "term")))).scalar(),
    )
    return _written(document, f"{out}/reports/brand_stats")


@stage_tables_dropped
def explore_topics(
    spark: SparkSession, out: str, cluster_options: Mapping | None = None, topic_options: Mapping | None = None
) -> tuple[DataFrame, DataFrame]:
    """k-means clusters and matrix-factorisation topics of the training questions."""
    train = _read(spark, out, "splits").filter(F.col("split") == splits.TRAIN)
    clusters, _ = topics.kmeans_topics(train, "pair_id", "customer_text_normalized", V.cluster_stop_words(), **({"shown": ["customer_text"]} | dict(cluster_options or {})))
    themes, _ = topics.nmf_topics(train, "pair_id", "customer_text_normalized", V.topic_stop_words(), **({"shown": REPLIES} | dict(topic_options or {})))
    return (
        write_table(clusters, f"{out}/reports/intent_clusters", "json"),
        write_table(themes, f"{out}/reports/topics", "json"),
    )
