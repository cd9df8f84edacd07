"""Command line for the file-to-file jobs: ``spark-submit`` or ``python -m replyloom JOB --out FOLDER``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from replyloom.operators import profile
from replyloom.plans import jobs
from replyloom.session import tune
from replyloom.sources.files import ingest_tweets, write_table


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="replyloom", description=__doc__)
    parser.add_argument("--out", required=True, help="output folder shared by all jobs")
    sub = parser.add_subparsers(dest="job", required=True)
    ingest = sub.add_parser("ingest", help="message CSV to Parquet")
    ingest.add_argument("csv", nargs="+")
    rank = sub.add_parser("brands", help="profile every brand of the messages")
    rank.add_argument("--min-total", type=int, default=25_000)
    for name in ("extract", "profile"):
        sub.add_parser(name).add_argument("--brand", required=True)
    split = sub.add_parser("clean", help="normalise, flag, type and split the pairs")
    split.add_argument("--seed", type=int, default=42)
    for name in ("intents", "baselines", "tfidf", "topics"):
        sub.add_parser(name)
    sub.add_parser("centroids").add_argument("--embeddings", required=True, help="Parquet with pair_id, embedding")
    manual = sub.add_parser("manual", help="score predictions against human labels")
    manual.add_argument("--labels", required=True, help="Parquet with pair_id, manual_intent_label")
    manual.add_argument("--predictions", required=True, help="Parquet with pair_id, predicted_intent")
    return parser


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    out = args.out
    match args.job:
        case "ingest":
            ingest_tweets(spark, args.csv, f"{out}/raw")
        case "brands":
            ranking = profile.brand_profile(spark.read.parquet(f"{out}/raw"), args.min_total)
            write_table(ranking, f"{out}/reports/brands", "json")
        case "extract":
            jobs.extract(spark.read.parquet(f"{out}/raw"), out, args.brand)
        case "profile":
            jobs.brand_report(spark, out, args.brand)
        case "clean":
            jobs.clean_and_split(spark, out, seed=args.seed)
        case "intents":
            jobs.label_intents(spark, out)
        case "baselines":
            jobs.evaluate_baselines(spark, out)
        case "tfidf":
            jobs.evaluate_tfidf_logistic(spark, out)
        case "centroids":
            jobs.evaluate_centroids(spark, out, spark.read.parquet(args.embeddings))
        case "manual":
            predictions, human = spark.read.parquet(args.predictions), spark.read.parquet(args.labels)
            jobs.evaluate_manual_labels(spark, predictions, human, out)
        case "topics":
            jobs.explore_topics(spark, out)


def main(argv: list[str] | None = None) -> None:
    args = arguments().parse_args(argv)
    run(tune(SparkSession.builder.appName(f"replyloom-{args.job}").getOrCreate()), args)


if __name__ == "__main__":
    main()
