"""Readers, writers, and all jobs from a CSV export to the reports."""

import csv
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from replyloom import vocabulary as V
from replyloom.__main__ import main
from replyloom.operators import metrics
from replyloom.plans import jobs
from replyloom.schemas import CONVERSATIONS, SUPPORT_PAIRS, TWEETS
from replyloom.session import stages
from replyloom.sources import files
from replyloom.sources.messages import COMPLAINTS

BRAND = "HelpDesk"


def stamp(conversation, minute):
    day = 1 + conversation % 28
    return f"Sun Oct {day:02d} {minute // 60:02d}:{minute % 60:02d}:00 +0000 2017"


def export_rows():
    """Small support threads with line breaks, quotes, masked handles, links and a dangling reply."""
    rows = []
    for c in range(80):
        first = c * 10
        complaint = COMPLAINTS[c % len(COMPLAINTS)]
        text = f'@{115000 + c} "hi"\n{complaint}, 😀 ok' if c % 9 else f"@{115000 + c} https://t.co/a{c}"
        answer = "Please restart, then DM us https://t.co/z ^HP" if c % 2 else "Which version?"
        rows.append([first, str(700 + c), True, stamp(c, 10), text, f"{first + 1},{first + 2}", None])
        rows.append([first + 1, BRAND, False, stamp(c, 30), answer, f"{first + 3}", float(first)])
        rows.append([first + 2, BRAND, False, stamp(c, 31), "One more thing /LS", None, float(first)])
        rows.append([first + 3, str(700 + c), True, stamp(c, 50), f"still {complaint}", None, float(first + 1)])
        rows.append([first + 4, "Other", False, stamp(c, 60), "unrelated", None, float(first + 9)])
    rows.append([9001, BRAND, False, stamp(1, 1), "nobody asked", None, 99999.0])
    return rows


@pytest.fixture(scope="module")
def export(tmp_path_factory):
    path = tmp_path_factory.mktemp("export") / "messages.csv"
    with open(path, "w", newline="", encoding="utf-8") as handle:
        writer = csv.writer(handle)
        writer.writerow(TWEETS.names)
        writer.writerows(export_rows())
    return str(path)


@pytest.fixture(scope="module")
def finished(spark, export, tmp_path_factory):
    """The output folder after every job ran."""
    out = str(tmp_path_factory.mktemp("out"))
    tweets = files.ingest_tweets(spark, export, f"{out}/raw")
    jobs.extract(tweets, out, BRAND, sample_size=12)
    jobs.clean_and_split(spark, out)
    jobs.label_intents(spark, out)
    return out


def document(path):
    (part,) = list(Path(path).glob("part-*.json"))
    return json.loads(part.read_text(encoding="utf-8"))


def test_csv_keeps_texts(spark, export):
    got = {r.tweet_id: r for r in files.read_tweets_csv(spark, export).collect()}
    assert len(got) == len(export_rows())
    for tid, author, inbound, at, text, children, parent in export_rows():
        row = got[tid]
        assert (row.author_id, row.inbound, row.created_at, row.text) == (author, inbound, at, text)
        assert (row.response_tweet_id, row.in_response_to_tweet_id) == (children, None if parent is None else int(parent))


def test_parent_ids_are_read_digit_by_digit(spark, tmp_path):
    written = {
        "9007199254740993": 9007199254740993, "119240.0": 119240, " 7 ": 7, "": None, "  ": None, "junk": None, "1.5": None,
        "9223372036854775807.00": 2**63 - 1, "9223372036854775808": None, "1e3": None,
    }
    path = tmp_path / "ids.csv"
    with open(path, "w", newline="", encoding="utf-8") as handle:
        writer = csv.writer(handle)
        writer.writerow(TWEETS.names)
        writer.writerows([i, "a", True, stamp(1, 1), "line\nbreak", "", parent] for i, parent in enumerate(written))
    got = {r.tweet_id: r.in_response_to_tweet_id for r in files.read_tweets_csv(spark, str(path)).collect()}
    assert got == dict(enumerate(written.values()))
    assert files.unread_parents(spark, str(path)) == 4


def test_a_document_has_one_row(spark, tmp_path):
    files.write_document(spark.range(1), str(tmp_path / "one"))
    assert document(tmp_path / "one") == {"id": 0}
    for rows in (0, 3):
        with pytest.raises(Exception, match="a document has one row"):
            files.write_document(spark.range(rows), str(tmp_path / f"rows{rows}"))


def test_tables_of_another_shape_stop_a_job(spark, finished, tmp_path):
    spark.read.parquet(f"{finished}/splits").withColumn("pair_id", F.col("pair_id").cast("string")).drop("response_type").write.parquet(
        str(tmp_path / "splits")
    )
    with pytest.raises(ValueError, match="pair_id, response_type"):
        jobs.label_intents(spark, str(tmp_path))


def test_jobs_leave_no_stage_tables(spark, finished):
    before = stages()
    jobs.evaluate_baselines(spark, finished)
    assert stages() == before


def test_csv_with_other_columns_is_refused(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("a,b,c,d,e,f,g\n1,2,True,4,5,6,7\n")
    with pytest.raises(Exception):
        files.read_tweets_csv(spark, str(path)).collect()


def test_csv_round_trip(spark, tmp_path, export):
    df = files.read_tweets_csv(spark, export)
    back = files.write_table(df, str(tmp_path / "csv"), "csv")
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_extraction(spark, finished):
    tweets = spark.read.parquet(f"{finished}/tweets")
    assert tweets.filter("author_id = 'Other'").count() == 0
    assert tweets.count() == 80 * 4 + 1
    sizes = {r.conversation_length for r in tweets.select("conversation_length").distinct().collect()}
    assert sizes == {1, 4}
    records = files.read_records(spark, f"{finished}/conversations")
    assert records.schema == CONVERSATIONS
    assert records.count() == 81
    lines = spark.read.text(f"{finished}/conversations").collect()
    first = json.loads(next(r.value for r in lines if '"conversation_id":10,' in r.value))
    assert [t["tweet_id"] for t in first["tweets"]] == [10, 11, 12, 13]
    assert first["tweets"][0]["in_response_to_tweet_id"] is None
    pairs = spark.read.parquet(f"{finished}/support_pairs")
    assert set(pairs.columns) == set(SUPPORT_PAIRS.names)
    assert sorted(r.pair_id for r in pairs.collect()) == list(range(1, 161))
    assert spark.read.parquet(f"{finished}/manual_sample").count() == 12


def test_cleaning(spark, finished):
    stats = document(f"{finished}/reports/cleaning_stats")
    assert stats["total_raw_pairs"] == 160
    assert stats["flag_breakdown"] == {"duplicate_customer_turn": 71, "url_or_mention_only_customer": 18, "valid": 71}
    assert stats["clean_pairs_count"] == 71 and stats["flagged_pairs_count"] == 89
    assert stats["split_conversations"] == {"train": 50, "validation": 11, "test": 10}
    assert sum(stats["split_tweets"].values()) == 71 * 4
    assert stats["temporal_analysis"]["yearly_distribution"] == {"2017": 71}
    assert stats["temporal_analysis"]["monthly_2017"] == {"10": 71}
    splits = spark.read.parquet(f"{finished}/splits")
    golden = spark.read.parquet(f"{finished}/manual_sample").select("conversation_id")
    assert {r.split for r in splits.join(golden, "conversation_id", "left_semi").collect()} <= {"test"}
    row = splits.filter("response_requests_dm").first()
    assert row.response_type == "Troubleshooting + Escalation"
    assert row.response_text_normalized.endswith("https://t.co/z") and row.response_text_url_norm.endswith("[URL]")
    assert row.customer_text_normalized.startswith('@user "hi" ')
    retrieval = spark.read.parquet(f"{finished}/retrieval_train")
    assert retrieval.count() == splits.filter("split = 'train'").count()


def test_intents(spark, finished):
    intents = spark.read.parquet(f"{finished}/intents")
    assert {r.intent for r in intents.select("intent").distinct().collect()} == set(V.INTENTS)
    taxonomy = files.read_taxonomy(spark, f"{finished}/reports/intent_taxonomy")
    assert {r.intent: r.confusable_intents for r in taxonomy.collect()} == {
        k: v["confusable_intents"] for k, v in V.TAXONOMY.items()
    }
    shares = spark.read.json(f"{finished}/reports/intent_distribution_stats").collect()
    assert {r.split: r.total for r in shares}["train"] == 50


def test_baselines(spark, finished):
    delta = jobs.evaluate_baselines(spark, finished).collect()
    assert len(delta) == 7
    results = document(f"{finished}/reports/rule_based_results")
    assert results["test_size"] == 10 and 0 <= results["metrics"]["accuracy"] <= 1
    assert [c["label"] for c in results["per_class"]] == V.INTENTS
    (part,) = Path(f"{finished}/reports/rule_based_confusion_matrix").glob("part-*.csv")
    rows = list(csv.reader(part.open(encoding="utf-8")))
    assert rows[0] == ["true \\ predicted", *V.INTENTS] and [r[0] for r in rows[1:]] == V.INTENTS
    assert sum(int(v) for r in rows[1:] for v in r[1:]) == 10


def test_fitted_models(spark, finished):
    row = jobs.evaluate_tfidf_logistic(spark, finished, max_features=500).first()
    assert row.test_size == 10 and row.metrics.accuracy >= 0.5
    assert row.train_size == 50 and row.parameters["max_features"] == "500"
    intents = spark.read.parquet(f"{finished}/intents")
    slot = F.array_position(F.array(*[F.lit(i) for i in V.INTENTS]), F.col("intent"))
    unit = F.transform(F.sequence(F.lit(1), F.lit(8)), lambda i: F.when(i == slot, 1.0).otherwise(0.0).cast("float"))
    row = jobs.evaluate_centroids(spark, finished, intents.select("pair_id", unit.alias("embedding"))).first()
    known = {r.intent for r in intents.filter("split = 'train'").collect()}
    expected = intents.filter("split = 'test'").filter(F.col("intent").isin(list(known))).count()
    assert row.metrics.accuracy == pytest.approx(expected / 10)
    assert sum(row.intent_counts.values()) == 50


def test_manual_labels(spark, finished):
    test = spark.read.parquet(f"{finished}/intents").filter("split = 'test'")
    human = test.select("pair_id", F.col("intent").alias("manual_intent_label")).limit(6)
    predictions = test.select("pair_id", F.col("intent").alias("predicted_intent"))
    row = jobs.evaluate_manual_labels(spark, predictions, human, finished).first()
    assert row.metrics.accuracy == 1.0
    assert (row.alignment.matched, row.alignment.without_label, row.alignment.without_prediction) == (6, 4, 0)


def test_brand_report_and_topics(spark, finished):
    report = jobs.brand_report(spark, finished, BRAND).first()
    assert report.sides == {"brand": 161, "customer": 160}
    assert report.length_breakdown["4 turns"] == 80 and report.threads.max_turns == 4
    assert report.signals["response_requests_dm"] == 40
    assert report.ngrams[0].n == 1
    clusters, themes = jobs.explore_topics(spark, finished, {"k": 4, "min_df": 2}, {"k": 4, "min_df": 2})
    assert sum(r["size"] for r in clusters.collect()) == 50 == sum(r["size"] for r in themes.collect())
    pairs = {r.pair_id: r for r in spark.read.parquet(f"{finished}/splits").collect()}
    for r in themes.collect():
        assert all((e.customer_text, e.response_text) == (pairs[e.pair_id].customer_text, pairs[e.pair_id].response_text) for e in r.examples)


def test_load_checks_stop_bad_labels(spark, finished):
    with pytest.raises(ValueError, match="domain:intent"):
        jobs.evaluate_baselines(spark, finished, labels=V.INTENTS[:3])


def test_confusion_counts_are_reusable(spark, finished):
    test = spark.read.parquet(f"{finished}/intents").withColumn("predicted_intent", F.col("intent"))
    assert set(metrics.overall(metrics.confusion_counts(test), V.INTENTS).first()) == {1.0}


def test_command_line(spark, export, tmp_path):
    out = str(tmp_path / "cli")
    main(["--out", out, "ingest", export])
    main(["--out", out, "brands", "--min-total", "10"])
    main(["--out", out, "extract", "--brand", BRAND])
    main(["--out", out, "clean"])
    main(["--out", out, "intents"])
    rows = spark.read.json(f"{out}/reports/brands").collect()
    assert {r.brand for r in rows} == {BRAND, "Other"}
    assert spark.read.parquet(f"{out}/intents").count() == 71
