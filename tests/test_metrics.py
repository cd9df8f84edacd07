"""Metrics on published confusion matrices and on edge cases."""

import pytest

from replyloom.operators import metrics
from replyloom.vocabulary import INTENTS

# Confusion matrices over 16,298 rows in label order, with the metrics published for them.
RULES = [
    [6632, 0, 0, 0, 0, 0, 0, 0],
    [0, 2978, 0, 0, 0, 0, 0, 0],
    [9, 4, 1602, 0, 5, 0, 0, 0],
    [356, 203, 0, 983, 0, 0, 0, 0],
    [0, 0, 0, 0, 1222, 0, 0, 0],
    [26, 11, 0, 1, 5, 800, 0, 2],
    [5, 0, 0, 0, 0, 0, 824, 0],
    [19, 13, 0, 3, 1, 0, 0, 594],
]
TFIDF = [
    [6417, 10, 5, 0, 1, 28, 159, 12],
    [22, 2905, 3, 2, 0, 12, 32, 2],
    [11, 17, 1540, 8, 19, 12, 0, 13],
    [18, 27, 2, 1474, 1, 0, 20, 0],
    [21, 11, 0, 15, 1168, 4, 1, 2],
    [8, 11, 0, 11, 12, 791, 0, 12],
    [17, 13, 7, 14, 4, 2, 771, 1],
    [6, 9, 0, 11, 13, 0, 0, 591],
]
CENTROID = [
    [3565, 376, 179, 332, 558, 566, 873, 183],
    [303, 1720, 37, 265, 179, 218, 186, 70],
    [24, 33, 1405, 54, 39, 33, 1, 31],
    [128, 161, 15, 942, 77, 14, 196, 9],
    [110, 86, 10, 110, 841, 28, 13, 24],
    [55, 54, 30, 14, 31, 638, 2, 21],
    [32, 36, 13, 48, 15, 3, 680, 2],
    [28, 29, 2, 34, 29, 13, 1, 494],
]
PUBLISHED = [
    (RULES, {"accuracy": 0.9593, "macro_f1": 0.9548, "weighted_f1": 0.9561}),
    (
        TFIDF,
        {
            "accuracy": 0.9607, "macro_precision": 0.9387, "macro_recall": 0.9512, "macro_f1": 0.9441,
            "weighted_precision": 0.9626, "weighted_recall": 0.9607, "weighted_f1": 0.9613,
        },
    ),
    (CENTROID, {"accuracy": 0.6311, "macro_f1": 0.6205, "weighted_f1": 0.6405}),
]


def counts_of(spark, matrix, labels=INTENTS):
    rows = [(t, p, n) for t, line in zip(labels, matrix) for p, n in zip(labels, line) if n]
    return spark.createDataFrame(rows, "true_label string, predicted_label string, n bigint")


@pytest.mark.parametrize("matrix, published", PUBLISHED)
def test_published_metrics(spark, matrix, published):
    counts = counts_of(spark, matrix)
    got = metrics.overall(counts, INTENTS).first().asDict()
    assert {k: got[k] for k in published} == published
    wide = metrics.in_label_order(metrics.confusion_matrix(counts, INTENTS), INTENTS).collect()
    assert [r.true_label for r in wide] == INTENTS
    assert [[r[c] for c in INTENTS] for r in wide] == matrix


def test_majority_metrics(spark):
    support = [sum(line) for line in RULES]
    counts = counts_of(spark, [[n, *[0] * 7] for n in support])
    got = metrics.overall(counts, INTENTS).first()
    assert (got.accuracy, got.macro_f1, got.weighted_f1) == (0.4069, 0.0723, 0.2354)
    per_class = {r.label: r for r in metrics.per_class(counts, INTENTS).collect()}
    assert per_class["software_update"].asDict() == {
        "label": "software_update", "precision": 0.0, "recall": 0.0, "f1": 0.0, "support": 2978,
    }


def test_edges(spark):
    labels = ["a", "b", "c"]
    perfect = counts_of(spark, [[2, 0, 0], [0, 3, 0], [0, 0, 1]], labels)
    assert set(metrics.overall(perfect, labels).first()) == {1.0}
    wrong = counts_of(spark, [[0, 2, 0], [3, 0, 0], [0, 0, 0]], labels)
    assert set(metrics.overall(wrong, labels).first()) == {0.0}
    empty = counts_of(spark, [[0] * 3] * 3, labels)
    assert set(metrics.overall(empty, labels).first()) == {0.0}
    assert metrics.per_class(empty, labels).count() == 3
    assert metrics.confusion_matrix(empty, labels).count() == 3
    # A prediction outside the list counts against accuracy and recall only.
    outside = spark.createDataFrame([("a", "z", 1), ("a", "a", 1)], "true_label string, predicted_label string, n bigint")
    row = metrics.overall(outside, ["a"]).first()
    assert (row.accuracy, row.macro_precision, row.macro_recall) == (0.5, 1.0, 0.5)


def test_model_delta(spark):
    models = {"rules": counts_of(spark, RULES), "tfidf": counts_of(spark, TFIDF), "centroid": counts_of(spark, CENTROID)}
    rows = {(r.model, r.metric): r for r in metrics.model_delta(models, INTENTS, "rules").collect()}
    assert rows["tfidf", "macro_f1"].delta == pytest.approx(-0.0107)
    assert not rows["centroid", "accuracy"].beats_baseline and rows["tfidf", "accuracy"].beats_baseline
    assert len(rows) == 14


def test_alignment_counts_both_sides(spark):
    predictions = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "pair_id long, predicted_intent string")
    human = spark.createDataFrame([(2, "b"), (3, "b"), (4, "a")], "pair_id long, manual string")
    aligned = metrics.align_labels(predictions, human, "pair_id", "predicted_intent", "manual")
    row = metrics.alignment_report(aligned, ["a", "b"]).first()
    assert (row.matched, row.without_label, row.without_prediction, row.accuracy) == (2, 1, 1, 0.5)
