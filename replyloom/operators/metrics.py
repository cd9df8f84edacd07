"""Classification metrics over a fixed label list.

Predictions are first reduced to (true, predicted, n) counts, at most the square of the label count,
so every metric after that works on a handful of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replyloom.session import materialize

OVERALL = [
    "accuracy", "macro_precision", "macro_recall", "macro_f1",
    "weighted_precision", "weighted_recall", "weighted_f1",
]


def confusion_counts(predictions: DataFrame, true: str = "intent", predicted: str = "predicted_intent") -> DataFrame:
    return predictions.groupBy(F.col(true).alias("true_label"), F.col(predicted).alias("predicted_label")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _zeros(counts: DataFrame, labels: Sequence[str]) -> DataFrame:
    """A zero count on the diagonal for every label, so that no label of the list gets lost."""
    rows = [F.struct(F.lit(l).alias("true_label"), F.lit(l).alias("predicted_label"), F.lit(0).cast("bigint").alias("n")) for l in labels]
    return counts.sparkSession.range(1).select(F.inline(F.array(*rows)))


def confusion_matrix(counts: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Wide matrix: one row per true label, one column per predicted label, zeros kept."""
    return (
        counts.unionByName(_zeros(counts, labels))
        .filter(F.col("true_label").isin(list(labels)))
        .groupBy("true_label")
        .pivot("predicted_label", list(labels))
        .agg(F.sum("n").cast("bigint"))
        .na.fill(0)
    )


def in_label_order(matrix: DataFrame, labels: Sequence[str], column: str = "true_label") -> DataFrame:
    """Rows of a small per-label table in the order of the list, for files."""
    return matrix.orderBy(F.array_position(F.array(*[F.lit(l) for l in labels]), F.col(column)))


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def _totals(counts: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Hits, support and predictions per label, and over all rows under the label null."""
    hit = F.when(F.col("true_label") == F.col("predicted_label"), F.col("n")).otherwise(0)
    n, none = F.col("n"), F.lit(0).cast("bigint")

    def share(label: Column, hits: Column, support: Column, predicted: Column) -> Column:
        return F.struct(
            label.alias("label"), hits.alias("hits"), support.alias("support"), predicted.alias("predicted")
        )

    shares = F.array(
        share(F.col("true_label"), hit, n, none),
        share(F.col("predicted_label"), none, none, n),
        share(F.lit(None).cast("string"), hit, n, n),
    )
    return (
        counts.unionByName(_zeros(counts, labels))
        .select(F.inline(shares))
        .filter(F.col("label").isNull() | F.col("label").isin(list(labels)))
        .groupBy("label")
        .agg(*[F.sum(c).cast("bigint").alias(c) for c in ("hits", "support", "predicted")])
        .withColumns({
            "precision": _ratio(F.col("hits"), F.col("predicted")),
            "recall": _ratio(F.col("hits"), F.col("support")),
            # 2PR/(P+R) written with counts, which is zero when nothing was hit.
            "f1": _ratio(2 * F.col("hits"), F.col("predicted") + F.col("support")),
        })
    )


def per_class(counts: DataFrame, labels: Sequence[str], digits: int = 4) -> DataFrame:
    """Precision, recall, F1 and support; a class never predicted or without support scores zero."""
    return (
        _totals(counts, labels)
        .filter("label IS NOT NULL")
        .select("label", *[F.round(m, digits).alias(m) for m in ("precision", "recall", "f1")], "support")
    )


def overall(counts: DataFrame, labels: Sequence[str], digits: int = 4) -> DataFrame:
    """Accuracy over all rows; macro and support-weighted averages over the label list."""
    is_label = F.col("label").isNotNull()
    support = F.when(is_label, F.col("support"))
    values = {"accuracy": F.max(F.when(~is_label, F.col("recall")))}
    for m in ("precision", "recall", "f1"):
        values[f"macro_{m}"] = F.avg(F.when(is_label, F.col(m)))
        values[f"weighted_{m}"] = _ratio(F.sum(F.col(m) * support), F.sum(support))
    return _totals(counts, labels).agg(*[F.round(values[m], digits).alias(m) for m in OVERALL])


def model_delta(models: dict[str, DataFrame], labels: Sequence[str], baseline: str, digits: int = 4) -> DataFrame:
    """Overall metrics of each model beside the baseline, the difference, and whether it is better.

    ``models`` maps a name to its confusion counts.
    """
    tidy = None
    for name, counts in models.items():
        rows = overall(counts, labels, digits).select(
            F.lit(name).alias("model"),
            F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in OVERALL])),
        )
        tidy = rows if tidy is None else tidy.unionByName(rows)
    wide = tidy.groupBy("metric").pivot("model", list(models)).agg(F.first("value"))
    others = [m for m in models if m != baseline]
    rows = [
        F.struct(
            F.lit(name).alias("model"),
            F.col(name).alias("value"),
            F.col(baseline).alias("baseline_value"),
            F.round(F.col(name) - F.col(baseline), digits).alias("delta"),
            (F.col(name) > F.col(baseline)).alias("beats_baseline"),
        )
        for name in others
    ]
    return wide.select("metric", F.inline(F.array(*rows)))


def align_labels(predictions: DataFrame, human: DataFrame, key: str, predicted: str, label: str) -> DataFrame:
    """Predictions and human labels by key; rows without a partner are kept with a null on the other side."""
    return predictions.select(key, F.col(predicted).alias("predicted_intent")).join(
        human.select(key, F.col(label).alias("intent")), key, "full"
    )


def alignment_report(aligned: DataFrame, labels: Sequence[str], digits: int = 4) -> DataFrame:
    """Overall metrics on the aligned rows, with the unmatched counts of both sides."""
    counts = materialize(confusion_counts(aligned))
    matched = F.col("true_label").isNotNull() & F.col("predicted_label").isNotNull()

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("bigint")

    sides = counts.agg(
        F.struct(
            total(matched).alias("matched"),
            total(F.col("true_label").isNull()).alias("without_label"),
            total(F.col("predicted_label").isNull()).alias("without_prediction"),
        )
    )
    scores = overall(counts.filter(matched), labels, digits)
    return scores.withColumn("sides", sides.scalar()).select("sides.*", *OVERALL)
