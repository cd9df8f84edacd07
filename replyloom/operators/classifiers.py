"""Fitted classifiers: nearest centroid and logistic regression on embeddings, logistic regression on TF-IDF."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replyloom.functions.vectors import nearest, rows_of
from replyloom.operators.features import TfidfModel, class_weights, fit_tfidf, tokens
from replyloom.session import materialize


def class_centroids(df: DataFrame, labels: Sequence[str], label: str = "label", vector: str = "embedding") -> DataFrame:
    """(label, n, centroid) with unit-length mean vectors, one partial sum per label and task."""
    known = df.filter(F.col(label).cast("string").isin(list(labels)))
    means = known.groupBy(F.col(label).cast("string").alias("label")).agg(
        F.count(F.lit(1)).alias("n"),
        vector_to_array(Summarizer.mean(array_to_vector(F.col(vector)))).alias("mean"),
    )
    norm = F.sqrt(F.aggregate("mean", F.lit(0.0), lambda acc, x: acc + x * x))
    return means.withColumn("norm", norm).select(
        "label", "n", F.transform("mean", lambda x: x / F.col("norm")).alias("centroid")
    )


@dataclass(frozen=True)
class CentroidModel:
    labels: list[str]
    centers: np.ndarray

    def predict(self, df: DataFrame, vector: str = "embedding") -> DataFrame:
        """Add ``predicted_intent`` and ``confidence``, the largest cosine (vectors are unit length)."""
        return df.withColumn("_near", nearest(F.col(vector), self.labels, self.centers)).select(
            *df.columns, F.col("_near.label").alias("predicted_intent"), F.col("_near.score").alias("confidence")
        )


def fit_centroids(df: DataFrame, labels: Sequence[str], label: str = "label", vector: str = "embedding") -> CentroidModel:
    """Collects one vector per label of the fixed list, nothing that grows with the data."""
    rows = {r.label: r.centroid for r in class_centroids(df, labels, label, vector).collect()}
    present = [name for name in labels if name in rows]
    return CentroidModel(present, np.array([rows[name] for name in present]))


@dataclass(frozen=True)
class TfidfLogisticModel:
    tfidf: TfidfModel
    logistic: LogisticRegressionModel
    labels: list[str]

    def predict(self, df: DataFrame, text: str) -> DataFrame:
        scored = self.logistic.transform(self.tfidf.vectors(df, text, "_features"))
        names = F.array(*[F.lit(l) for l in self.labels])
        return scored.withColumn("predicted_intent", F.get(names, F.col("_prediction").cast("int"))).select(
            *df.columns, "predicted_intent"
        )


def fit_tfidf_logistic(
    train: DataFrame,
    text: str,
    label: str,
    labels: Sequence[str],
    stop_words: Sequence[str],
    max_features: int = 10_000,
    min_df: int = 2,
    max_df: float = 0.95,
    max_iter: int = 1000,
    inverse_penalty: float = 1.0,
) -> TfidfLogisticModel:
    """Multinomial logistic regression with balanced classes; the penalty is scaled as 1 / (C * rows)."""
    words = tokens(train, label, F.col(text), stop_words)
    tfidf = fit_tfidf(words, "_tokens", max_features, min_df, max_df, stop_words)
    weight = {r[0]: r.weight for r in class_weights(words.filter(F.col(label).isin(list(labels))), label).collect()}
    present = [name for name in labels if name in weight]
    names = F.array(*[F.lit(l) for l in present])
    weights = F.array(*[F.lit(float(weight[l])) for l in present])
    index = F.array_position(names, F.col(label)).cast("int")
    vectors = tfidf.vectors(words.filter(F.col(label).isin(present)), "_tokens", "_features").select(
        "_features", (index - 1).cast("double").alias("_label"), F.get(weights, index - 1).alias("_weight")
    )
    # The solver reads its input several times before it keeps blocks of it.
    rows = materialize(vectors)
    model = LogisticRegression(
        family="multinomial",
        featuresCol="_features",
        labelCol="_label",
        weightCol="_weight",
        predictionCol="_prediction",
        rawPredictionCol="_raw",
        probabilityCol="_probability",
        maxIter=max_iter,
        tol=1e-6,
        regParam=1.0 / (inverse_penalty * tfidf.rows),
        elasticNetParam=0.0,
        standardization=False,
    ).fit(rows)
    return TfidfLogisticModel(tfidf, model, present)


def _softmax(scores: np.ndarray) -> np.ndarray:
    shifted = np.exp(scores - scores.max(axis=1, keepdims=True))
    return shifted / shifted.sum(axis=1, keepdims=True)


def _with_one(batch: pa.Array, width: int) -> np.ndarray:
    """The vectors as rows, with a last column of ones for the intercept."""
    return np.hstack([rows_of(batch, width), np.ones((len(batch), 1))])


@dataclass(frozen=True)
class NewtonModel:
    """Multinomial logistic regression on dense vectors: a row per label, the intercept last, and how the fit went."""

    labels: list[str]
    coefficients: np.ndarray
    losses: list[float]
    gradient: np.ndarray
    rows: int

    def predict(self, df: DataFrame, vector: str = "embedding") -> DataFrame:
        """Add ``predicted_intent`` and ``confidence``, the largest probability; ties go to the earlier label."""
        coefficients, names = self.coefficients, np.array(self.labels, dtype=object)

        @F.arrow_udf("struct<label: string, score: double>")
        def score(batch: pa.Array) -> pa.Array:
            p = _softmax(_with_one(batch, coefficients.shape[1] - 1) @ coefficients.T)
            best = p.argmax(axis=1)
            return pa.StructArray.from_arrays(
                [pa.array(names[best], pa.string()), pa.array(p[np.arange(len(best)), best])], ["label", "score"]
            )

        return df.withColumn("_best", score(F.col(vector))).select(
            *df.columns, F.col("_best.label").alias("predicted_intent"), F.col("_best.score").alias("confidence")
        )


def _newton_sums(rows: DataFrame, coefficients: np.ndarray, parts: int = 16) -> tuple[float, np.ndarray, np.ndarray]:
    """Loss, gradient and Hessian of the weighted data at ``coefficients``, summed block by block in tasks.

    Every task sends one row per pair of labels, a block of D x D numbers, and one for the gradient and the loss. Blocks are added up
    in tasks again, so that the driver gets one row per pair whatever the number of tasks.
    """
    count, width = coefficients.shape

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss, gradient = 0.0, np.zeros((count, width))
        hessian = np.zeros((count, count, width, width))
        for batch in batches:
            x = _with_one(batch.column(0), width - 1)
            label, weight = (batch.column(i).to_numpy() for i in (1, 2))
            p = _softmax(x @ coefficients.T)
            loss -= float(weight @ np.log(np.maximum(p[np.arange(len(x)), label], 1e-300)))
            off = p.copy()
            off[np.arange(len(x)), label] -= 1.0
            gradient += (off * weight[:, None]).T @ x
            for a in range(count):
                for b in range(a, count):
                    hessian[a, b] += (x * (weight * p[:, a] * ((a == b) - p[:, b]))[:, None]).T @ x
        pairs = [(a, b) for a in range(count) for b in range(a, count)]
        blocks = [hessian[a, b].tobytes() for a, b in pairs] + [np.append(gradient.ravel(), loss).tobytes()]
        numbers = [a * count + b for a, b in pairs] + [-1]
        yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(blocks, pa.binary())], ["block", "sums"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, sums in zip(batch.column(0).to_pylist(), batch.column(1)):
                values = np.frombuffer(sums.as_buffer())
                total[block] = total[block] + values if block in total else values
        columns = [pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["block", "sums"])

    schema = "block INT, sums BINARY"
    summed = rows.mapInArrow(partial, schema).repartition(parts, "block").mapInArrow(added, schema).collect()
    loss, gradient = 0.0, np.zeros((count, width))
    hessian = np.zeros((count, width, count, width))
    for row in summed:
        values = np.frombuffer(row.sums)
        if row.block < 0:
            loss, gradient = float(values[-1]), values[:-1].reshape(count, width)
        else:
            a, b = divmod(row.block, count)
            hessian[a, :, b, :] = values.reshape(width, width)
            hessian[b, :, a, :] = values.reshape(width, width).T
    return loss, gradient, hessian.reshape(count * width, count * width)


def fit_newton_logistic(
    train: DataFrame, labels: Sequence[str], label: str = "label", vector: str = "embedding", inverse_penalty: float = 1.0,
    max_steps: int = 30, tol: float = 1e-8,
) -> NewtonModel:
    """Multinomial logistic regression with balanced classes by Newton's method, for dense vectors of some hundred numbers.

    Minimises the weighted log loss plus half the squared coefficients over ``inverse_penalty``; intercepts are not penalised and sum to
    zero. A step is one job; one that would raise the objective is halved. Stops when no entry of the gradient exceeds ``tol`` times the number of rows;
    ``gradient`` is the certificate: as the objective is convex, small entries mean that the optimum is near. Rows of other labels or
    without a label are left out; vectors must not be null. The driver solves a system of labels x (dimensions + 1) unknowns.
    """
    name = F.col(label).cast("string")
    known = train.filter(name.isin(list(labels)))
    weight = {r[0]: (r.weight, r.n) for r in class_weights(known.select(name.alias(label)), label).collect()}
    present = [l for l in labels if l in weight]
    if not present:
        raise ValueError("no row has one of the labels")
    index = F.array_position(F.array(*[F.lit(l) for l in present]), name).cast("int") - 1
    weights = F.array(*[F.lit(float(weight[l][0])) for l in present])
    rows = materialize(known.select(vector, index.alias("_label"), F.get(weights, index).alias("_weight")))
    width = rows.select(F.max(F.size(vector))).first()[0] + 1
    count, total = len(present), sum(n for _, n in weight.values())
    penalty = np.ones((count, width)) / inverse_penalty
    penalty[:, -1] = 0.0
    current, step, losses, best = np.zeros((count, width)), np.zeros((count, width)), [], None
    for _ in range(max_steps + 1):
        trial = current + step
        loss, gradient, hessian = _newton_sums(rows, trial)
        objective = loss + 0.5 * float((penalty * trial * trial).sum())
        if best is not None and objective > best[0] + 1e-12 * abs(best[0]):
            step = step / 2
            continue
        gradient = gradient + penalty * trial
        current, best = trial, (objective, gradient)
        losses.append(objective)
        if np.abs(gradient).max() <= tol * total:
            break
        # The least-norm step: the sum of the intercepts has no effect and stays zero.
        system = hessian + np.diag(penalty.ravel())
        step = -np.linalg.lstsq(system, gradient.ravel(), rcond=1e-12)[0].reshape(count, width)
    return NewtonModel(present, current, losses, best[1], total)


def gradient_certificate(model: NewtonModel, spark: SparkSession, tol: float = 1e-6) -> DataFrame:
    """(label, within): whether no entry of the label's gradient exceeds ``tol`` times the number of rows."""
    worst = np.abs(model.gradient).max(axis=1)
    rows = [(name, bool(w <= tol * model.rows)) for name, w in zip(model.labels, worst.tolist())]
    return spark.createDataFrame(rows, "label string, within boolean")
