"""Topic exploration: k-means clusters and non-negative matrix factorisation over TF-IDF vectors."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from replyloom.functions.text import modelling_text
from replyloom.functions.vectors import SparseBatch, cut
from replyloom.operators.features import fit_tfidf, tokens
from replyloom.operators.ordering import first_rows
from replyloom.operators.splits import shuffle_key
from replyloom.session import materialize, new_stage

WORDS = "_tokens"
FEATURES = "_features"


def _top_terms(weights: np.ndarray, terms: Sequence[str], n: int) -> list[str]:
    """Terms with the largest weights, ties alphabetical (terms are sorted)."""
    order = np.argsort(-weights, kind="stable")[:n]
    return [terms[i] for i in order if weights[i] > 0]


def _summary(
    assigned: DataFrame, group: str, top: dict[int, list[str]], examples: DataFrame, total: int
) -> DataFrame:
    """Size, percent, top terms and representative rows per group; groups without rows stay."""
    sizes = assigned.groupBy(group).agg(F.count(F.lit(1)).alias("size"))
    terms = assigned.sparkSession.createDataFrame(list(top.items()), f"{group} int, top_terms array<string>")
    kind = examples.schema["examples"].dataType
    return (
        terms.join(sizes, group, "left")
        .join(examples, group, "left")
        .select(
            F.col(group).cast("bigint").alias(group),
            F.coalesce("size", F.lit(0)).alias("size"),
            F.round(F.coalesce("size", F.lit(0)) * 100.0 / F.lit(max(total, 1)), 2).alias("pct"),
            "top_terms",
            F.coalesce("examples", F.array().cast(kind)).alias("examples"),
        )
    )


def _examples(chosen: DataFrame, df: DataFrame, group: str, key: str, shown: Sequence[str]) -> DataFrame:
    """(group, examples): the ``shown`` columns of the ``chosen`` rows (group, key, _rank), in order of rank.

    A few rows per group are chosen, so Spark joins them to the texts without moving those.
    """
    rows = chosen.join(df.select(key, *[c for c in shown if c != key]), key)
    entry = F.struct("_rank", F.struct(*dict.fromkeys([key, *shown])).alias("row"))
    listed = F.array_sort(F.collect_list(entry))
    return rows.groupBy(group).agg(F.transform(listed, lambda e: e["row"]).alias("examples"))


@dataclass(frozen=True)
class KMeansModel:
    """Cluster centres, ordered as their start rows were, with the summed squared distances."""

    centers: np.ndarray
    inertia: float
    rounds: int

    def assign(self, rows: DataFrame, key: str) -> DataFrame:
        """(key, cluster_id): the nearest centre, the first of several equally near ones."""
        centers = self.centers

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in cut(batches, 1):
                best = _nearest(SparseBatch.of(batch.column(1)), centers)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best, pa.int32())], [key, "cluster_id"])

        kind = rows.schema[key].dataType.simpleString()
        return rows.select(key, FEATURES).mapInArrow(place, f"`{key}` {kind}, cluster_id int")


def _nearest(x: SparseBatch, centers: np.ndarray) -> np.ndarray:
    scores = x.times(centers.T) - 0.5 * (centers * centers).sum(axis=1)
    # Rounded, so that equally near centres tie whatever the order of summation was.
    return np.round(scores, 9).argmax(axis=1)


def fit_kmeans(
    rows: DataFrame, key: str, n_terms: int, k: int, seed: int = 42, starts: int = 5, max_rounds: int = 300, digits: int = 9
) -> KMeansModel:
    """Lloyd's rounds until no centre moves, from several starts at once; the best start wins.

    Start rows are the first ``k`` by hash of the key, another hash for each start. Every round is one job for all starts
    that still move: it sums the rows of each cluster per term, at most one row per term comes back. Centres are
    rounded to ``digits``, so the result does not depend on how rows lie in partitions.
    """
    current = {}
    for start in range(starts):
        first = rows.orderBy(shuffle_key(key, seed + start), key).limit(k).select(FEATURES).collect()
        centers = np.zeros((k, n_terms))
        for i, row in enumerate(first):
            centers[i] = row[0].toArray()
        current[start] = centers
    done: dict[int, KMeansModel] = {}
    for round_no in range(1, max_rounds + 1):
        active = sorted(set(current) - set(done))
        if not active:
            break

        def memberships(x: SparseBatch) -> np.ndarray:
            return np.hstack([np.eye(k)[_nearest(x, current[s])] for s in active])

        sums, inner, squares = _sums(rows, n_terms, k * len(active), memberships)
        sizes = np.diag(inner)
        for i, s in enumerate(active):
            own, n, c = sums[:, i * k : (i + 1) * k].T, sizes[i * k : (i + 1) * k], current[s]
            inertia = squares - 2 * float((own * c).sum()) + float((n * (c * c).sum(axis=1)).sum())
            # A cluster that lost all its rows keeps its centre.
            moved = np.where(n[:, None] > 0, np.round(own / np.maximum(n, 1)[:, None], digits), c)
            if np.array_equal(moved, c) or round_no == max_rounds:
                done[s] = KMeansModel(c, inertia, round_no)
            current[s] = moved
    return min(done.values(), key=lambda m: round(m.inertia, 6))


@dataclass(frozen=True)
class Batches:
    """Rows in a table that is cut into batches by hash of the key, so that a round reads the files of one batch."""

    rows: DataFrame
    key: str
    n_terms: int
    batches: int
    seed: int

    @staticmethod
    def of(rows: DataFrame, key: str, n_terms: int, batches: int, seed: int) -> Batches:
        number = _share(key, seed, 1) % batches
        path = new_stage(rows.sparkSession)
        rows.select(key, FEATURES, number.cast("int").alias("_batch")).write.partitionBy("_batch").parquet(path)
        schema = T.StructType([rows.schema[key], rows.schema[FEATURES], T.StructField("_batch", T.IntegerType())])
        return Batches(rows.sparkSession.read.schema(schema).parquet(path), key, n_terms, batches, seed)

    def batch(self, number: int) -> DataFrame:
        return self.rows.filter(F.col("_batch") == number)


def _share(key: str, seed: int, start: int) -> Column:
    """Eight hexadecimal digits of a row's hash as a number."""
    return F.conv(F.substring(shuffle_key(key, seed), start, 8), 16, 10).cast("bigint")


def _distances(x: SparseBatch, centers: np.ndarray) -> np.ndarray:
    """Squared distance of each row to its nearest centre, rounded as ``_nearest`` rounds."""
    squares = np.bincount(x.rows, x.values * x.values, x.height)
    scores = x.times(centers.T) - 0.5 * (centers * centers).sum(axis=1)
    return np.maximum(squares - 2 * np.round(scores, 9).max(axis=1), 0.0)


def _drawn(data: Batches, centers: np.ndarray, wanted: float, round_no: int) -> np.ndarray:
    """Rows drawn as further candidates: each by its squared distance to the candidates, ``wanted`` of them on average."""

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        far = sum(float(_distances(SparseBatch.of(batch.column(0)), centers).sum()) for batch in cut(batches))
        yield pa.RecordBatch.from_arrays([pa.array([float(far)])], ["far"])

    far = data.rows.select(FEATURES).mapInArrow(total, "far double").agg(F.sum("far")).first()[0]
    if not far:
        return centers[:0]
    draw = _share(data.key, data.seed + round_no, 9)

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut(batches, 1):
            chance = wanted * _distances(SparseBatch.of(batch.column(1)), centers) / far
            hit = (batch.column(2).to_numpy() + 0.5) / 2**32 < chance
            yield batch.select([0, 1]).filter(pa.array(hit))

    rows = data.rows.select(data.key, FEATURES, draw.alias("_draw"))
    schema = T.StructType([rows.schema[data.key], rows.schema[FEATURES]])
    order = [shuffle_key(data.key, data.seed + round_no), data.key]
    found = rows.mapInArrow(chosen, schema).orderBy(*order).collect()
    return np.array([row[1].toArray() for row in found]).reshape(-1, centers.shape[1])


def oversampled_start(data: Batches, k: int, rounds: int = 3, oversampling: float = 2.0) -> np.ndarray:
    """Start centres by oversampling (k-means||): a few rounds draw about ``oversampling * k`` candidates each, all over the data.

    Each candidate weighs as many rows as it is nearest to. The first centre is the heaviest candidate, each next one that of the
    greatest weight times squared distance to the centres before it; ties go to the candidate drawn first. The driver
    holds the candidates, about ``1 + rounds * oversampling * k`` rows.
    """
    first = data.rows.orderBy(shuffle_key(data.key, data.seed), data.key).limit(1).select(FEATURES).collect()
    candidates = np.array([row[0].toArray() for row in first]).reshape(-1, data.n_terms)
    for round_no in range(1, rounds + 1 if len(first) else 0):
        candidates = np.vstack([candidates, _drawn(data, candidates, oversampling * k, round_no)])
    if not len(candidates):
        return np.zeros((k, data.n_terms))
    weights = np.diag(_sums(data.rows, data.n_terms, len(candidates), lambda x: np.eye(len(candidates))[_nearest(x, candidates)])[1])
    chosen = [int(weights.argmax())]
    nearest = ((candidates - candidates[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < k:
        chosen.append(int(np.round(weights * nearest, 9).argmax()))
        nearest = np.minimum(nearest, ((candidates - candidates[chosen[-1]]) ** 2).sum(axis=1))
    return candidates[chosen]


def fit_minibatch_kmeans(
    rows: DataFrame, key: str, n_terms: int, k: int, seed: int = 42, batches: int = 8, epochs: int = 2,
    start_rounds: int = 3, oversampling: float = 2.0, digits: int = 9,
) -> KMeansModel:
    """Mini-batch k-means with a learning rate per centre, from an oversampled start.

    The rows are cut into ``batches`` parts by hash of the key. Each round takes the next part: its rows go to their nearest centres, and a centre
    moves towards the mean of its new rows by their share of all rows it has been given so far. One job a round reads one part's files, so the
    number of jobs is ``batches * epochs`` for any number of rows. Centres are rounded to ``digits``, so the result does not depend on how rows
    lie in partitions. A centre without rows in a part stays; without rows at all, centres are zero. Rows with one key are in one part.
    """
    data = Batches.of(rows, key, n_terms, batches, seed)
    centers = np.round(oversampled_start(data, k, start_rounds, oversampling), digits)
    given = np.zeros(k)
    for step in range(batches * epochs):
        current = centers
        sums, inner, _ = _sums(data.batch(step % batches), n_terms, k, lambda x: np.eye(k)[_nearest(x, current)])
        fresh = np.diag(inner)
        given = given + fresh
        moved = centers + (sums.T - fresh[:, None] * centers) / np.maximum(given, 1)[:, None]
        centers = np.where(fresh[:, None] > 0, np.round(moved, digits), centers)
    sums, inner, squares = _sums(data.rows, n_terms, k, lambda x: np.eye(k)[_nearest(x, centers)])
    inertia = squares - 2 * float((sums.T * centers).sum()) + float((np.diag(inner) * (centers * centers).sum(axis=1)).sum())
    return KMeansModel(centers, inertia, batches * epochs)


def kmeans_topics(
    df: DataFrame,
    key: str,
    text: str,
    stop_words: Sequence[str],
    k: int = 12,
    seed: int = 42,
    min_df: int = 10,
    max_df: float = 0.4,
    max_features: int = 10_000,
    top: int = 15,
    example_count: int = 4,
    batches: int = 8,
    epochs: int = 2,
    shown: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Cluster texts by mini-batch k-means: a summary per cluster and the cluster of every row.

    The summary's ``examples`` are the first rows of a cluster by key, as structs of the key and the ``shown`` columns (the
    text when none are named).
    """
    tfidf, rows = _vectors(df, key, text, stop_words, max_features, min_df, max_df)
    model = fit_minibatch_kmeans(rows, key, len(tfidf.terms), k, seed, batches, epochs)
    assigned = model.assign(rows, key)
    names = {i: _top_terms(center, tfidf.terms, top) for i, center in enumerate(model.centers)}
    firsts = first_rows(assigned, ["cluster_id"], [key], example_count, keep="_rank")
    examples = _examples(firsts, df, "cluster_id", key, shown or [text])
    return _summary(assigned, "cluster_id", names, examples, tfidf.rows), assigned


def _vectors(df: DataFrame, key: str, text: str, stop_words: Sequence[str], max_features: int, min_df: int, max_df: float):
    """The fitted vocabulary and a written table (key, vector) of all rows."""
    words = tokens(df, key, modelling_text(F.col(text)), stop_words, WORDS)
    tfidf = fit_tfidf(words, WORDS, max_features, min_df, max_df, stop_words)
    return tfidf, materialize(tfidf.vectors(words, WORDS, FEATURES).select(key, FEATURES))


@dataclass(frozen=True)
class NmfModel:
    """Topic-term matrix; a row's topic weights are its non-negative least-squares fit."""

    components: np.ndarray
    terms: list[str]
    objective: list[float]

    def topic_weights(self, rows: DataFrame, key: str) -> DataFrame:
        """(key, topic_id, weight, weights): the dominant topic, counted from 1, its weight, and all weights in order.

        Each row is solved once. The first topic wins a tie, also when nothing matched.
        """
        h = self.components
        gram = h @ h.T

        def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in cut(batches, 1):
                w = nonnegative_fit(SparseBatch.of(batch.column(1)).times(h.T), gram)
                best = w.argmax(axis=1)
                offsets = pa.array(np.arange(0, w.size + 1, w.shape[1]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(best + 1, pa.int32()),
                        pa.array(w[np.arange(len(best)), best]),
                        pa.ListArray.from_arrays(offsets, pa.array(w.ravel())),
                    ],
                    [key, "topic_id", "weight", "weights"],
                )

        kind = rows.schema[key].dataType.simpleString()
        schema = f"`{key}` {kind}, topic_id int, weight double, weights array<double>"
        return rows.select(key, FEATURES).mapInArrow(solve, schema)


def nonnegative_fit(projected: np.ndarray, gram: np.ndarray, sweeps: int = 100, tol: float = 1e-8) -> np.ndarray:
    """Rows w >= 0 minimising |x - wH|, given xH' and HH', by coordinate descent."""
    w = np.zeros_like(projected)
    scale = np.maximum(np.diag(gram), 1e-12)
    for _ in range(sweeps):
        moved = 0.0
        for j in range(len(scale)):
            new = np.maximum(0.0, w[:, j] + (projected[:, j] - w @ gram[:, j]) / scale[j])
            moved = max(moved, np.abs(new - w[:, j]).max(initial=0.0))
            w[:, j] = new
        if moved < tol:
            break
    return w


def hashed_start(terms: Sequence[str], k: int, seed: int = 42) -> np.ndarray:
    """A topic-term matrix between 0 and 1 that follows from the terms alone, for runs that are to be repeated elsewhere."""
    digest = lambda topic, term: hashlib.md5(f"{seed}:{topic}:{term}".encode()).hexdigest()
    return np.array([[(int(digest(j + 1, t)[:8], 16) + 1) / 2**32 for t in terms] for j in range(k)])


def fit_nmf(
    rows: DataFrame, terms: Sequence[str], k: int = 8, max_iter: int = 200, tol: float = 1e-5, seed: int = 42,
    start: np.ndarray | None = None, sweeps: int = 100, fit_tol: float = 1e-8,
) -> NmfModel:
    """Alternating non-negative least squares over a table of sparse vectors.

    The topic-term matrix H is k x vocabulary and lives on the driver. One Spark job per round fits the
    topic weights W of each batch and sums W'X and W'W per term; only those sums, one row per term,
    come back. The start follows the non-negative double SVD of the data, found by subspace iteration
    with the same kind of job, or is ``start``. Stops when the squared error falls by less than ``tol`` of itself. ``sweeps`` and ``fit_tol``
    bound the coordinate descent of one fit.
    """
    n_terms = len(terms)
    h = _svd_start(rows, n_terms, k, seed) if start is None else start
    history: list[float] = []
    for _ in range(max_iter):
        gram = h @ h.T
        current = h

        def fitted(x: SparseBatch) -> np.ndarray:
            return nonnegative_fit(x.times(current.T), gram, sweeps, fit_tol)

        wx, ww, xx = _sums(rows, n_terms, k, fitted)
        history.append(xx - 2 * float((wx * h.T).sum()) + float((ww * gram).sum()))
        h = nonnegative_fit(wx, ww, sweeps, fit_tol).T
        if len(history) > 1 and history[-2] - history[-1] <= tol * max(history[-2], 1e-12):
            break
    return NmfModel(h, list(terms), history)


def factor_residuals(model: NmfModel, rows: DataFrame, key: str) -> DataFrame:
    """(factor, topic_id, residual): how far the factors are from optimal, computed by joins from factors written as tables.

    A factor is optimal for the other when the gradient of the squared error is zero where it is positive, and not negative where it
    is zero. ``residual`` is the largest violation among a topic's row weights (``rows``) or term weights (``terms``), as a share of the
    largest entry of the data's projection on the other factor. Rows of one key must be one row. Sums are taken per row and
    per term; what reaches the driver is k x k.
    """
    k = len(model.components)
    names = [f"t{j}" for j in range(k)]
    spark = rows.sparkSession

    def exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut(batches, 1):
            x = SparseBatch.of(batch.column(1))
            columns = [batch.column(0).take(pa.array(x.rows)), pa.array(x.columns, pa.int32()), pa.array(x.values)]
            yield pa.RecordBatch.from_arrays(columns, [key, "term", "x"])

    kind = rows.schema[key].dataType.simpleString()
    entries = materialize(rows.select(key, FEATURES).mapInArrow(exploded, f"`{key}` {kind}, term int, x double"))
    weights = model.topic_weights(rows, key)
    weights = materialize(weights.select(key, *[F.get("weights", j).alias(n) for j, n in enumerate(names)]))
    pairs = [(t, *column) for t, column in enumerate(model.components.T.tolist())]
    loadings = spark.createDataFrame(pairs, "term int, " + ", ".join(f"{n} double" for n in names))

    def violations(factor: str, own: DataFrame, other: DataFrame, on: str, across: str) -> DataFrame:
        inner = other.agg(*[F.coalesce(F.sum(F.col(a) * F.col(b)), F.lit(0.0)) for a in names for b in names]).first()
        projected = entries.join(other, across).groupBy(on).agg(*[F.sum(F.col("x") * F.col(n)).alias(f"p_{n}") for n in names])
        both = own.join(projected, on, "left").fillna(0.0, [f"p_{n}" for n in names])
        out = []
        for j, n in enumerate(names):
            gradient = sum((F.col(m) * float(inner[i * k + j]) for i, m in enumerate(names)), F.lit(0.0)) - F.col(f"p_{n}")
            out.append(F.max(F.when(F.col(n) > 0, F.abs(gradient)).otherwise(F.greatest(-gradient, F.lit(0.0)))).alias(n))
        largest = F.max(F.greatest(*[F.abs(f"p_{n}") for n in names], F.lit(0.0)))
        worst = both.agg(*out, largest.alias("largest"))
        rows_of = F.array(*[F.struct(F.lit(j + 1).cast("bigint").alias("topic_id"), F.col(n).alias("v")) for j, n in enumerate(names)])
        return worst.select(F.lit(factor).alias("factor"), F.inline(rows_of), "largest").select(
            "factor", "topic_id", F.coalesce(F.col("v") / F.nullif("largest", F.lit(0.0)), F.lit(0.0)).alias("residual")
        )

    return violations("rows", weights, loadings, key, "term").unionByName(violations("terms", loadings, weights, "term", key))


def _sums(
    rows: DataFrame, n_terms: int, width: int, project: Callable[[SparseBatch], np.ndarray]
) -> tuple[np.ndarray, np.ndarray, float]:
    """X'F, F'F and the squared sum of X, where F = project(X) is computed batch by batch."""
    names = [f"c{j}" for j in range(width)]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cross, inner, squares = np.zeros((n_terms, width)), np.zeros((width, width)), 0.0
        for batch in cut(batches):
            x = SparseBatch.of(batch.column(0))
            f = project(x)
            cross += x.transposed_times(f, n_terms)
            inner += f.T @ f
            squares += float(x.values @ x.values)
        used = np.flatnonzero(cross.any(axis=1))
        # Row numbers beyond the vocabulary carry the inner products and the squared sum.
        tail = np.zeros((1, width))
        tail[0, 0] = squares
        block = np.vstack([cross[used], inner, tail])
        numbers = np.concatenate([used, np.arange(n_terms, n_terms + width + 1)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(numbers, pa.int32()), *[pa.array(block[:, j]) for j in range(width)]], ["row", *names]
        )

    summed = (
        rows.select(FEATURES)
        .mapInArrow(partial, "row int, " + ", ".join(f"{n} double" for n in names))
        .groupBy("row")
        .agg(*[F.sum(n).alias(n) for n in names])
        .toPandas()
    )
    out = np.zeros((n_terms + width + 1, width))
    out[summed["row"].to_numpy()] = summed[names].to_numpy()
    return out[:n_terms], out[n_terms : n_terms + width], float(out[-1, 0])


def _svd_start(rows: DataFrame, n_terms: int, k: int, seed: int, rounds: int = 4, extra: int = 10) -> np.ndarray:
    """Non-negative start from the leading singular vectors."""
    width = min(k + extra, n_terms)
    basis = np.linalg.qr(np.random.RandomState(seed).normal(size=(n_terms, width)))[0]
    for _ in range(rounds):
        basis = np.linalg.qr(_project_back(rows, basis)[0])[0]
    small = _project_back(rows, basis)[1]
    values, vectors = np.linalg.eigh(small)
    order = np.argsort(-values)[:k]
    singular = np.sqrt(np.maximum(values[order], 0.0))
    right = basis @ vectors[:, order]

    # Squared lengths of the positive and negative parts of the left vectors, summed over all rows.
    left = right / np.maximum(singular, 1e-12)
    parts = len(order)

    def halves(x: SparseBatch) -> np.ndarray:
        u = x.times(left)
        return np.hstack([np.maximum(u, 0.0), np.maximum(-u, 0.0)])

    squared = np.diag(_sums(rows, n_terms, 2 * parts, halves)[1])
    start = np.full((k, n_terms), 1e-6)
    for j in range(parts):
        plus, minus = np.maximum(right[:, j], 0.0), np.maximum(-right[:, j], 0.0)
        weight_plus = np.sqrt(squared[j]) * np.linalg.norm(plus)
        weight_minus = np.sqrt(squared[parts + j]) * np.linalg.norm(minus)
        side = plus if weight_plus >= weight_minus else minus
        length = np.linalg.norm(side)
        if length > 0:
            start[j] = np.sqrt(singular[j] * max(weight_plus, weight_minus)) * side / length
    return start


def _project_back(rows: DataFrame, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cross, inner, _ = _sums(rows, basis.shape[0], basis.shape[1], lambda x: x.times(basis))
    return cross, inner


def nmf_topics(
    df: DataFrame,
    key: str,
    text: str,
    stop_words: Sequence[str],
    k: int = 8,
    seed: int = 42,
    min_df: int = 5,
    max_df: float = 0.5,
    max_features: int = 12_000,
    max_iter: int = 200,
    tol: float = 1e-5,
    top: int = 15,
    example_count: int = 4,
    shown: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Topics of the texts: a summary per topic and the dominant topic of every row.

    The summary's ``examples`` are the rows of largest weight (ties by key), as structs of the key and the ``shown``
    columns (the text when none are named).
    """
    tfidf, rows = _vectors(df, key, text, stop_words, max_features, min_df, max_df)
    model = fit_nmf(rows, tfidf.terms, k, max_iter, tol, seed)
    solved = materialize(model.topic_weights(rows, key))
    assigned = solved.select(key, "topic_id")
    names = {i + 1: _top_terms(h, tfidf.terms, top) for i, h in enumerate(model.components)}
    weights = solved.select(key, F.posexplode("weights").alias("_at", "_weight")).filter("_weight > 0")
    weights = weights.select(key, (F.col("_at") + 1).alias("topic_id"), "_weight")
    heaviest = first_rows(weights, ["topic_id"], [F.round("_weight", 9).desc(), F.col(key)], example_count, keep="_rank")
    examples = _examples(heaviest.drop("_weight"), df, "topic_id", key, shown or [text])
    return _summary(assigned, "topic_id", names, examples, tfidf.rows), assigned
