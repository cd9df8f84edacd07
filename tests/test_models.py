import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.linalg import SparseVector
from pyspark.sql import functions as F

from replyloom.functions.vectors import SparseBatch, cut
from replyloom.operators import classifiers, features, profile, topics

TEXTS = [
    "battery dies fast battery", "battery drains fast", "screen cracked badly", "screen cracked glass",
    "wifi drops", "wifi drops again", "the battery", "", "é_1 wifi wifi wifi",
]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id long, t string")


def by_hand(stop, min_df, max_df, limit):
    def terms(t):
        words = [w for w in __import__("re").findall(r"\w\w+", t.lower()) if w not in stop]
        return words + [f"{a} {b}" for a, b in zip(words, words[1:])]

    docs = [terms(t) for t in TEXTS]
    df = {t: sum(t in d for d in docs) for d in docs for t in d}
    tf = {t: sum(d.count(t) for d in docs) for t in df}
    kept = [t for t in df if min_df <= df[t] <= max_df * len(docs)]
    kept = sorted(sorted(kept, key=lambda t: (-tf[t], t))[:limit])
    out = {}
    for i, d in enumerate(docs):
        raw = {t: d.count(t) * (math.log((1 + len(docs)) / (1 + df[t])) + 1) for t in kept if t in d}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        out |= {(i, t): w / norm for t, w in raw.items()}
    return kept, out


@pytest.mark.parametrize("min_df, max_df, limit", [(1, 1.0, 100), (2, 0.4, 100), (1, 1.0, 5)])
def test_tfidf_by_hand(texts, min_df, max_df, limit):
    model = features.fit_tfidf(texts, "t", limit, min_df, max_df, ["the"])
    kept, expected = by_hand({"the"}, min_df, max_df, limit)
    assert model.terms == kept
    got = {(r.id, r.term): r.weight for r in model.weights(texts, "id", "t").collect()}
    assert got == pytest.approx(expected, abs=1e-12)
    assert model.vectors(texts, "t").count() == len(TEXTS)


def test_a_task_works_on_a_bounded_number_of_words(monkeypatch):
    """One batch of long rows: whatever their length, few words are counted at once, and the counts stay."""
    words = [[f"w{i % 7}", f"v{i}"] * 300 for i in range(40)] + [None, [], ["one"] * 5000]
    batch = pa.record_batch({"words": pa.array(words, pa.list_(pa.string()))})
    seen, runs = [], features.placed_runs
    monkeypatch.setattr(features, "placed_runs", lambda column, n: (seen.append(len(column.flatten())), runs(column, n))[1])
    monkeypatch.setattr(features, "cut", lambda batches: cut(batches, 0, 2000))
    tables = [t.to_pandas() for t in features._counted(iter([batch]), 2)]
    assert max(seen) == 5000 and sorted(seen)[-3] <= 2000 and sum(seen) == 2 * (40 * 600 + 5000)
    got = {r.term: (r.tf, r.df) for t in tables for r in t.itertuples()}
    assert got["w3"] == (6 * 300, 6) and got["w3 v3"] == (300, 1) and got["one one"] == (4999, 1) and got[None] == (43, 0)


def test_slices_of_vectors_hold_the_same_numbers():
    kind = pa.struct([("type", pa.int8()), ("size", pa.int32()), ("indices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64()))])
    rows = [{"type": 0, "size": 9, "indices": list(range(n)), "values": [float(i + n) for i in range(n)]} for n in (3, 0, 8, 1, 2, 2)]
    rows.append({"type": 1, "size": 4, "indices": None, "values": [4.0, 3.0, 2.0, 1.0]})
    batch = pa.record_batch({"key": pa.array(range(7)), "v": pa.array(rows, kind)})
    parts = list(cut(iter([batch, batch.slice(7)]), 1, 5))
    assert [p.num_rows for p in parts] == [2, 1, 3, 1] and [k for p in parts for k in p.column(0).to_pylist()] == list(range(7))
    whole, at, dense = SparseBatch.of(batch.column(1)), 0, np.arange(18.0).reshape(9, 2)
    for part in parts:
        x = SparseBatch.of(part.column(1))
        assert (x.times(dense) == whole.times(dense)[at : at + x.height]).all()
        at += x.height


def test_class_weights(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)], "intent string")
    assert {r.intent: r.weight for r in features.class_weights(df).collect()} == {"a": 4 / 6, "b": 2.0}


def test_logistic_regression_is_the_penalised_optimum(spark):
    rng = np.random.RandomState(0)
    words = {"a": ["red", "rose"], "b": ["blue", "sky"], "c": ["green", "leaf"]}
    rows = [(i, c, " ".join([*rng.choice(words[c], 3), rng.choice(["one", "two", "red"])])) for i, c in enumerate("aabbbc" * 10)]
    train = spark.createDataFrame(rows, "id long, intent string, t string")
    model = classifiers.fit_tfidf_logistic(train, "t", "intent", ["a", "b", "c", "never"], [], min_df=1, max_df=1.0)
    assert model.labels == ["a", "b", "c"]
    scored = model.predict(train, "t")
    assert scored.filter("intent = predicted_intent").count() >= 58
    # The gradient of mean weighted loss + |w|^2 / (2 n) vanishes at the solution.
    vectors = np.array([r.features.toArray() for r in model.tfidf.vectors(train, "t").orderBy("id").collect()])
    labels = np.array([model.labels.index(c) for _, c, _ in rows])
    counts = np.bincount(labels)
    weight = len(rows) / (len(counts) * counts[labels])
    w, b = model.logistic.coefficientMatrix.toArray(), model.logistic.interceptVector.toArray()
    scores = vectors @ w.T + b
    p = np.exp(scores - scores.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    delta = (p - np.eye(3)[labels]) * weight[:, None] / weight.sum()
    assert np.abs(delta.T @ vectors + w / len(rows)).max() < 1e-3
    assert np.abs(delta.sum(axis=0)).max() < 1e-3


def test_centroids(spark):
    rng = np.random.RandomState(1)
    rows = []
    for i in range(60):
        v = np.eye(5)[i % 3] + 0.2 * rng.normal(size=5)
        rows.append((i, i % 3, (v / np.linalg.norm(v)).tolist()))
    df = spark.createDataFrame(rows, "id long, label int, embedding array<float>")
    model = classifiers.fit_centroids(df, ["0", "1", "2", "9"])
    assert model.labels == ["0", "1", "2"]
    vectors = np.array([np.float32(r[2]) for r in rows], dtype=float)
    centers = np.array([vectors[k::3].mean(axis=0) for k in range(3)])
    centers /= np.linalg.norm(centers, axis=1, keepdims=True)
    scores = vectors @ centers.T
    got = sorted(model.predict(df).collect(), key=lambda r: r.id)
    assert [r.predicted_intent for r in got] == [str(k) for k in scores.argmax(axis=1)]
    assert [r.confidence for r in got] == pytest.approx(scores.max(axis=1).tolist(), abs=1e-6)
    stats = profile.confidence_stats(model.predict(df)).first()
    assert stats["std"] == pytest.approx(scores.max(axis=1).std(), abs=1e-5)


def dense_nmf(x, h, rounds):
    for _ in range(rounds):
        w = topics.nonnegative_fit(x @ h.T, h @ h.T)
        h = topics.nonnegative_fit((w.T @ x).T, w.T @ w).T
    return h


def test_nmf_matches_a_dense_run(spark):
    rng = np.random.RandomState(5)
    x = np.maximum(rng.rand(40, 3) @ rng.rand(3, 12) - 0.4, 0)
    x[7] = 0
    rows = [(i, SparseVector(12, {j: float(v) for j, v in enumerate(r) if v})) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, ["id", topics.FEATURES]).repartition(3)
    terms = [f"t{j:02d}" for j in range(12)]
    start = topics._svd_start(df, 12, 3, 42)
    model = topics.fit_nmf(df, terms, 3, max_iter=6, tol=0)
    assert model.components == pytest.approx(dense_nmf(x, start, len(model.objective)), abs=1e-6)
    assert all(a >= b - 1e-9 for a, b in zip(model.objective, model.objective[1:]))
    # As good as the best of several long dense runs from random starts.
    def error(h):
        return ((x - topics.nonnegative_fit(x @ h.T, h @ h.T) @ h) ** 2).sum()

    rivals = [error(dense_nmf(x, rng.rand(3, 12), 200)) for _ in range(5)]
    assert error(topics.fit_nmf(df, terms, 3, max_iter=100, tol=1e-7).components) <= 1.05 * min(rivals)
    w = topics.nonnegative_fit(x @ model.components.T, model.components @ model.components.T)
    got = sorted(model.topic_weights(df, "id").collect(), key=lambda r: r.id)
    assert [r.topic_id for r in got] == (w.argmax(axis=1) + 1).tolist()
    assert np.array([r.weights for r in got]) == pytest.approx(w)
    assert [r.weight for r in got] == pytest.approx(w.max(axis=1).tolist())


def test_start_uses_the_leading_singular_vector(spark):
    x = np.array([[1.0, 2.0, 0.0], [2.0, 4.1, 0.0], [0.0, 0.0, 1.0]])
    rows = [(i, SparseVector(3, {j: float(v) for j, v in enumerate(r) if v})) for i, r in enumerate(x)]
    start = topics._svd_start(spark.createDataFrame(rows, ["id", topics.FEATURES]), 3, 2, 0)
    leading = np.abs(np.linalg.svd(x)[2][0])
    assert start[0] / np.linalg.norm(start[0]) == pytest.approx(leading, abs=1e-6)


@pytest.fixture(scope="module")
def themed(spark):
    rng = np.random.RandomState(2)
    themes = [["battery", "charger", "drain"], ["screen", "glass", "crack"], ["wifi", "router", "signal"]]
    rows = [(i, " ".join(rng.choice(themes[i % 3], 6))) for i in range(90)] + [(90, "zzz"), (91, None)]
    return spark.createDataFrame(rows, "id long, t string")


@pytest.mark.parametrize("build, group", [(topics.kmeans_topics, "cluster_id"), (topics.nmf_topics, "topic_id")])
def test_topics_find_the_themes(themed, build, group):
    summary, assigned = build(themed, "id", "t", ["the"], k=3, min_df=2)
    rows = summary.collect()
    assert sum(r["size"] for r in rows) == 92 and len(rows) == 3
    assert sum(r.pct for r in rows) == pytest.approx(100, abs=0.05)
    top = assigned.filter("id < 90").groupBy((F.col("id") % 3).alias("theme"), group).count().collect()
    assert sorted(r["count"] for r in top) == [30, 30, 30]
    first_words = {r.top_terms[0].split(" ")[0] for r in rows}
    assert len(first_words) == 3
    texts, groups = dict(themed.collect()), dict(assigned.collect())
    for r in rows:
        assert len(r.examples) == 4
        assert all(e.t == texts[e.id] and groups[e.id] == r[group] for e in r.examples)


def test_kmeans_matches_a_dense_run_for_any_layout(spark, themed):
    words = topics.tokens(themed, "id", F.col("t"), [], topics.WORDS)
    tfidf = topics.fit_tfidf(words, topics.WORDS, 50, 1, 1.0)
    rows = tfidf.vectors(words, topics.WORDS, topics.FEATURES).select("id", topics.FEATURES)
    n = len(tfidf.terms)
    models = [topics.fit_kmeans(rows.repartition(parts), "id", n, 4, starts=3) for parts in (1, 7)]
    assert np.array_equal(models[0].centers, models[1].centers) and models[0].rounds == models[1].rounds
    ordered = sorted(rows.collect(), key=lambda r: r.id)
    x = np.array([r[1].toArray() for r in ordered])
    found = {r.id: r.cluster_id for r in models[0].assign(rows, "id").collect()}
    labels = np.array([found[r.id] for r in ordered])
    distance = ((x[:, None, :] - models[0].centers[None]) ** 2).sum(axis=2)
    assert distance[np.arange(len(x)), labels] == pytest.approx(distance.min(axis=1), abs=1e-8)
    for k in set(labels.tolist()):
        assert models[0].centers[k] == pytest.approx(x[labels == k].mean(axis=0), abs=1e-8)
    assert models[0].inertia == pytest.approx(distance.min(axis=1).sum(), abs=1e-6)
    one = topics.fit_kmeans(rows, "id", n, 4, starts=1)
    assert models[0].inertia <= one.inertia + 1e-9


def dense_gradient(x, labels, weights, coefficients):
    scores = x @ coefficients.T
    p = np.exp(scores - scores.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    off = p - np.eye(coefficients.shape[0])[labels]
    penalty = coefficients.copy()
    penalty[:, -1] = 0
    return (off * weights[:, None]).T @ x + penalty


def test_newton_reaches_the_optimum(spark):
    rng = np.random.RandomState(8)
    labels = rng.choice(3, 240, p=[0.7, 0.2, 0.1])
    vectors = np.float32(rng.randn(240, 6) + 2 * np.eye(6)[labels])
    rows = [(i, int(k), v.tolist()) for i, (k, v) in enumerate(zip(labels, vectors))] + [(900, 7, [0.0] * 6), (901, None, [0.0] * 6)]
    df = spark.createDataFrame(rows, "id long, label int, embedding array<float>").repartition(4)
    model = classifiers.fit_newton_logistic(df, ["0", "1", "2", "9"])
    assert model.labels == ["0", "1", "2"] and model.rows == 240
    assert all(a >= b - 1e-9 for a, b in zip(model.losses, model.losses[1:])) and len(model.losses) < 12
    x = np.hstack([vectors.astype(float), np.ones((240, 1))])
    weights = 240 / (3 * np.bincount(labels))[labels]
    gradient = dense_gradient(x, labels, weights, model.coefficients)
    assert np.abs(gradient).max() < 1e-5 and model.gradient == pytest.approx(gradient, abs=1e-6)
    assert model.coefficients[:, -1].sum() == pytest.approx(0, abs=1e-6)
    assert all(r.within for r in classifiers.gradient_certificate(model, spark).collect())
    # No certificate for a model that was stopped early.
    early = classifiers.fit_newton_logistic(df, ["0", "1", "2"], max_steps=1)
    assert not all(r.within for r in classifiers.gradient_certificate(early, spark).collect())
    scores = x @ model.coefficients.T
    got = sorted(model.predict(df.filter("id < 240")).collect(), key=lambda r: r.id)
    assert [r.predicted_intent for r in got] == [str(k) for k in scores.argmax(axis=1)]
    p = np.exp(scores) / np.exp(scores).sum(axis=1, keepdims=True)
    assert [r.confidence for r in got] == pytest.approx(p.max(axis=1).tolist())


def test_newton_halves_steps_that_would_raise_the_loss(spark):
    """Far apart classes almost without a penalty: full steps overshoot, the loss still never rises."""
    rows = [(i, i % 2, [float((1 if i % 2 else -1) * (1 + i % 3) * 40), 1.0]) for i in range(30)]
    df = spark.createDataFrame(rows, "id long, label int, embedding array<float>")
    model = classifiers.fit_newton_logistic(df, ["0", "1"], inverse_penalty=1e6)
    assert all(a >= b - 1e-9 for a, b in zip(model.losses, model.losses[1:]))
    assert [r.predicted_intent for r in sorted(model.predict(df).collect(), key=lambda r: r.id)] == [str(i % 2) for i in range(30)]
    with pytest.raises(ValueError, match="no row"):
        classifiers.fit_newton_logistic(df, ["5"])


def test_minibatch_kmeans_matches_a_dense_run_for_any_layout(spark):
    rng = np.random.RandomState(4)
    x = np.round(np.vstack([rng.randn(60, 5) * 0.2 + c for c in np.eye(5)[:3] * 4]), 3)
    rows = [(i, SparseVector(5, {j: float(v) for j, v in enumerate(r)})) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, ["id", topics.FEATURES])
    fit = lambda parts: topics.fit_minibatch_kmeans(df.repartition(parts), "id", 5, 3, batches=4, epochs=2)
    model = fit(1)
    assert np.array_equal(model.centers, fit(6).centers)
    # Each found centre is the mean of its own group's rows in the order of the batches.
    data = topics.Batches.of(df, "id", 5, 4, 42)
    batch = {r.id: r._batch for r in data.rows.collect()}
    assert len(set(batch.values())) == 4
    centers, given = np.round(topics.oversampled_start(data, 3), 9), np.zeros(3)
    for step in range(8):
        own = [i for i in range(len(x)) if batch[i] == step % 4]
        near = np.round(x[own] @ centers.T - 0.5 * (centers**2).sum(axis=1), 9).argmax(axis=1)
        for k in range(3):
            mine = x[own][near == k]
            given[k] += len(mine)
            if len(mine):
                centers[k] = np.round(centers[k] + (mine.sum(axis=0) - len(mine) * centers[k]) / given[k], 9)
    assert model.centers == pytest.approx(centers, abs=1e-8)
    labels = {r.id: r.cluster_id for r in model.assign(df, "id").collect()}
    assert sorted({tuple(sorted(i for i in labels if labels[i] == k)) for k in range(3)}) == [tuple(range(60 * g, 60 * g + 60)) for g in range(3)]
    distance = ((x[:, None, :] - model.centers[None]) ** 2).sum(axis=2)
    assert model.inertia == pytest.approx(distance.min(axis=1).sum(), abs=1e-6)


def test_oversampled_start_spreads_over_far_groups(spark):
    """One group holds nearly all rows; the start still has a centre in every other one."""
    x = [[0.001 * (i % 7), 0.0] for i in range(400)] + [[9.0, 0.0], [9.1, 0.0], [0.0, 9.0], [0.0, 9.1]]
    rows = [(i, SparseVector(2, {0: float(a), 1: float(b)})) for i, (a, b) in enumerate(x)]
    start = topics.oversampled_start(topics.Batches.of(spark.createDataFrame(rows, ["id", topics.FEATURES]), "id", 2, 2, 42), 3)
    assert sorted((round(a), round(b)) for a, b in start) == [(0, 0), (0, 9), (9, 0)]


def test_minibatch_kmeans_of_nothing_and_of_one_row(spark):
    df = spark.createDataFrame([(1, SparseVector(2, {0: 1.0}))], ["id", topics.FEATURES])
    assert topics.fit_minibatch_kmeans(df.limit(0), "id", 2, 3).centers.tolist() == [[0.0, 0.0]] * 3
    assert topics.fit_minibatch_kmeans(df, "id", 2, 2).assign(df, "id").collect()[0].cluster_id == 0


def test_residuals_tell_optimal_factors_from_others(spark):
    rng = np.random.RandomState(6)
    x = np.maximum(rng.rand(30, 2) @ rng.rand(2, 8) - 0.2, 0)
    x[3] = 0
    rows = [(i, SparseVector(8, {j: float(v) for j, v in enumerate(r) if v})) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, ["id", topics.FEATURES]).repartition(3)
    terms = [f"t{j}" for j in range(8)]

    def dense(h):
        w = topics.nonnegative_fit(x @ h.T, h @ h.T, 2000, 1e-12)
        out = []
        for own, inner, projected in ((w, h @ h.T, x @ h.T), (h.T, w.T @ w, (w.T @ x).T)):
            slope = own @ inner - projected
            out += (np.where(own > 0, np.abs(slope), np.maximum(-slope, 0)).max(axis=0) / np.abs(projected).max()).tolist()
        return out

    for rounds in (1, 60):
        model = topics.fit_nmf(df, terms, 2, rounds, 0.0, start=topics.hashed_start(terms, 2), sweeps=2000, fit_tol=1e-12)
        found = {(r.factor, r.topic_id): r.residual for r in topics.factor_residuals(model, df, "id").collect()}
        got = [found[f, t] for f in ("rows", "terms") for t in (1, 2)]
        assert got == pytest.approx(dense(model.components), abs=1e-6)
        assert max(got[:2]) < 1e-6
        # Long runs end at a stationary point, one round does not.
        assert (max(got) < 1e-3) == (rounds == 60)
