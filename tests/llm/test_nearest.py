"""Top-k search against scoring every pair."""

import math
import random

import numpy as np

from replyloom.llm import nearest

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT, row STRING, block STRING"


def expected(rows, k):
    usable = []
    for i, (vec_id, v, *_) in enumerate(rows):
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            usable.append((i, vec_id, [math.floor(64 * x) for x in v]))
    out = []
    for i, query_id, q in usable:
        if query_id is None or query_id % 20:
            continue
        scored = [(-sum(a * b for a, b in zip(q, v)), math.inf if d is None else d, d) for j, d, v in usable if j != i and len(v) == len(q)]
        out += [(query_id, n + 1, s[2], -s[0]) for n, s in enumerate(sorted(scored, key=lambda s: s[:2])[:k])]
    return sorted(out, key=repr)


def vectors(n=400, dim=6):
    rng = random.Random(8)
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(5)]
    f32 = lambda x: np.float32(x).item()
    rows = [(i, [f32(c + rng.gauss(0, 0.2)) for c in centres[i % 5]], i % 5, "r", "b") for i in range(n)]
    rows += [(20, rows[40][1], 0, None, None), (None, rows[3][1], None, None, None), (500, None, 1, "r", "b")]
    rows += [(520, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1, "r", "b"), (540, [float("nan")] * dim, 1, "r", "b"), (560, [float("inf")] * dim, 1, "", "")]
    rows += [(580, [0.5, 0.25], 1, "r", "b"), (581, [0.5, 0.5], 1, "r", "b"), (600, [], 1, "r", "b"), (620, rows[7][1], 1, "r", "b")]
    return rows


def test_against_all_pairs(spark):
    rows = vectors()
    frame = spark.createDataFrame(rows, SCHEMA)
    for block_rows, k in ((4096, 20), (16, 20), (16, 3)):
        found = nearest.top_k(frame, k=k, block_rows=block_rows, pivots=8).collect()
        assert sorted(((r.query_id, r["rank"], r.vec_id, r.score) for r in found), key=repr) == expected(rows, k)


def test_equal_vectors_tie_to_smaller_ids(spark):
    rows = [(i, [1.0, -0.5], 0, "r", "b") for i in range(60)]
    found = nearest.top_k(spark.createDataFrame(rows, SCHEMA), block_rows=7).collect()
    assert sorted(((r.query_id, r["rank"], r.vec_id, r.score) for r in found), key=repr) == expected(rows, 20)


def test_empty(spark):
    assert nearest.top_k(spark.createDataFrame([], SCHEMA)).count() == 0
    assert nearest.top_k(spark.createDataFrame([(0, None, 0, "r", "b")], SCHEMA)).count() == 0
