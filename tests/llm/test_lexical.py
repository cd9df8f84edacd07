"""Ranked search against scoring every document."""

import math
import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from replyloom.llm import lexical

DOCS = "doc_id BIGINT, text STRING"
ITEMS = "item_id BIGINT, text STRING"


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return Counter(w for w in re.split("[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", lowered) if w)


def expected(documents, items, k=10):
    counted = [(d, words(t)) for d, t in documents]
    counted = [(d, c, sum(c.values())) for d, c in counted if c]
    number, length = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc_id, counts, n in counted:
            m = 10 + (90 * n * number) // length
            score = 0
            for t in words(text):
                if counts[t]:
                    w = math.floor(1000 * math.log((2 * number + 2) / (2 * df[t] + 1)))
                    score += w * ((10**9 * counts[t]) // (1000 * counts[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        out += [(item, r + 1, None if null else d, -s) for r, (s, null, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def corpus(seed, size=400):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["ÉÀ", "Straße", "x1Y"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    documents = []
    for i in range(size):
        length = rng.choice([3, 20, 20, 80, 400])
        documents.append((i, rng.choice([" ", ", ", "-"]).join(rng.choices(vocabulary, weights, k=length)).title()))
    items = [(j, " ".join(rng.choices(vocabulary, weights, k=rng.randint(1, 30)))) for j in range(30)]
    for j in range(5):
        text = documents[rng.randrange(size)][1]
        items.append((100 + j, text[:150]))
        documents += [(1000 + 20 * j + c, text) for c in range(j * 5)]
    return documents, items


def got(spark, documents, items, k=10):
    found = lexical.ranked_documents(spark.createDataFrame(documents, DOCS).repartition(3), spark.createDataFrame(items, ITEMS), k)
    return sorted((tuple(r) for r in found.collect()), key=repr)


@pytest.mark.parametrize("k", [1, 10])
def test_against_all_documents(spark, k):
    documents, items = corpus(k)
    assert got(spark, documents, items, k) == expected(documents, items, k)


def test_small_blocks_shards_groups_and_parts(spark, monkeypatch):
    documents, items = corpus(7, 150)
    for name, value in (("BLOCK", 3), ("SHARD_POSTINGS", 200), ("QUERY_GROUP", 4), ("QUERY_CHARS", 900), ("WINDOW", 50)):
        monkeypatch.setattr(lexical, name, value)
    assert got(spark, documents, items) == expected(documents, items)


def search(documents, items, k):
    """Both passes over one shard, and the blocks seen and skipped by the second."""
    queries = lexical.read_queries(items, k)
    counted = [(d, lexical.term_counts(t)) for d, t in documents]
    rows = [
        (d, sum(c.values()), [queries.vocabulary[t] for t in c if t in queries.vocabulary], [n for t, n in c.items() if t in queries.vocabulary])
        for d, c in counted if c
    ]
    rows = [r for r in rows if r[2]]
    queries.documents, queries.length = sum(1 for _, c in counted if c), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for r in rows for t in r[2])
    weights = [math.floor(1000 * math.log((2 * queries.documents + 2) / (2 * df[t] + 1))) for t in range(len(queries.vocabulary))]
    queries.weights = lexical.np.array(weights, dtype=lexical.np.int64)
    types = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64())]
    table = pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["key", "n", "terms", "tfs"])
    shard, best = lexical.Shard.of(table, queries), lexical.Best(queries)
    queries.probes = [t[lexical.np.argsort([df[x] for x in t.tolist()])][:3] for t in queries.terms]
    lexical.probe(shard, queries, best)
    again = lexical.Best(queries)
    again.least = best.least
    return lexical.search_shard(shard, queries, again), again


def test_blocks_are_skipped_and_summaries_bound(monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK", 8)
    documents, items = corpus(3, 1500)
    (seen, skipped), best = search(documents, items, 10)
    assert skipped > seen / 5
    found = sorted(
        ((items[q][0], r + 1, key, -score) for q, held in enumerate(best.held) for r, (score, _, key) in enumerate(held)), key=repr
    )
    assert found == expected(documents, items)


def test_odd_rows(spark, make, odd_rows):
    documents = make(odd_rows).withColumnRenamed("_key", "a.b").withColumnRenamed("size", "query")
    items = spark.createDataFrame([(1, "TO two words"), (2, None), (3, ""), (4, "absent"), (1, "TO two words"), (None, "one 世界")], ITEMS)
    found = sorted((tuple(r) for r in lexical.ranked_documents(documents, items).collect()), key=repr)
    assert found == expected([r[:2] for r in odd_rows], [tuple(r) for r in items.collect()])
    assert lexical.ranked_documents(make([]), items).count() == 0
    assert lexical.ranked_documents(documents, items.limit(0)).count() == 0


def test_windows_do_not_change_terms(monkeypatch):
    text = "Ab cd-é" * 40 + "x" * 90 + " y"
    whole = lexical.term_counts(text)
    for window in (1, 3, 20):
        monkeypatch.setattr(lexical, "WINDOW", window)
        assert lexical.term_counts(text) == whole == words(text)
