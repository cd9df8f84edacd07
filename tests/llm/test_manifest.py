"""Merkle manifests against a plain recomputation."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from replyloom.llm import manifest


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(nodes, fan_out):
    """The top, and per leaf its steps (slot, digests of the run)."""
    steps = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[k : k + fan_out] for k in range(0, len(nodes), fan_out)]
        for leaf, place in enumerate(at):
            steps[leaf].append((place % fan_out, runs[place // fan_out]))
        nodes, at = [sha(*run) for run in runs], [place // fan_out for place in at]
    return nodes[0], steps


def expected(rows, fan_out=3):
    """rows: (doc_id, text, lang, source, n_chars)."""
    leaves = {}
    for doc_id, text, lang, source, n_chars in rows:
        own = sha(*map(field, (doc_id, source, lang, n_chars, text)))
        found = own
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0 and text is not None:
            found = sha(*map(field, (doc_id, source, lang, n_chars, text.replace("\n", ""))))
        leaves.setdefault(source, []).append((doc_id, own, found))
    names = sorted(leaves, key=lambda s: (s is not None, (s or "").encode()))
    for name in names:
        leaves[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    trees = [tree([r[1] for r in leaves[n]], fan_out) for n in names]
    root, upper = tree([t[0] for t in trees], fan_out)
    out = []
    for name, (subroot, steps), above in zip(names, trees, upper):
        for (doc_id, own, found), mine in zip(leaves[name], steps):
            path, digest = mine + above, found
            for slot, run in path:
                digest = sha(*[digest if k == slot else d for k, d in enumerate(run)])
            proof = sha(*[d for slot, run in path for k, d in enumerate(run) if k != slot])
            out.append((doc_id, own, subroot, root, proof, digest, digest == root))
    return sorted(map(repr, out))


def got(frame, fan_out=3):
    text = F.col("text")
    broken = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    now = F.when(broken, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)
    own, found = (manifest.leaf(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), t) for t in (text, now))
    rows = manifest.manifest(frame, own, found, fan_out=fan_out).collect()
    return sorted(repr(tuple(r)) for r in rows)


@pytest.mark.parametrize("fan_out", [2, 3, 5])
def test_against_recomputation(spark, fan_out):
    rng = random.Random(fan_out)
    rows = []
    for k, size in enumerate([1, 2, 3, 4, 9, 10, 28, 60]):
        for _ in range(size):
            rows.append((len(rows), rng.choice(["a\nb", "x", "é\n", ""]) + str(rng.random()), "en", f"s{k}", 3))
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT")
    want = expected(rows, fan_out)
    assert got(frame, fan_out) == want
    assert any("True" in w for w in want) and any("False" in w for w in want)


def test_odd_rows(make, odd_rows):
    frame = make(odd_rows).withColumnRenamed("_key", "digest").withColumnRenamed("size", "a.b")
    assert got(frame) == expected([r[:5] for r in odd_rows])
    assert got(make([])) == []


def test_one_row(make, odd_rows):
    assert got(make(odd_rows[:1])) == expected([odd_rows[0][:5]])


def test_sibling_indices(spark):
    rows = spark.range(12)
    for fan_out in (2, 3, 4):
        found = rows.select("id", *[s.alias(str(i)) for i, s in enumerate(manifest._siblings(F.col("id"), fan_out))]).collect()
        for i, *others in found:
            start = i - i % fan_out
            assert sorted(others) == [j for j in range(start, start + fan_out) if j != i]
