"""Source mixing against sorting and adding up in plain Python."""

import hashlib
import math
import re

from pyspark.sql import functions as F

from replyloom.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected(data, seed=17):
    weights, docs = [5, 2, 1], []
    for doc_id, text, _, source, *_ in data:
        u = int(hashlib.md5(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:13], 16) + 1
        share = sum(c.isalpha() or c in " \t\n\x0b\x0c\r" for c in text) / len(text) if text else 0
        docs.append((doc_id, source, len(WORD.findall(text or "")), -math.log(u / (2**52 + 1)) / max(share * share, 0.05)))
    sizes = {}
    for _, source, size, _ in docs:
        sizes[source] = sizes.get(source, 0) + size
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    left, target = 1.5 * sum(sizes.values()), {}
    while len(target) < len(order):
        open_ = [s for s in order if s not in target]
        level = left / sum(w[s] for s in open_)
        full = [s for s in open_ if w[s] * level >= 2 * sizes[s]]
        for s in full or open_:
            target[s] = min(w[s] * level, 2.0 * sizes[s])
        left -= sum(target[s] for s in full)
    out = []
    for s in order:
        epochs = int(target[s] // sizes[s]) if sizes[s] else 0
        rest, total = target[s] - epochs * sizes[s], 0
        for doc_id, _, size, _ in sorted((d for d in docs if d[1] == s), key=lambda d: (d[3], -1 if d[0] is None else d[0], d[2])):
            total += size
            out.append((doc_id, s, size, sizes[s], round(target[s], 6), size * (epochs + (2 * total - size <= 2 * rest))))
    # Rows that are equal are taken alike.
    most = {}
    for row in out:
        most[row[:3]] = max(row[5], most.get(row[:3], 0))
    return sorted(((*row[:5], most[row[:3]]) for row in out), key=repr)


def test_against_plain_python(make, odd_rows):
    got = [(r.doc_id, r.source, r.size, r.source_size, round(r.target, 6), r.taken) for r in mixing.mix(make(odd_rows)).collect()]
    assert sorted(got, key=repr) == expected(odd_rows)


def test_hot_source(make):
    data = [(i, " ".join(["w"] * (i % 37 + 1)), "en", "hot" if i % 3 else f"s{i % 15}", 1, *"abcd") for i in range(600)]
    got = [(r.doc_id, r.source, r.size, r.source_size, round(r.target, 6), r.taken) for r in mixing.mix(make(data)).collect()]
    assert sorted(got, key=repr) == expected(data)


def test_documents_follow_the_decision(make, odd_rows):
    frame = make(odd_rows)
    mixed = mixing.mixed_documents(frame)
    assert mixed.columns == frame.columns
    words = mixed.select(F.sum(mixing.count_words(F.col("text")))).first()[0]
    assert words == mixing.mix(frame).select(F.sum("taken")).first()[0]


def test_empty(make):
    assert mixing.mix(make([])).count() == 0 and mixing.mixed_documents(make([])).count() == 0
