"""Fingerprints against sets of paragraphs."""

import hashlib
import re

from replyloom.llm import fingerprints


def paragraphs(text):
    return set(re.findall(r"[^\n\r]{1,200}", text))


def likeness(a, b):
    a, b = paragraphs(a), paragraphs(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(rows):
    docs = [(r[0], r[1] or "") for r in rows]
    out = {}
    for i, (doc_id, text) in enumerate(docs):
        following = docs[(i + 1) % len(docs)][1]
        k = len(text) // 4
        edited = text[: len(text) - k] + following[:k]
        out[doc_id] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), likeness(text, edited), likeness(text, following))
    return out


def documents():
    lines = [f"line {i} " + "x" * (i * 37 % 250) for i in range(300)]
    texts = ["\n".join(lines[i : i + 3 + i * i % 90]) for i in range(60)]
    texts[7], texts[8], texts[20], texts[21], texts[30] = "", None, texts[5], texts[5], "é世🙂" * 3000
    return [(i * i, t, "en", "s", 1, *"abcd") for i, t in enumerate(texts)]


def test_against_sets(make, monkeypatch):
    rows = documents()
    for per_range in (512, 1):
        monkeypatch.setattr(fingerprints, "ROWS_PER_RANGE", per_range)
        found = fingerprints.fingerprints(make(rows)).collect()
        assert {r.doc_id: (r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in found} == expected(rows)
        prints = {}
        for r in found:
            text = dict((d, t or "") for d, t, *_ in rows)[r.doc_id]
            assert prints.setdefault(text, r.fingerprint) == r.fingerprint


def test_ranges(make):
    rows = documents()
    want = {r[0]: (rows[(i + 1) % len(rows)][1] or "") for i, r in enumerate(rows)}
    for per_range in (1, 5, 1000):
        got = fingerprints.with_next(make(rows), per_range).collect()
        assert {r.doc_id: r.next_text for r in got} == want


def test_odd_rows(make, odd_rows):
    assert fingerprints.fingerprints(make(odd_rows)).count() == len(odd_rows)
    one = fingerprints.fingerprints(make(odd_rows[4:5])).first()
    assert one.near_next == 1.0


def test_empty(make):
    assert fingerprints.fingerprints(make([])).count() == 0
