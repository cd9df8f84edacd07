"""License scans by patience alignment of texts with license templates.

Words unique to both the text and the template are anchors. The longest increasing run of them is kept, and the gaps
between two neighbours are aligned the same way, until a gap has no anchor; there, equal words at either end still
count. Coverage is the share of the template's words that the text matches in order.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Notices and permission texts of well-known licenses (fixed values).
TEMPLATES = {
    "apache-1.1": "Licensed under the Apache License, Version 1.1.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "epl-1.0": "Licensed under the Eclipse Public License, Version 1.0.",
    "epl-2.0": "Licensed under the Eclipse Public License, Version 2.0.",
    "mit-notice": "Released under the MIT License.",
    "isc-notice": "Released under the ISC License.",
    "bsd-notice": "Released under the BSD License.",
    "unlicense-notice": "Released under the Unlicense.",
    "gpl-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "lgpl-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "lgpl-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "agpl-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "cc-by-nd-4.0": "Licensed under CC BY-ND 4.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-nc-sa-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "cc-by-nc-nd-4.0": "Licensed under CC BY-NC-ND 4.0.",
    "mpl-1.1": "The contents of this file are subject to the Mozilla Public License Version 1.1.",
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction, including without limitation the rights to "
        "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions"
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met"
    ),
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
LEAST_COVERAGE = 0.8
#: Share of a template from which on another one is so like it that their differences tell which is meant.
LIKE = 0.6
#: Bytes that are not part of a word become spaces, capital letters small ones; other scripts are left as they are.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest run of pairs, sorted by the first number, in which the second grows (patience sorting)."""
    tops: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for i, (_, b) in enumerate(pairs):
        pile = bisect_left(tops, b)
        if pile == len(tops):
            tops.append(b)
            at.append(i)
        else:
            tops[pile], at[pile] = b, i
        back.append(at[pile - 1] if pile else -1)
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def align(text: list[bytes], template: list[bytes]) -> list[tuple[int, int]]:
    """Matched (text position, template position) pairs, increasing in both."""
    found: list[tuple[int, int]] = []
    todo = [(0, len(text), 0, len(template))]
    while todo:
        a, a_end, b, b_end = todo.pop()
        while a < a_end and b < b_end and text[a] == template[b]:
            found.append((a, b))
            a, b = a + 1, b + 1
        while a < a_end and b < b_end and text[a_end - 1] == template[b_end - 1]:
            a_end, b_end = a_end - 1, b_end - 1
            found.append((a_end, b_end))
        if a >= a_end or b >= b_end:
            continue
        in_text, in_template = Counter(text[a:a_end]), Counter(template[b:b_end])
        place = {w: i for i, w in enumerate(text[a:a_end], a) if in_text[w] == 1 and in_template[w] == 1}
        anchors = _increasing(
            sorted((place[w], j) for j, w in enumerate(template[b:b_end], b) if w in place)
        )
        if not anchors:
            continue
        found.extend(anchors)
        edges = [(a - 1, b - 1), *anchors, (a_end, b_end)]
        todo.extend((i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:]))
    return sorted(found)


def _starts(text: list[bytes], template: list[bytes], width: int, least: int) -> Iterator[tuple[int, int]]:
    """Places of template words from which ``width`` words hold at least ``least`` template words, each counted as often
    as the template has it, with that number. No alignment of such a stretch can match more."""
    own = Counter(template)
    inside: Counter[bytes] = Counter()
    shared = end = 0
    for i, w in enumerate(text):
        while end < min(len(text), i + width):
            new = text[end]
            if new in own:
                inside[new] += 1
                shared += inside[new] <= own[new]
            end += 1
        if w in own:
            if shared >= least:
                yield i, shared
            shared -= inside[w] <= own[w]
            inside[w] -= 1


def widths(template: list[bytes]) -> tuple[int, int]:
    """Words of a stretch in which a notice is looked for on its own: little more than the template's, and four times."""
    return len(template) + len(template) // 4 + 1, 4 * len(template) + 1


def best_stretch(text: list[bytes], template: list[bytes], least: float) -> list[tuple[int, int]]:
    """The alignment that matches most of the template, of the whole text and of the stretches from every position.

    Stretches find repeats and notices whose words also stand elsewhere. Passed over are only those which have too few of
    the template's words for the share ``least``, or no more than the best alignment so far has matched.
    """
    needed = math.ceil(least * len(template) - 1e-9)
    best: list[tuple[int, int]] = []
    for width in widths(template):
        for start, shared in _starts(text, template, width, needed):
            if shared > len(best):
                pairs = align(text[start : start + width], template)
                if len(pairs) > len(best):
                    best = [(start + i, j) for i, j in pairs]
                if len(best) == len(template):
                    return best
    whole = align(text, template)
    return whole if len(whole) > len(best) else best


def telling_words(templates: Mapping[str, list[bytes]], like: float = LIKE) -> dict[str, frozenset[int]]:
    """Places in each template without which another license may be meant.

    These are the words with digits, and those that the alignment with a template leaves over which covers the share ``like`` of it.
    """
    out = {}
    for name, template in templates.items():
        places = {j for j, w in enumerate(template) if any(48 <= c <= 57 for c in w)}
        for other, text in templates.items():
            matched = {j for _, j in align(text, template)}
            if other != name and len(matched) >= like * len(template):
                places |= set(range(len(template))) - matched
        out[name] = frozenset(places)
    return out


class Scanner:
    def __init__(self, templates: Mapping[str, str], least: float):
        self.templates = [(name, words(text)) for name, text in sorted(templates.items())]
        self.least = least
        self.known = frozenset(w for _, t in self.templates for w in t)
        self.telling = telling_words(dict(self.templates))

    def complete(self, name: str, template: list[bytes], pairs: list[tuple[int, int]]) -> bool:
        """Whether all telling words are matched, each right beside a neighbour it has in the template; digits right after it."""
        at = {j: i for i, j in pairs}
        for j in self.telling[name]:
            after = j > 0 and j in at and at.get(j - 1) == at[j] - 1
            before = j in at and at.get(j + 1) == at[j] + 1
            if not (after or before and not any(48 <= c <= 57 for c in template[j])):
                return False
        return True

    def scan(self, text: str) -> list[tuple[str, float, int, int]]:
        """(license, coverage, first word, word after the last) of each template's best stretch, above the bound.

        A stretch names its license only if the template's telling words are ``complete``. Of stretches that overlap, the one with the most
        matched words stays (then the shorter, then by name), so that a longer name wins over the one it contains.
        """
        own = words(text)
        present = self.known.intersection(own)
        found = []
        for name, template in self.templates:
            # No alignment can match more template words than the text has at all.
            if sum(w in present for w in template) < self.least * len(template):
                continue
            if any(template[j] not in present for j in self.telling[name]):
                continue
            pairs = best_stretch(own, template, self.least)
            if len(pairs) >= self.least * len(template) and self.complete(name, template, pairs):
                found.append((len(pairs), name, len(pairs) / len(template), pairs[0][0], pairs[-1][0] + 1))
        kept: list[tuple[str, float, int, int]] = []
        for _, name, coverage, first, end in sorted(found, key=lambda f: (-f[0], f[4] - f[3], f[1])):
            if all(end <= a or b <= first for _, _, a, b in kept):
                kept.append((name, coverage, first, end))
        return sorted(kept)


def scan_licenses(
    documents: DataFrame, templates: Mapping[str, str] = TEMPLATES, least: float = LEAST_COVERAGE
) -> DataFrame:
    """One row per document: doc_id, n_licenses, licenses.

    ``licenses`` is an array of (license, coverage, first_word, end_word) by license name. A text that is null or
    without words has none. Whole texts are aligned, and the stretches from every position; documents without enough of a template's words are passed over.
    Of a license that stands in a text more than once, the first of its best stretches is given. Rows that repeat each give a row, an empty table
    gives none, and other columns of any name are not read.
    """
    scanner = Scanner(templates, least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(
            pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("first_word", pa.int64()), ("end_word", pa.int64())])
        )
        names = ("license", "coverage", "first_word", "end_word")
        for batch in batches:
            found = [[dict(zip(names, row)) for row in scanner.scan(v.as_py() or "")] for v in batch.column(1)]
            counts = pa.array([len(f) for f in found], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), counts, pa.array(found, kind)], names=["doc_id", "n_licenses", "licenses"]
            )

    schema = (
        "doc_id BIGINT, n_licenses INT, "
        "licenses ARRAY<STRUCT<license: STRING, coverage: DOUBLE, first_word: BIGINT, end_word: BIGINT>>"
    )
    return documents.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, schema)
