"""Alignment against longest common subsequences, and planted notices."""

import random

from replyloom.llm import licenses


def common(a, b):
    best = [0] * (len(b) + 1)
    for x in a:
        previous = 0
        for j, y in enumerate(b):
            best[j + 1], previous = (previous + 1 if x == y else max(best[j], best[j + 1])), best[j + 1]
    return best[-1]


def test_alignment_is_a_common_subsequence():
    rng = random.Random(1)
    for _ in range(300):
        a = [rng.choice("abcdefghij") for _ in range(rng.randint(0, 15))]
        b = [rng.choice("abcdefghij") for _ in range(rng.randint(0, 15))]
        pairs = licenses.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
        assert len(pairs) <= common(a, b)


def test_distinct_words_align_as_well_as_possible():
    rng = random.Random(2)
    for _ in range(200):
        b = list(range(30))
        a = [x for x in b if rng.random() < 0.8]
        for _ in range(3):
            a.insert(rng.randrange(len(a) + 1), 100 + rng.randrange(50))
        i, j = rng.randrange(len(a)), rng.randrange(len(a))
        a[i], a[j] = a[j], a[i]
        if len(set(a)) == len(a):
            assert len(licenses.align(a, b)) == common(a, b)


def test_planted_notices(make):
    rng = random.Random(3)
    filler = [w.decode() for t in licenses.TEMPLATES.values() for w in licenses.words(t)] + ["qu", "zet", "om"]
    rows, want = [], {}
    for i in range(60):
        words = [rng.choice(["qu", "zet", "om", "the", "of", "is"]) for _ in range(rng.randint(5, 200))]
        name = rng.choice([None, *licenses.TEMPLATES])
        if name:
            at = rng.randrange(len(words))
            for _ in range(rng.randint(1, 2)):
                words[at:at] = licenses.TEMPLATES[name].upper().split()
                at = len(words)
        rows.append((i, " ".join(words), "en", "s", 1, *"abcd"))
        want[i] = [name] if name else []
    found = licenses.scan_licenses(make(rows)).collect()
    assert {r.doc_id: [x.license for x in r.licenses if x.coverage == 1.0] for r in found} == want
    assert filler and all(r.n_licenses == len(r.licenses) for r in found)


def test_small_changes_still_cover():
    scanner = licenses.Scanner(licenses.TEMPLATES, 0.8)
    text = "x licensed by the new Apache license version 2.0 y " * 3
    assert [(n, round(c, 3)) for n, c, *_ in scanner.scan(text)] == [("apache-2.0", 0.875)]
    assert scanner.scan(text.replace("2.0", "3.0")) == []
    assert scanner.scan("the license of the work under version") == []


def test_partial_notices_against_every_position():
    rng = random.Random(4)
    scanner = licenses.Scanner(licenses.TEMPLATES, 0.8)
    hits = 0
    for _ in range(60):
        name, template = rng.choice(scanner.templates)
        part = list(template)
        for _ in range(rng.randint(0, len(part) // 5)):
            at = rng.randrange(len(part))
            part[at : at + 1] = rng.choice([[], [b"qu"]])
        text = [rng.choice([b"qu", b"zet", b"om", b"is", rng.choice(template)]) for _ in range(rng.randint(20, 300))]
        at = rng.randrange(len(text))
        text = text[:at] + part + text[at:]
        found = {n: c for n, c, *_ in scanner.scan(b" ".join(text).decode())}
        tried = [licenses.align(text, template)]
        tried += [licenses.align(text[i : i + w], template) for w in licenses.widths(template) for i in range(len(text))]
        most = max(map(len, tried)) / len(template)
        assert found.get(name, most) == most
        if name not in found:
            best = [pairs for pairs in tried if len(pairs) == round(most * len(template))]
            complete = most >= 0.8 and all(scanner.complete(name, template, pairs) for pairs in best)
            # A complete notice is only left out for one that matches at least as many words there.
            assert not complete or any(round(c * len(dict(scanner.templates)[n])) >= round(most * len(template)) for n, c in found.items())
        hits += name in found
    assert hits > 20


QUOTED = {
    "This work is licensed under the GNU Lesser General Public License, version 3.": ["lgpl-3.0"],
    "This work is licensed under the GNU Lesser General Public License, version 2.1.": ["lgpl-2.1"],
    "This work is licensed under the GNU Affero General Public License, version 3.": ["agpl-3.0"],
    "This work is licensed under the GNU General Public License, version 2.": ["gpl-2.0"],
    "This work is licensed under the GNU General Public License, version 3.": ["gpl-3.0"],
    "This work is licensed under the GNU General Public License, version 1.": [],
    "Licensed under CC BY 4.0.": ["cc-by-4.0"],
    "Licensed under CC BY-SA 4.0.": ["cc-by-sa-4.0"],
    "Licensed under CC BY-ND 4.0.": ["cc-by-nd-4.0"],
    "Licensed under CC BY-NC-SA 4.0.": ["cc-by-nc-sa-4.0"],
    "Licensed under CC BY-NC-ND 4.0.": ["cc-by-nc-nd-4.0"],
    "Licensed under CC BY-NC 3.0.": [],
    "Licensed under the Eclipse Public License, Version 2.0.": ["epl-2.0"],
    "Licensed under the Apache License, Version 1.0.": [],
    "Licensed under the Zope Public License, Version 2.0.": [],
    "Released under the GPL License.": [],
    "Released under the ISC License.": ["isc-notice"],
    "Released under the MIT License.": ["mit-notice"],
    "The contents of this file are subject to the Mozilla Public License Version 1.1.": ["mpl-1.1"],
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1.": [],
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.": ["mpl-2.0"],
}


def test_licenses_are_named_right_or_not_at_all():
    scanner = licenses.Scanner(licenses.TEMPLATES, 0.8)
    for text, names in QUOTED.items():
        for before, after in (("", ""), ("Some words of the work 3. ", " More 2 words follow the license.")):
            assert [n for n, *_ in scanner.scan(before + text + after)] == names, text


def test_each_template_is_only_itself():
    scanner = licenses.Scanner(licenses.TEMPLATES, 0.8)
    for name, text in licenses.TEMPLATES.items():
        assert [(n, c) for n, c, *_ in scanner.scan(text)] == [(name, 1.0)]


def test_two_notices_of_one_text_are_both_named():
    scanner = licenses.Scanner(licenses.TEMPLATES, 0.8)
    names = ["apache-2.0", "lgpl-3.0", "mit"]
    assert [n for n, *_ in scanner.scan(" and then ".join(licenses.TEMPLATES[n] for n in names))] == names


def test_a_missing_word_elsewhere_hides_no_notice():
    filler = "qu zet om " * 200
    scanner = licenses.Scanner(licenses.TEMPLATES, 0.8)
    text = f"this work {filler} is licensed under the GNU General Public License, version 3 {filler} version"
    assert [n for n, *_ in scanner.scan(text)] == ["gpl-3.0"]
    changed = licenses.TEMPLATES["mit"].replace("sublicense", "relicense")
    assert "mit" in [n for n, *_ in scanner.scan(f"we sublicense {filler} {changed} {filler}")]


def test_odd_rows(make, odd_rows):
    assert licenses.scan_licenses(make(odd_rows)).count() == len(odd_rows)
    assert licenses.scan_licenses(make([])).count() == 0
