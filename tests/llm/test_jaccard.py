"""The Jaccard join against comparing all pairs."""

import random
import re

import numpy as np
import pyarrow as pa

from replyloom.llm import jaccard
from replyloom.llm.graphs import components


def shingles(text, width=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))) if words else frozenset()


def expected(rows, width=4, percent=85):
    sets = [shingles(r[1], width) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    least = {k: min((d for d in v if d is not None), default=None) for k, v in groups.items()}
    return sorted(((rows[i][0], len(sets[i]), least[find(i)]) for i in range(len(rows))), key=repr), len(groups)


def corpus():
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(30)]
    out = []
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(5, 200))]
        if rng.random() < 0.5:
            base[3:3] = passage
        for _ in range(rng.randint(1, 9)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            out.append(" ".join(copy).title() if rng.random() < 0.3 else "\n".join(copy))
    rng.shuffle(out)
    return [(i, t, "en", "s", 1, *"abcd") for i, t in enumerate(out)]


def got(frame):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_components(frame).collect()), key=repr)


def test_against_all_pairs(make):
    rows = corpus()
    assert got(make(rows)) == expected(rows)[0]


def test_blocks_meet_each_other(make, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 3)
    monkeypatch.setattr(jaccard, "LEAF", 2)
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", 400)
    rows = corpus()
    assert got(make(rows)) == expected(rows)[0]


def cell(texts, components, i=0, j=0, own=None):
    """The rows of one cell, as the second pass reads them."""
    sets = [jaccard.shingle_set(t.encode()) for t in texts]
    n = len(texts)
    columns = [
        pa.array([7] * n), pa.array([1] * n), pa.array([i] * n, pa.int32()), pa.array([j] * n, pa.int32()), pa.array(own or [0] * n, pa.int32()),
        pa.array(range(n)), pa.array(components), pa.array([jaccard.packed(jaccard.count_vector(s)) for s in sets], pa.binary()),
        pa.array([t.encode() for t in texts], pa.binary()),
    ]
    names = ["pivot", "band", "i", "j", "own", "set_key", "component", "counts", "text"]
    return pa.RecordBatch.from_arrays(columns, names=names)


def test_large_groups_give_a_forest():
    """Two groups of 1,000 texts: all of a group link with each other, the groups only come near each other."""
    rng = random.Random(6)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for k in range(2000):
        words = list(base)
        if k >= 1000:
            words[10:36] = [f"z{i}" for i in range(26)]
        words[-1] = f"own{k}"
        texts.append(" ".join(words))
    order = rng.sample(range(2000), 2000)
    batch = cell([texts[k] for k in order], list(range(2000)))
    halves = [batch.slice(0, 700), batch.slice(700)]
    near = [row for out in jaccard._near_classes(iter([halves[0].select(range(8)), halves[1].select(range(8))]), 85) for row in out.column(5).to_pylist()]
    assert sorted(near) == list(range(2000))
    links = [pair for out in jaccard._cell_links(iter(halves), 4, 85) for pair in zip(*[c.to_pylist() for c in out.columns])]
    assert len(links) == 1998
    assert all((order[a] < 1000) == (order[b] < 1000) for a, b in links)


def test_blocks_of_two_halves_meet_across_only():
    texts = [" ".join(f"w{i}" for i in range(60)) + f" x{k}" for k in range(4)]
    found = list(jaccard._cell_links(iter([cell(texts, [0, 1, 2, 3], 0, 1, [0, 0, 1, 1])]), 4, 85))
    pairs = {pair for out in found for pair in zip(*[c.to_pylist() for c in out.columns])}
    assert len(pairs) == 3 and all((a < 2) != (b < 2) for a, b in pairs)


def test_odd_rows(make, odd_rows):
    want, groups = expected(odd_rows)
    assert got(make(odd_rows)) == want
    kept = jaccard.one_per_group(make(odd_rows))
    assert kept.columns == make(odd_rows).columns
    assert kept.count() == groups


def test_empty(make):
    assert jaccard.jaccard_components(make([])).count() == 0 and jaccard.one_per_group(make([])).count() == 0


def test_tree_finds_what_a_scan_finds():
    rng = np.random.default_rng(2)
    points = np.concatenate([rng.integers(0, 9, (300, 8)), rng.integers(0, 3, (50, 8))]).astype(np.int32)
    sizes = points.sum(axis=1).astype(np.int64)
    tree = jaccard.CountTree(points, sizes, leaf=4)
    for i in range(0, 350, 7):
        bound = np.minimum(points, points[i]).sum(axis=1)
        scan = np.flatnonzero(bound >= jaccard._needed(sizes, sizes[i], 85))
        assert sorted(tree.search(points[i], sizes[i], 85).tolist()) == scan.tolist()


def test_packed_counts():
    rows = [np.full(jaccard.GROUPS, n, dtype=np.int64) for n in (0, 255, 256, 70_000, 2**31)]
    for chosen in (rows, rows[:2], []):
        back = jaccard.unpacked(pa.array([jaccard.packed(r) for r in chosen], pa.binary()))
        assert back.shape == (len(chosen), jaccard.GROUPS) and [r[0] for r in back] == [r[0] for r in chosen]


def test_windows_do_not_change_a_set(monkeypatch):
    rng = random.Random(1)
    text = b" ".join(rng.choice([b"a", b"bb", b"ccc"]) for _ in range(900))
    whole = jaccard.shingle_set(text).tolist()
    for window in (1, 7, 50):
        monkeypatch.setattr(jaccard, "WINDOW", window)
        assert jaccard.shingle_set(text).tolist() == whole
    assert len(whole) == len(shingles(text.decode()))


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 99)], "a BIGINT, b BIGINT")
    found = {r.node: r.component for r in components(links).collect()}
    assert found == {i: 0 for i in range(41)} | {99: 99, 100: 99}


def test_long_unrelated_texts_are_no_candidates():
    """With a fixed number of coordinates, all long texts of one length come near each other and their texts travel."""
    rng = random.Random(9)
    texts = [" ".join(f"w{rng.randrange(5000)}" for _ in range(9000 + 10 * k)) for k in range(6)]
    batch = cell(texts, list(range(6)))
    assert not list(jaccard._near_classes(iter([batch.select(range(8))]), 85))
    copies = cell([*texts, texts[0] + " end", texts[5].replace("w1 ", "v1 ")], list(range(8)))
    near = [row for out in jaccard._near_classes(iter([copies.select(range(8))]), 85) for row in out.column(5).to_pylist()]
    assert sorted(near) == [0, 5, 6, 7]


def test_folded_counts_bound_what_sets_share(spark):
    """Sets on both sides of a change of length: the bound of every two is at least their overlap, and no link is lost."""
    rng = np.random.default_rng(5)
    base = np.unique(rng.integers(0, 2**63, 2300, dtype=np.uint64) * np.uint64(2))
    sets = [base[:n] for n in (900, 1020, 1024, 1025, 1190, 2040, 2300)]
    lengths = [len(jaccard.count_vector(s)) for s in sets]
    assert lengths == [128, 128, 128, 256, 256, 256, 512]
    points = jaccard.unpacked(pa.array([jaccard.packed(jaccard.count_vector(s)) for s in sets], pa.binary()))
    assert points.shape == (7, 128) and points.sum(axis=1).tolist() == [len(s) for s in sets]
    vectors = [(i, jaccard.packed(jaccard.count_vector(s))) for i, s in enumerate(sets)]
    classes = spark.createDataFrame([(i, bytearray(v)) for i, v in vectors], "set_key BIGINT, counts BINARY")
    pairs = [(i, j) for i in range(7) for j in range(i)]
    passed = {tuple(r) for r in jaccard._bounded(spark.createDataFrame(pairs, "a BIGINT, b BIGINT"), classes, 85).collect()}
    assert passed == {(i, j) for i, j in pairs if 100 * len(sets[j]) >= 85 * len(sets[i])}


def test_classes_of_like_size_meet_in_one_band(spark):
    members = spark.createDataFrame([(1, 10, 500, 10), (1, 11, 501, 11), (2, 12, 500, 12), (2, 13, 560, 13)], "pivot BIGINT, set_key BIGINT, n BIGINT, component BIGINT")
    found = sorted((r.pivot, r.set_key) for r in jaccard._cells(members, 85).collect())
    assert found == [(1, 10), (1, 11), (2, 12), (2, 13)]
