"""Token pieces against the tokenizer itself, packing against its own constraints and bounds."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from replyloom.llm import packing

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_equal_the_tokenizer():
    theirs, ours = Tokenizer.from_file(PATH), packing.ByteBpe(PATH)
    texts = ["", " ", "a  b\n\n c\t\td ", "it's we'LL", "<|endoftext|> and <|endoftext", "x<|endoftext|><|endoftext|>y 12½³"]
    points = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    texts += ["".join(f"a{c} {c}{c}1 " for c in points[i : i + 500]) for i in range(0, len(points), 500)]
    rng = random.Random(3)
    texts += ["".join(rng.choice(" \n\t.,'aAé1\x85 ​　\x1c") for _ in range(300)) for _ in range(300)]
    for text in texts:
        assert ours.ids(text).tolist() == theirs.encode(text, add_special_tokens=False).ids


def test_long_texts_are_encoded_in_parts(monkeypatch):
    ours = packing.ByteBpe(PATH)
    rng = random.Random(4)
    text = "".join(rng.choice(["the ", "of", " ", "\n", "x1 ", "ab cd ", "é "]) for _ in range(5000))
    whole = ours.ids(text)
    monkeypatch.setattr(packing, "PART_CHARS", 97)
    assert ours.ids(text).tolist() == whole.tolist()


def check(rows, data, capacity):
    theirs = Tokenizer.from_file(PATH)
    want, got = [], []
    for doc_id, text, *_ in data:
        ids = np.array([*theirs.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        want += [(doc_id, i, a, b - a, zlib.crc32(ids[a:b].tobytes())) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    bins = defaultdict(list)
    for r in rows:
        got.append((r.doc_id, r.piece, r.start, r.length, r.ids_crc32))
        bins[r.sequence_id].append((r.offset, r.length))
    assert sorted(got, key=repr) == sorted(want, key=repr)
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), sum(r.length for r in rows)


def test_pieces_and_places(make, odd_rows):
    check(packing.pack_documents(make(odd_rows), PATH, capacity=64).collect(), odd_rows, 64)


def test_groups(make, odd_rows):
    check(packing.pack_documents(make(odd_rows), PATH, capacity=64, group_pieces=50).collect(), odd_rows, 64)


def test_empty(make):
    assert packing.pack_documents(make([]), PATH).count() == 0


def test_search_is_valid_and_no_worse_than_best_fit():
    rng = np.random.default_rng(1)
    for lengths in (rng.integers(1, 101, 400), rng.integers(20, 60, 500), np.array([34, 33, 33] * 40), np.array([100] * 5)):
        fitted = packing.pack_lengths(lengths, 100, rounds=0)
        found = packing.pack_lengths(lengths, 100)
        assert sorted(i for b in found for i in b) == list(range(len(lengths)))
        assert all(lengths[b].sum() <= 100 for b in found)
        assert -(-lengths.sum() // 100) <= len(found) <= len(fitted)


def test_exchanges_empty_a_bin():
    # Best fit leaves [6, 4], [5, 4], [3, 3, 2] and so on apart; exchanges bring the number to the lower bound.
    lengths = np.array([7, 6, 5, 5, 4, 4, 3, 3, 2, 1])
    assert len(packing.pack_lengths(lengths, 10)) == 4
