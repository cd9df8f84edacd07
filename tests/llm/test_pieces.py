"""Merge-type encoding against the sentencepiece library."""

import gc
import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from replyloom.llm import pieces
from replyloom.llm.queries import tokenizer_path

PATH = tokenizer_path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def texts():
    rng = random.Random(3)
    alphabet = list("abcdefghijklmnop ") + ["the ", " \n", "▁", "▁▁", "  ", "\t", "é", "世界", "日本語", "\U0001f600", "12", "<s>", "<0x0A>", "\x00"]
    return ["", " ", "    ", "a" * 500, " " * 70, "=" * 33] + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 300))) for _ in range(300)]


def test_ids_and_texts_are_the_librarys():
    own = pieces.MergeVocabulary(PATH)
    for text in texts():
        ids = own.encode(text)
        assert ids == LIBRARY.encode(text), repr(text)
        assert own.decode(ids) == LIBRARY.decode(ids), repr(text)


def test_every_piece_and_broken_bytes_decode_as_in_the_library():
    own = pieces.MergeVocabulary(PATH)
    rng = random.Random(4)
    for _ in range(300):
        ids = [rng.randrange(3, 300) for _ in range(3)] + [rng.randrange(3, 32_000) for _ in range(20)]
        assert own.decode(ids) == LIBRARY.decode(ids)


def test_single_runs_without_cached_segments():
    own = pieces.MergeVocabulary(PATH)
    for text in texts()[:60]:
        symbols = own.merged(pieces.SPACE + text.replace(" ", pieces.SPACE))
        assert "".join(symbols) == pieces.SPACE + text.replace(" ", pieces.SPACE)
        if text and all(s in own.ids for s in symbols):
            assert [own.ids[s] for s in symbols] == LIBRARY.encode(text)


def test_windows_and_cache_do_not_change_the_result(monkeypatch):
    found = pieces.digests(pieces.MergeVocabulary(PATH), texts())
    assert all(f[3] for f in found) and len(found) == len(texts())
    for name, value in (("WINDOW", 5), ("CACHED", 40), ("SHORT", 3), ("ROWS", 2)):
        monkeypatch.setattr(pieces, name, value)
        assert pieces.digests(pieces.MergeVocabulary(PATH), texts()) == found


def test_odd_rows(make, odd_rows):
    frame = make(odd_rows).withColumnRenamed("_key", "a.b")
    got = sorted((tuple(r) for r in pieces.coded_digests(frame, PATH).collect()), key=repr)
    want = []
    for row in odd_rows:
        ids = LIBRARY.encode(row[1] or "")
        want.append((row[0], len(ids), sha(",".join(map(str, ids))), sha(LIBRARY.decode(ids)), True))
    assert got == sorted(want, key=repr)
    assert pieces.coded_digests(make([]), PATH).count() == 0


def test_round_trip_keeps_rows_and_columns(make, odd_rows):
    frame = make(odd_rows).withColumnRenamed("_key", "a.b")
    coded = pieces.encoded(frame, PATH, ids="size")
    back = pieces.decoded(coded, PATH, ids="size", text="again")
    assert coded.columns == [c for c in frame.columns if c != "size"] + ["size"] and back.columns == [*coded.columns, "again"]
    rows = back.collect()
    assert len(rows) == len(odd_rows)
    assert all(r.again == r.text for r in rows)
    assert sorted(repr((r.text, r["a.b"])) for r in rows) == sorted(repr((r[1], r[5])) for r in odd_rows)


def test_a_unigram_rule_is_noticed(tmp_path):
    class Changed(pieces.MergeVocabulary):
        def __init__(self, path):
            super().__init__(path)
            self.pair_ranks = self.never - 1 - self.pair_ranks

    assert not all(f[3] for f in pieces.digests(Changed(PATH), texts()))
    with pytest.raises(ValueError, match="merge type"):
        for t in texts():
            pieces._checked_ids(Changed(PATH), t)


def test_every_pair_is_found_and_no_other(monkeypatch):
    own = pieces.MergeVocabulary(PATH)
    left, right = own.pair_keys >> 32, own.pair_keys & 0xFFFFFFFF
    ranks, makes = own._offers(left, right)
    assert (ranks == own.pair_ranks).all() and (makes == own.pair_makes).all() and len(own.places) <= 3
    known = set(own.pair_keys.tolist())
    keys = own.pair_keys + 1
    ranks, _ = own._offers(keys >> 32, keys & 0xFFFFFFFF)
    assert [r < own.never for r in ranks.tolist()] == [k in known for k in keys.tolist()]
    ends = np.full(3, -1)
    assert (own._offers(ends, ends)[0] == own.never).all() and (own._offers(left[:3], ends)[0] == own.never).all()


def test_ascii_characters_without_a_piece_are_merged_in_the_matrix(monkeypatch):
    own = pieces.MergeVocabulary(PATH)
    monkeypatch.setattr(own, "_spelled", None)
    words = ["que.\nThe", "\x00", "a\tb\x7fc", "\n\n"]
    assert own.merged_many([pieces.SPACE + w for w in words]) == [tuple(LIBRARY.encode(w)) for w in words]


def test_tasks_do_not_search_for_cycles_while_they_encode():
    assert gc.isenabled()
    with pieces._uncollected():
        assert not gc.isenabled()
    assert gc.isenabled()
