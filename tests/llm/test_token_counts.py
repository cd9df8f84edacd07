"""Counts against the library's own unigram search over the same pieces."""

import random

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer, models, pre_tokenizers

from replyloom.llm import token_counts

PATH = str(public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(6)
    alphabet = list("etaoin shrdlu  .,\n") + ["é", "ß", "世", "\U0001f600", "the", " and", "tion", "\t", "'"]
    out = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(400)]
    return out + [" ", "  ", "a ", " a", "   a  b", "▁a ▁", "x" * 300, "͸͹", ""]


def test_against_the_library(texts):
    """The same pieces and scores in the library's unigram model, words split at space marks."""
    file = sentencepiece.SentencePieceProcessor(model_file=PATH)
    pieces = [(file.id_to_piece(i), file.get_score(i)) for i in range(file.get_piece_size())]
    library = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=True))
    library.pre_tokenizer = pre_tokenizers.Metaspace()
    ours = token_counts.Unigram.from_file(PATH)
    for text in texts:
        assert ours.count(text) == len(library.encode(text).ids), text


def test_whole_texts_against_the_library(make, texts):
    """The library's unigram model over the unsplit text, in which pieces of several marks match."""
    file = sentencepiece.SentencePieceProcessor(model_file=PATH)
    pieces = [(file.id_to_piece(i), file.get_score(i)) for i in range(file.get_piece_size())]
    library = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=True))
    library.pre_tokenizer = pre_tokenizers.Metaspace(split=False)
    rng = random.Random(7)
    runs = ["".join(rng.choice(["if", "x", "=", "\n", "1"]) + " " * rng.choice([1, 2, 4, 7, 16, 33]) for _ in range(40)) for _ in range(50)]
    runs += [" " * k + "a" for k in range(40)] + [" " * 40, "def f():\n        return 1\n", "a" + " " * 500 + "b  "]
    everything = texts + runs
    rows = [(i, t, "en", "s", len(t), *"abcd") for i, t in enumerate(everything)]
    found = {r.doc_id: r.n_tokens for r in token_counts.token_counts(make(rows), PATH).collect()}
    for i, text in enumerate(everything):
        assert found[i] == len(library.encode(text).ids), text


def test_pieces_that_cross_words():
    scores = {"▁": -2.0, "a": -2.0, "b": -2.0, "a▁b": -1.0, "▁▁": -1.0}
    assert token_counts.Unigram.of(scores).count_whole("a b  a") == 4


def test_ties_and_unknown_characters_against_a_second_library():
    scores = {"▁": -2.0, "a": -1.0, "b": -1.0, "ab": -2.0, "▁a": -3.0, "ba": -2.0, "aba": -3.0, "▁ab": -4.0, "c": -5.0}
    byte_pieces = [(f"<0x{i:02X}>", -100.0) for i in range(256)]
    library = Tokenizer(models.Unigram([("<unk>", 0.0), *scores.items(), *byte_pieces], unk_id=0, byte_fallback=True))
    library.pre_tokenizer = pre_tokenizers.Metaspace()
    ours = token_counts.Unigram.of(scores)
    ours.unknown = -110.0  # the library takes the byte pieces' scores into account
    rng = random.Random(2)
    for _ in range(500):
        words = ["".join(rng.choice("abcdé") for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(1, 4))]
        text = " ".join(words)
        assert ours.count(text) == len(library.encode(text).ids), text


def test_odd_rows(make, odd_rows):
    frame = make(odd_rows)
    ours = token_counts.Unigram.from_file(PATH)
    found = token_counts.token_counts(frame, PATH).collect()
    assert len(found) == len(odd_rows)
    assert sorted(r.n_tokens for r in found) == sorted(ours.count(r[1] or "") for r in odd_rows)
    assert token_counts.token_counts(make([]), PATH).count() == 0


def test_cache_bound(monkeypatch, texts):
    monkeypatch.setattr(token_counts, "CACHE_ENTRIES", 5)
    small, ours = token_counts.Unigram.from_file(PATH), token_counts.Unigram.from_file(PATH)
    assert [small.count(t) for t in texts] == [small.count(t) for t in texts]
    assert len(small.cache) <= 5 and ours.count("a b") == small.count("a b")
