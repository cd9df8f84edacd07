"""Exact unigram token counts without building the tokens.

An Aho-Corasick automaton enumerates the vocabulary's matches in a stretch of text; dynamic programming carries the best
score and, with it, the number of pieces. Ties are resolved as the library does: a later candidate must be strictly
better, and candidates for an end come in the order of their start, so the longest last piece wins. A
character without a piece of its own costs ``UNKNOWN_PENALTY`` below the lowest score and counts as its UTF-8 bytes.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from replyloom.llm.rows import quoted, whole_row

#: Fixed values of the library's unigram model.
UNKNOWN_PENALTY = 10.0
SPACE = "▁"
#: A run of marks and the word after it; a text that begins with a mark consists of such segments.
SEGMENT = re.compile(f"{SPACE}+[^{SPACE}]*")
CROSSING = re.compile(f"[^{SPACE}]{SPACE}")
CACHE_ENTRIES = 400_000
CACHED_LENGTH = 40


@dataclass
class Unigram:
    """Pieces of text with their scores.

    A text is searched in segments, cut where no piece can span the cut: before a run of marks, unless some piece has a
    mark after another character (``crossing``); then the text is one segment.
    """

    automaton: ahocorasick.Automaton
    single: frozenset[str]
    unknown: float
    cache: dict[str, int]
    crossing: bool = False

    @classmethod
    def of(cls, scores: dict[str, float]) -> Unigram:
        automaton = ahocorasick.Automaton()
        for piece, score in scores.items():
            automaton.add_word(piece, (len(piece), score))
        automaton.make_automaton()
        single = frozenset(p for p in scores if len(p) == 1)
        return cls(automaton, single, min(scores.values()) - UNKNOWN_PENALTY, {}, any(map(CROSSING.search, scores)))

    @classmethod
    def from_file(cls, path: str) -> Unigram:
        """The text pieces of a model file; control, unknown and byte pieces never match text."""
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        text = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        return cls.of({model.id_to_piece(i): model.get_score(i) for i in text})

    def best(self, segment: str) -> int:
        """Number of pieces on the best path through one segment."""
        n = len(segment)
        if self.single.issuperset(segment):
            score, pieces = [0.0] * (n + 1), [0] * (n + 1)
            last, top = -1, 0.0
            # Matches of one end come longest first, which is the order of their starts.
            for end, (length, value) in self.automaton.iter(segment):
                start = end + 1 - length
                value += score[start]
                if end != last or value > top:
                    last, top = end, value
                    score[end + 1], pieces[end + 1] = value, pieces[start] + 1
            return pieces[n]
        matches: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        for end, match in self.automaton.iter(segment):
            matches[end].append(match)
        score, pieces = [0.0] * (n + 1), [0] * (n + 1)
        for end in range(n):
            top = None
            for length, value in matches[end]:
                value += score[end + 1 - length]
                if top is None or value > top:
                    top, pieces[end + 1] = value, pieces[end + 1 - length] + 1
            if segment[end] not in self.single:
                value = score[end] + self.unknown
                if top is None or value > top:
                    top, pieces[end + 1] = value, pieces[end] + len(segment[end].encode("utf-8", "surrogatepass"))
            score[end + 1] = top
        return pieces[n]

    def count(self, text: str) -> int:
        """Pieces of a text whose words are split at every mark first, so that no piece has more than its first mark."""
        if not text:
            return 0
        marked = text.replace(" ", SPACE)
        return self._sum(SPACE + word for word in (marked[1:] if marked[0] == SPACE else marked).split(SPACE))

    def count_whole(self, text: str) -> int:
        """Pieces of a whole text, which begins with a space mark. Runs of spaces take the pieces of several marks."""
        if not text:
            return 0
        marked = text.replace(" ", SPACE)
        marked = marked if marked[0] == SPACE else SPACE + marked
        return self._sum([marked] if self.crossing else SEGMENT.findall(marked))

    def _sum(self, segments: Iterable[str]) -> int:
        cache, total = self.cache, 0
        for segment in segments:
            pieces = cache.get(segment)
            if pieces is None:
                pieces = self.best(segment)
                if len(segment) <= CACHED_LENGTH:
                    if len(cache) >= CACHE_ENTRIES:
                        cache.clear()
                    cache[segment] = pieces
            total += pieces
        return total


@functools.cache
def _model(path: str) -> Unigram:
    return Unigram.from_file(path)


def token_counts(documents: DataFrame, model: str, text: str = "text", output: str = "n_tokens") -> DataFrame:
    """The columns of ``documents`` but ``text``, with the number of tokens of the whole text.

    A null or empty text has none, and an empty table gives an empty one. ``model`` is the path of a vocabulary file every executor can read.
    """
    row = documents.select(whole_row(documents, (text, output)).alias("row"), F.col(quoted(text)).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _model(model)
        for batch in batches:
            counts = [counter.count_whole(value.as_py() or "") for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], names=["row", "n"])

    counted = row.mapInArrow(run, T.StructType([row.schema["row"], T.StructField("n", T.LongType())]))
    return counted.select("row.*", F.col("n").alias(output))
