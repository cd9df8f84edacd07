"""SentencePiece encoding and decoding for merge-type vocabularies.

Adjacent symbols are merged by a score-ordered agenda: the pair with the highest score comes first, of equal ones the leftmost,
and a pair whose symbols have changed since is passed over. Characters that are no piece become their bytes. Merges
cannot cross two neighbouring characters that no piece holds side by side, so a text falls into words and smaller segments, and
most words were met before. Every result is compared with the sentencepiece library, Arrow batch by batch.
"""

from __future__ import annotations

import contextlib
import gc
import hashlib
import heapq
import re
from collections.abc import Iterator, Sequence
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from replyloom.llm.rows import quoted, whole_row

SPACE = "▁"
#: Characters that are encoded, compared and decoded at a time. Only memory depends on it, not the ids.
WINDOW = 1 << 18
#: Words remembered, of the lately met and of those before; length from which a word is not merged in a matrix with others; its rows.
CACHED = 1 << 19
SHORT = 40
ROWS = 1 << 11


class MergeVocabulary:
    """Pieces, scores and byte pieces of a sentencepiece model file.

    Refused are models that change the text (other than spaces), have no byte pieces, or have unused pieces: their rules differ.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.library.get_piece_size()
        self.ids: dict[str, int] = {}
        #: A piece's place in the agenda: the highest score comes first.
        self.ranks: dict[str, float] = {}
        self.bytes: dict[int, int] = {}
        self.texts = [""] * size
        for i in range(size):
            piece = self.library.id_to_piece(i)
            if self.library.is_byte(i):
                value = int(piece[3:5], 16)
                self.bytes[value] = i
                # Bytes from 128 on stand as lone surrogates until they are put together.
                self.texts[i] = chr(value) if value < 128 else chr(0xDC00 + value)
            elif self.library.is_unused(i):
                raise ValueError("a vocabulary with unused pieces is not supported")
            elif not (self.library.is_control(i) or self.library.is_unknown(i)):
                self.ids[piece] = i
                self.ranks[piece] = -self.library.get_score(i)
                self.texts[i] = piece.replace(SPACE, " ")
        if len(self.bytes) != 256:
            raise ValueError("a vocabulary needs a piece for every byte")
        probe = "  a ﬁÉ　 b "
        if self.library.normalize(probe) != SPACE + probe.replace(" ", SPACE):
            raise ValueError("a model that normalises texts is not supported")
        self.names = [str(i) for i in range(size)]
        #: One object for every id, which all remembered words share; the last one stands for no id.
        self.numbers = np.array([*range(size), -1], dtype=object)
        longer = [p for p in self.ids if len(p) > 1]
        self.pairs = {p[i : i + 2] for p in longer for i in range(len(p) - 1)}
        #: Whether a piece holds a space mark after another character, so that spaces are no cuts.
        self.crossing = any(a != SPACE and b == SPACE for a, b in self.pairs)
        self.segment = self._segments(longer)
        self._number(longer)
        self.known: dict[str, tuple[int, ...]] = {}
        self.earlier: dict[str, tuple[int, ...]] = {}

    def _segments(self, longer: Sequence[str]) -> re.Pattern:
        """Runs no merge leaves, for long words: marks with what follows, and single characters no longer piece holds."""
        used = set("".join(longer))
        alone = "".join(re.escape(c) for c in map(chr, range(128)) if c not in used)
        if self.crossing:
            return re.compile(f"[^{alone}]+|[{alone}]")
        return re.compile(f"{SPACE}+[^{SPACE}{alone}]*|[^{SPACE}{alone}]+|[{alone}]")

    def _number(self, longer: Sequence[str]) -> None:
        """Symbols by number, for agendas of many short segments at once: characters and pieces, and what two of them make."""
        single = {chr(b): i for b, i in self.bytes.items() if b < 128}
        names = sorted(set(self.ids) | set("".join(longer)) | set(single))
        number = {name: i for i, name in enumerate(names)}
        # An ASCII character without a piece is its byte; the last entry stands for every other character no piece has.
        self.symbol_ids = np.array([*[self.ids.get(name, single.get(name, -1)) for name in names], -1])
        self.symbols = names
        self.by_character = np.arange(len(names), len(names) + 0x110000, dtype=np.int64)
        for name in names:
            if len(name) == 1:
                self.by_character[ord(name)] = number[name]
        # Equal scores have equal ranks, and a row's first lowest rank is the leftmost pair.
        order = {rank: i for i, rank in enumerate(sorted(set(self.ranks.values())))}
        made = [
            (number[p[:i]] << 32 | number[p[i:]], order[self.ranks[p]], number[p])
            for p in longer for i in range(1, len(p)) if p[:i] in number and p[i:] in number
        ]
        made = np.array(sorted(made), dtype=np.int64).reshape(-1, 3).T
        self.pair_keys = np.ascontiguousarray(made[0])
        self.pair_ranks, self.pair_makes = made[1].astype(np.int32), made[2].astype(np.int32)
        self.never = len(order)
        self._place()

    def _place(self) -> None:
        """Tables of places in ``pair_keys`` by hashes of the key: each has the pairs whose slots in those before are taken. Two mostly do."""
        bits = max(8, (16 * len(self.pair_keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        rng = np.random.Generator(np.random.PCG64(7))
        self.factors, self.places = [], []
        left = np.arange(len(self.pair_keys))
        while len(left) or not self.places:
            tried = []
            for factor in rng.integers(1, 2**63, 16 if self.places else 1, dtype=np.int64) | np.int64(1):
                slots = self._slots(self.pair_keys[left], factor)
                first = np.unique(slots, return_index=True)[1]
                tried.append((len(left) - len(first), factor, slots, first))
                if len(first) == len(left):
                    break
            _, factor, slots, first = min(tried, key=lambda t: t[0])
            table = np.zeros(1 << bits, dtype=np.int32)
            table[slots[first]] = left[first]
            self.factors.append(factor)
            self.places.append(table)
            left = np.delete(left, first)

    def _slots(self, keys: np.ndarray, factor: np.int64) -> np.ndarray:
        mixed = (keys ^ (keys >> 29)) * factor
        return (mixed.view(np.uint64) >> self.shift).astype(np.int64)

    def _offers(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and symbol of what each two neighbours make; the rank ``never`` where they make nothing."""
        # Where no symbol stands is -1, and keys with it are negative: no pair has them.
        keys = left << 32 | right
        at = self.places[0][self._slots(keys, self.factors[0])]
        for table, factor in zip(self.places[1:], self.factors[1:]):
            later = table[self._slots(keys, factor)]
            at = np.where(self.pair_keys[later] == keys, later, at)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], np.int32(self.never)), self.pair_makes[at]

    def merged_many(self, segments: Sequence[str]) -> list[tuple[int, ...]]:
        """Ids of every segment: one agenda per row of a matrix, one merge per row and round."""
        count, width = len(segments), max(map(len, segments))
        lengths = np.fromiter(map(len, segments), np.int64, count)
        # A column on each side holds no symbol, so that every place has neighbours.
        symbols = np.full((count, width + 2), -1, dtype=np.int64)
        points = np.frombuffer("".join(segments).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        symbols[:, 1:-1][np.arange(width) < lengths[:, None]] = self.by_character[points]
        ranks = np.full((count, width + 2), self.never, dtype=np.int32)
        makes = np.zeros((count, width + 2), dtype=np.int32)
        ranks[:, :-1], makes[:, :-1] = self._offers(symbols[:, :-1], symbols[:, 1:])
        # Tables are read and written by place. A merged symbol stays at its left place; the right one is -1 and skipped by the links.
        places = np.arange(count * (width + 2))
        after, before = (places + 1).astype(np.int32), (places - 1).astype(np.int32)
        flat, flat_ranks, flat_makes = symbols.reshape(-1), ranks.reshape(-1), makes.reshape(-1)
        starts = np.arange(0, len(places), width + 2)
        while len(starts):
            # While all rows are left, they need not be copied.
            left = ranks if len(starts) == count else ranks[starts // (width + 2)]
            at = starts + left.argmin(axis=1)
            going = flat_ranks[at] < self.never
            if not going.all():
                starts, at = starts[going], at[going]
            made = flat_makes[at].astype(np.int64)
            right, near = after[at], before[at]
            beyond = after[right]
            flat[at], flat[right], flat_ranks[right] = made, -1, self.never
            after[at], before[beyond] = beyond, at
            flat_ranks[at], flat_makes[at] = self._offers(made, flat[beyond])
            flat_ranks[near], flat_makes[near] = self._offers(flat[near], made)
        held = symbols >= 0
        ids = self.symbol_ids[np.minimum(symbols[held], len(self.symbols))]
        sizes = held.sum(axis=1)
        ends = np.cumsum(sizes)
        found, bounds = self.numbers[ids].tolist(), ends.tolist()
        out = [tuple(found[end - size : end]) for end, size in zip(bounds, sizes.tolist())]
        for row in np.unique(np.searchsorted(ends, np.flatnonzero(ids < 0), side="right")).tolist():
            out[row] = self._spelled(symbols[row][held[row]].tolist())
        return out

    def merged(self, run: str) -> list[str]:
        """The symbols left of one run of any length, when no two neighbours make a piece: the agenda as a heap."""
        symbols = list(run)
        ranks = self.ranks
        agenda = []
        for left, piece in enumerate(map(str.__add__, symbols, symbols[1:])):
            if piece in ranks:
                agenda.append((ranks[piece], left, piece))
        if not agenda:
            return symbols
        heapq.heapify(agenda)
        count = len(symbols)
        before, after = list(range(-1, count)), list(range(1, count + 1))
        while agenda:
            _, left, piece = heapq.heappop(agenda)
            right = after[left]
            # A symbol that was merged away is empty; one that grew makes another piece.
            if right == count or not symbols[left] or symbols[left] + symbols[right] != piece:
                continue
            symbols[left], symbols[right] = piece, ""
            following, preceding = after[right], before[left]
            after[left] = following
            if following < count:
                before[following] = left
                longer = piece + symbols[following]
                if longer in ranks:
                    heapq.heappush(agenda, (ranks[longer], left, longer))
            if preceding >= 0:
                longer = symbols[preceding] + piece
                if longer in ranks:
                    heapq.heappush(agenda, (ranks[longer], preceding, longer))
        return [s for s in symbols if s]

    def _long_ids(self, word: str) -> tuple[int, ...]:
        """Ids of a long word: segment by segment, each merged run by run where no piece holds two characters side by side."""
        found: list[int] = []
        for segment in self.segment.findall(SPACE + word):
            start = 0
            for end in range(1, len(segment) + 1):
                if end == len(segment) or segment[end - 1 : end + 1] not in self.pairs:
                    for symbol in self.merged(segment[start:end]):
                        own = self.ids.get(symbol)
                        found.extend([own] if own is not None else [self.bytes[b] for b in symbol.encode("utf-8")])
                    start = end
        return tuple(found)

    def _spelled(self, symbols: list[int]) -> tuple[int, ...]:
        """Ids of symbols of which some are characters without a piece, which become their bytes."""
        out: list[int] = []
        count = len(self.symbols)
        for s in symbols:
            if s < count and self.symbol_ids[s] >= 0:
                out.append(int(self.symbol_ids[s]))
            else:
                character = self.symbols[s] if s < count else chr(s - count)
                out.extend(self.bytes[b] for b in character.encode("utf-8"))
        return tuple(out)

    def learn(self, words: set[str]) -> None:
        """Put the ids of these words into ``known``; what was known becomes ``earlier`` when there is too much of it."""
        if len(self.known) + len(words) > CACHED:
            self.known, self.earlier = {}, self.known
        again = words & self.earlier.keys()
        self.known.update((w, self.earlier[w]) for w in again)
        ordered = sorted(words - again, key=len)
        for start in range(0, len(ordered), ROWS):
            part = ordered[start : start + ROWS]
            self.known.update(zip(part, self.merged_many([SPACE + w for w in part])))

    def _words(self, text: str) -> list[str]:
        """What stands between single spaces; further spaces go to the word after them. The one mark before each word is left out."""
        if self.crossing:
            return [text.replace(" ", SPACE)] if text else []
        # A mark that stands in the text is encoded as a space is.
        words = text.replace(SPACE, " ").split(" ") if text else []
        if "" in words:
            out, marks = [], ""
            for word in words[:-1]:
                if word:
                    out.append(marks + word)
                    marks = ""
                else:
                    marks += SPACE
            return [*out, marks + words[-1]]
        return words

    def encode_many(self, texts: Sequence[str]) -> list[list[int]]:
        """Ids of each text, without begin or end ids."""
        cut = [self._words(t) for t in texts]
        words = list(chain.from_iterable(cut))
        found = list(map(self.known.get, words))
        if None in found:
            self.learn({w for w, ids in zip(words, found) if ids is None and len(w) < SHORT})
            get = self.known.get
            for at, ids in enumerate(found):
                if ids is None:
                    found[at] = get(words[at]) or self._long_ids(words[at])
        ends = list(accumulate(map(len, cut)))
        return [list(chain.from_iterable(found[end - len(own) : end])) for own, end in zip(cut, ends)]

    def encode(self, text: str) -> list[int]:
        return self.encode_many([text])[0]

    def decode(self, ids: Sequence[int]) -> str:
        """The text of ids; the space before the first word is not part of it, each byte that is no UTF-8 becomes U+FFFD."""
        text = "".join(map(self.texts.__getitem__, ids))
        if text.startswith(" ") and ids[0] != self.bytes[32]:
            text = text[1:]
        if not text.isascii():
            text = text.encode("utf-8", "surrogateescape").decode("utf-8", "surrogateescape")
            text = _BROKEN.sub("\ufffd", text)
        return text

    def windows(self, text: str) -> Iterator[str]:
        """Parts whose ids, one part after the other, are those of the text, and whose texts lie one space apart.

        A part ends before a single space: there the next part's own leading space takes its place. Where pieces hold a
        space after other characters, there is only one part.
        """
        start = 0
        while not self.crossing and len(text) - start > WINDOW:
            cut = _SINGLE.search(text, start + WINDOW)
            if cut is None:
                break
            yield text[start : cut.start() + 1]
            start = cut.end()
        yield text[start:]


_BROKEN = re.compile("[\udc80-\udcff]")
_SINGLE = re.compile("[^ ▁] (?=[^ ▁])")
_LOADED: dict[str, MergeVocabulary] = {}


def vocabulary(path: str) -> MergeVocabulary:
    """The model of a file that every machine has, read once per process."""
    if path not in _LOADED:
        _LOADED[path] = MergeVocabulary(path)
    return _LOADED[path]


@contextlib.contextmanager
def _uncollected() -> Iterator[None]:
    """Without the search for cycles, which looks at every remembered word and makes none."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


CODED = "n_tokens BIGINT, ids_sha256 STRING, decoded_sha256 STRING, agrees BOOLEAN"


def _grouped(pieces: MergeVocabulary, texts: Sequence[str]) -> Iterator[list[tuple[int, str]]]:
    """Windows of all texts with the text's number, in groups of about ``WINDOW`` characters."""
    group, held = [], 0
    for number, text in enumerate(texts):
        for part in pieces.windows(text):
            group.append((number, part))
            held += len(part)
            if held >= WINDOW:
                yield group
                group, held = [], 0
    if group:
        yield group


def digests(pieces: MergeVocabulary, texts: Sequence[str]) -> list[tuple[int, str, str, bool]]:
    """Number of ids, hash of the ids, hash of the text the library decodes them to, and whether it gives the same ids."""
    out: list[tuple[int, str, str, bool]] = []
    last, count, same, id_hash, text_hash = -1, 0, True, None, None
    for group in _grouped(pieces, texts):
        parts = [part for _, part in group]
        coded, theirs = pieces.encode_many(parts), pieces.library.encode(parts, num_threads=1)
        texts_of_ids = pieces.library.decode(coded, num_threads=1)
        for (number, _), ids, expected, text in zip(group, coded, theirs, texts_of_ids):
            if number == last:
                id_hash.update(b",")
                text_hash.update(b" ")
            else:
                if last >= 0:
                    out.append((count, id_hash.hexdigest(), text_hash.hexdigest(), same))
                last, count, same, id_hash, text_hash = number, 0, True, hashlib.sha256(), hashlib.sha256()
            same = same and ids == expected
            id_hash.update(",".join(map(pieces.names.__getitem__, ids)).encode())
            text_hash.update(text.encode("utf-8"))
            count += len(ids)
    if last >= 0:
        out.append((count, id_hash.hexdigest(), text_hash.hexdigest(), same))
    return out


def coded_digests(documents: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256, agrees) of every row, in one pass without a shuffle.

    ``ids_sha256`` is over the decimal ids joined by commas, ``decoded_sha256`` over the UTF-8 of the text the library decodes them
    to; ``agrees`` tells that the library's ids are the same. A null text is an empty one, which has no ids. Texts of any length are read in
    windows. Rows that repeat each give a row, an empty table gives none, and other columns of any name are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = vocabulary(path)
        for batch in batches:
            with _uncollected():
                rows = digests(pieces, [value.as_py() or "" for value in batch.column(1)])
            columns = list(zip(*rows)) or [[], [], [], []]
            types = [pa.int64(), pa.string(), pa.string(), pa.bool_()]
            added = [pa.array(c, t) for c, t in zip(columns, types)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *added], names=["key", "n_tokens", "ids_sha256", "decoded_sha256", "agrees"]
            )

    kind = documents.schema[key].dataType.simpleString()
    chosen = documents.select(F.col(quoted(key)).alias("key"), F.col(quoted(text)).alias("text"))
    return chosen.mapInArrow(run, f"key {kind}, {CODED}").withColumnRenamed("key", key)


def encoded(documents: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """The rows with a further column of ids (an array of integers); null where the text is null.

    A column of that name is replaced. Raises where the library's ids differ.
    """
    return _mapped(documents, path, text, ids, T.ArrayType(T.IntegerType()), pa.list_(pa.int32()), _checked_ids)


def decoded(rows: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """The rows with a further column that holds the text of the ids; null where the ids are null.

    A column of that name is replaced. Raises where the library's text differs.
    """
    return _mapped(rows, path, ids, text, T.StringType(), pa.string(), _checked_text)


def _checked_ids(pieces: MergeVocabulary, text: str) -> list[int]:
    out: list[int] = []
    for part in pieces.windows(text):
        own = pieces.encode(part)
        if own != pieces.library.encode(part):
            raise ValueError("the library encodes this text differently; the model is not of merge type")
        out.extend(own)
    return out


def _checked_text(pieces: MergeVocabulary, ids: list[int]) -> str:
    text = pieces.decode(ids)
    if text != pieces.library.decode(ids):
        raise ValueError("the library decodes these ids differently")
    return text


def _mapped(rows: DataFrame, path: str, read: str, output: str, kind: T.DataType, arrow: pa.DataType, change) -> DataFrame:
    kept = [c for c in rows.columns if c != output]
    packed = rows.select(whole_row(rows, (output,)).alias("row"), F.col(quoted(read)).alias("value"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = vocabulary(path)
        for batch in batches:
            values = [None if v is None else change(pieces, v) for v in (x.as_py() for x in batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, arrow)], names=["row", "value"])

    schema = T.StructType([packed.schema["row"], T.StructField("value", kind)])
    out = packed.mapInArrow(run, schema)
    return out.select(*[F.col("row").getField(c).alias(c) for c in kept], F.col("value").alias(output))
