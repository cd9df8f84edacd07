"""Best-fit packing of token sequences, improved by swap-based local search.

Documents are tokenised in Arrow batches and cut into pieces of at most ``capacity`` tokens. Pieces are dealt by
hash into groups of bounded size, and every group is packed by itself: best fit in descending length, then local
search. A group wastes less than one sequence against packing everything together, and groups grow in number, not
in size, with the input.
"""

from __future__ import annotations

import functools
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from replyloom.session import materialize

GROUP_PIECES = 8192
#: The word pattern of the byte-level vocabulary (fixed value).
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Above this many code points a text is encoded in parts that begin at a word the pattern always cuts at.
PART_CHARS = 1_000_000


class ByteBpe:
    """Ids of a byte-level BPE given as a ``tokenizers`` file, special tokens added by no one but the text.

    The vocabulary and merges are the file's. Words are merged by ``tiktoken``, which gives the same ids several
    times faster; tests compare the two on every code point.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in printable]
        byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(other)}
        special = {t["content"]: t["id"] for t in model["added_tokens"]}
        ranks = {bytes(byte_of[c] for c in w): i for w, i in model["model"]["vocab"].items() if w not in special}
        self.special = set(special)
        self.coder = tiktoken.Encoding("file", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def ids(self, text: str) -> np.ndarray:
        if len(text) <= PART_CHARS:
            return np.array(self.coder.encode(text, allowed_special=self.special), dtype="<u4")
        parts = [self.coder.encode(p, allowed_special=self.special) for p in _parts(text)]
        return np.array([i for p in parts for i in p], dtype="<u4")


def _parts(text: str) -> Iterator[str]:
    """Cut before a space between two ASCII letters: a word ends there whatever stands around it."""
    start = 0
    while len(text) - start > PART_CHARS:
        at = start + PART_CHARS
        while at < len(text) and not (
            text[at] == " " and _letter(text[at - 1]) and at + 1 < len(text) and _letter(text[at + 1])
        ):
            at += 1
        yield text[start:at]
        start = at
    yield text[start:]


def _letter(c: str) -> bool:
    return "a" <= c <= "z" or "A" <= c <= "Z"


@functools.cache
def _coder(path: str) -> ByteBpe:
    return ByteBpe(path)


def token_pieces(documents: DataFrame, tokenizer: str, end_id: int, capacity: int = 1024) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): every document's ids, ``end_id`` last, in pieces.

    A null text counts as empty, so each document has at least one piece. Only documents longer than
    ``capacity`` are cut; the first piece takes the odd part, the others are full.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(tokenizer)
        for batch in batches:
            rows = {name: [] for name in ("doc_id", "piece", "start", "length", "ids_crc32")}
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                ids = np.append(coder.ids(text.as_py() or ""), np.uint32(end_id)).astype("<u4")
                first = len(ids) % capacity or capacity
                edges = [0, *range(first, len(ids) + 1, capacity)]
                for i, (a, b) in enumerate(zip(edges, edges[1:])):
                    rows["doc_id"].append(doc_id.as_py())
                    rows["piece"].append(i)
                    rows["start"].append(a)
                    rows["length"].append(b - a)
                    rows["ids_crc32"].append(zlib.crc32(ids[a:b].tobytes()))
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), types)], names=list(rows))

    schema = "doc_id BIGINT, piece INT, start BIGINT, length BIGINT, ids_crc32 BIGINT"
    return documents.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(cut, schema)


def pack_lengths(lengths: np.ndarray, capacity: int, rounds: int = 4) -> list[list[int]]:
    """Bins of indices. Best fit in descending length (ties by index), then local search."""
    order = np.argsort(-lengths, kind="stable")
    left: list[int] = []
    bins: list[list[int]] = []
    by_left: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0  # bit r: some bin has r tokens left
    for i in order.tolist():
        n = int(lengths[i])
        fits = mask >> n
        if fits:
            r = n + ((fits & -fits).bit_length() - 1)
            b = by_left[r].pop()
            if not by_left[r]:
                mask &= ~(1 << r)
        else:
            b, r = len(bins), capacity
            bins.append([])
            left.append(capacity)
        bins[b].append(i)
        left[b] = r - n
        if left[b]:
            by_left[left[b]].append(b)
            mask |= 1 << left[b]
    return _local_search(lengths, bins, capacity, rounds)


def _local_search(lengths: np.ndarray, bins: list[list[int]], capacity: int, rounds: int) -> list[list[int]]:
    """Move, one-for-one and two-for-one exchanges between underfull bins, each raising the sum of squared fills.

    The emptiest bin gives: one of its items moves into a gap, or takes the place of a smaller item, or a pair of
    its items takes the place of one. The receiver was at least as full and gets fuller, so the sum of
    squares grows with every step and the search ends. It stops when no step is left, or at the lower bound.
    """
    size = [int(n) for n in lengths]
    fill = [sum(size[i] for i in b) for b in bins]
    least = -(-sum(fill) // capacity)
    used = sum(1 for f in fill if f)
    for _ in range(rounds):
        if used <= least:
            break
        moved = False
        givers = sorted((b for b in range(len(bins)) if 0 < fill[b] < capacity), key=lambda b: fill[b])
        # Items of underfull bins by (gap of the bin, size of the item); entries are checked when used.
        spots: dict[tuple[int, int], list[tuple[int, int]]] = {}
        gaps: dict[int, list[int]] = {}

        def enter(b: int) -> None:
            gap = capacity - fill[b]
            if gap:
                gaps.setdefault(gap, []).append(b)
                for i in bins[b]:
                    spots.setdefault((gap, size[i]), []).append((b, i))

        for b in givers:
            enter(b)
        widest = max(gaps, default=0)

        def receiver(need: int, giver: int, least_gap: int) -> tuple[int, int, int] | None:
            """(bin, item, gain): an item that ``need`` tokens replace so that the bin's fill grows most exactly."""
            for gain in range(min(widest, need - 1), 0, -1):
                found = spots.get((gain, need - gain))
                while found:
                    b, i = found[-1]
                    if capacity - fill[b] == gain and i in bins[b] and b != giver and fill[b] >= least_gap:
                        return b, i, gain
                    if capacity - fill[b] != gain or i not in bins[b]:
                        found.pop()
                        continue
                    break
            return None

        for giver in givers:
            if used <= least:
                break
            progress = True
            while progress and 0 < fill[giver] < capacity:
                progress = False
                for item in sorted(bins[giver], key=lambda i: -size[i]):
                    target = None
                    for gap in range(size[item], widest + 1):
                        found = gaps.get(gap)
                        while found and capacity - fill[found[-1]] != gap:
                            found.pop()
                        if found and found[-1] != giver and fill[found[-1]] >= fill[giver]:
                            target = found[-1]
                            break
                    if target is not None:
                        bins[giver].remove(item)
                        bins[target].append(item)
                        fill[giver] -= size[item]
                        fill[target] += size[item]
                        enter(target)
                        progress = moved = True
                        break
                    swap = receiver(size[item], giver, fill[giver])
                    if swap:
                        _exchange(bins, fill, size, giver, [item], swap)
                        enter(swap[0])
                        progress = moved = True
                        break
                if not progress and len(bins[giver]) > 1:
                    items = sorted(bins[giver], key=lambda i: size[i])[:8]
                    for x in range(len(items)):
                        for y in range(x + 1, len(items)):
                            pair = [items[x], items[y]]
                            swap = receiver(size[pair[0]] + size[pair[1]], giver, fill[giver])
                            if swap:
                                _exchange(bins, fill, size, giver, pair, swap)
                                enter(swap[0])
                                progress = moved = True
                                break
                        if progress:
                            break
            if fill[giver]:
                enter(giver)
            else:
                used -= 1
        if not moved:
            break
    return [b for b in bins if b]


def _exchange(bins, fill, size, giver, items, swap) -> None:
    target, item, gain = swap
    for i in items:
        bins[giver].remove(i)
        bins[target].append(i)
    bins[target].remove(item)
    bins[giver].append(item)
    fill[giver] -= gain
    fill[target] += gain


def pack(pieces: DataFrame, capacity: int = 1024, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with a ``length`` of 1 to ``capacity``.

    Sequence ids are unique but not dense: group number times 2^32 plus the bin. Offsets are gapless from
    0. ``pieces`` should be a written table: it is counted, then dealt out. An empty table stays empty.
    """
    groups = max(1, -(-pieces.count() // group_pieces))
    dealt = pieces.withColumn("_row", F.monotonically_increasing_id()).withColumn(
        "_group", F.pmod(F.xxhash64("_row"), F.lit(groups))
    )

    def place(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_row", kind="stable").reset_index(drop=True)
        bins = pack_lengths(group["length"].to_numpy(), capacity)
        lengths = group["length"].to_numpy()
        sequence, offset = np.empty(len(group), "int64"), np.empty(len(group), "int64")
        for number, items in enumerate(bins):
            at = 0
            for i in items:
                sequence[i], offset[i] = number, at
                at += int(lengths[i])
        group["sequence_id"] = int(group["_group"].iloc[0]) * 2**32 + sequence
        group["offset"] = offset
        return group.drop(columns=["_row", "_group"])

    added = [T.StructField(name, T.LongType()) for name in ("sequence_id", "offset")]
    schema = T.StructType([*pieces.schema.fields, *added])
    return dealt.groupBy("_group").applyInPandas(place, schema)


def pack_documents(
    documents: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = 1024, group_pieces: int = GROUP_PIECES
) -> DataFrame:
    """Tokenise, cut and pack whole documents; one row per piece.

    Null texts are empty documents of one token. Repeated rows are packed as often as they occur.
    """
    pieces = materialize(token_pieces(documents, tokenizer, end_id, capacity))
    return pack(pieces, capacity, group_pieces)
