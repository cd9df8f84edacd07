"""Exact Jaccard join of word shingles over count vectors, for documents of any number.

A document's set is hashed shingle by shingle. Shingles are counted per hash group, so that a document is a point of
``GROUPS`` coordinates and the sum of the smaller coordinates of two points bounds what the sets share. Long texts get more
coordinates, one per ``PER_GROUP`` shingles, for with few of them all long texts of one length lie close together. Pairs that
pass the bound are verified on the whole sets.

How the join is dealt out:

* Equal sets are one class. Shingles are put into one global order, rare ones first (frequencies come from a count
  sketch of fixed size over all documents). Two sets that link share a shingle among the first
  ``n - ceil(n * similarity) + 1`` of each, so these are the classes' postings.
* Within each posting list, first every class is compared with one pivot, the class that shares most postings. That
  joins a group of near copies in as many comparisons as it has members. Links found this way make components.
* Lists that still touch several components are put together by their pivot, dealt by bands of size and joined block by block: a
  count-vector R-tree over each block finds the pairs of different components that pass the bound. A first pass keeps the classes
  that have such a pair. A second one gets their texts, verifies the pairs on the whole sets where they meet and unites what links,
  so a block of m classes gives at most m - 1 links. Pairs within one component need no test, for components are
  what is asked for. Blocks bound the memory of a task, they leave out no pair.

Shingles and sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from replyloom.llm.graphs import components
from replyloom.llm.rows import whole_row
from replyloom.session import materialize

#: Coordinates of a count vector, at least; shingles per coordinate, at most.
GROUPS = 128
PER_GROUP = 8
SKETCH_BITS = 20
CHUNK_BITS = 14
FILTER_BITS = 24
BLOCK_ROWS = 512
#: Shingles that the classes of a block hold together, at most, unless it is a single class.
BLOCK_SHINGLES = 1 << 21
LEAF = 16
WINDOW = 1 << 22

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 2**64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


_POWER, _INVERSE = _powers(_BASE, 1 << 12), _powers(_BACK, 1 << 12)


def _reach(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POWER, _INVERSE
    if len(_POWER) < n:
        size = max(n, 2 * len(_POWER))
        _POWER, _INVERSE = _powers(_BASE, size), _powers(_BACK, size)
    return _POWER, _INVERSE


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _windows(data: bytes, width: int) -> Iterator[list[bytes]]:
    """Words of the text in windows that overlap by ``width - 1`` words, so that a long text is never held as words."""
    words: list[bytes] = []
    start, yielded = 0, False
    while start < len(data):
        end = start + WINDOW
        while end < len(data) and data[end] not in b"\x20\t\n\x0b\x0c\r":
            end += 1
        words = words + data[start:end].split()
        if len(words) >= width:
            yield words
            yielded, words = True, words[len(words) - width + 1 :]
        start = end
    if words and not yielded:
        yield words


def shingle_set(data: bytes, width: int = 4) -> np.ndarray:
    """Sorted distinct hashes of the ``width``-word shingles; A-Z count as a-z, words end at ASCII white space.

    With fewer words the whole sequence is the one shingle; without words the set is empty.
    """
    found = []
    for words in _windows(data.lower(), width):
        joined = np.frombuffer(b" ".join(words), dtype=np.uint8)
        power, inverse = _reach(len(joined) + 1)
        sums = np.zeros(len(joined) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[joined] * power[: len(joined)], out=sums[1:])
        spaces = np.flatnonzero(joined == 32)
        starts = np.append(0, spaces + 1)
        ends = np.append(spaces, len(joined))
        k = max(1, len(starts) - width + 1)
        found.append(mixed((sums[ends[-k:]] - sums[starts[:k]]) * inverse[starts[:k]]))
    if not found:
        return np.empty(0, dtype=np.uint64)
    return np.unique(np.concatenate(found) if len(found) > 1 else found[0])


def set_key(shingles: np.ndarray) -> int:
    """A signed 64-bit digest of a set."""
    return int(np.sum(mixed(shingles ^ np.uint64(0xD6E8FEB86659FD93)), dtype=np.uint64).astype(np.int64))


def count_vector(shingles: np.ndarray) -> np.ndarray:
    """Shingles per hash group. The number of groups is a power of two, so a vector folds onto half as many."""
    groups = GROUPS
    while groups * PER_GROUP < len(shingles):
        groups *= 2
    return np.bincount((shingles >> np.uint64(30)).astype(np.int64) % groups, minlength=groups).astype(np.int32)


def packed(counts: np.ndarray) -> bytes:
    """A count vector in the narrowest unsigned type that holds it, after a byte that tells the type's width."""
    top = int(counts.max(initial=0))
    kind = np.uint8 if top < 2**8 else np.uint16 if top < 2**16 else np.uint32
    return bytes([np.dtype(kind).itemsize]) + counts.astype(kind).tobytes()


_KINDS = {1: np.uint8, 2: np.uint16, 4: np.uint32}


def folded(points: np.ndarray, groups: int) -> np.ndarray:
    """Count vectors of fewer groups."""
    while points.shape[-1] > groups:
        half = points.shape[-1] // 2
        points = points[..., :half] + points[..., half:]
    return points


def unpacked(column: pa.Array) -> np.ndarray:
    """Packed count vectors as a matrix, folded onto the fewest groups of any of them."""
    rows = [(np.frombuffer(row, dtype=_KINDS[row[0]], offset=1)) for row in column.to_pylist()]
    if not rows:
        return np.empty((0, GROUPS), dtype=np.int32)
    wide = any(row.dtype.itemsize == 4 for row in rows)
    if len({len(row) for row in rows}) == 1:
        return np.array(rows).astype(np.int64 if wide else np.int32)
    groups = min(map(len, rows))
    out = np.empty((len(rows), groups), dtype=np.int64 if wide else np.int32)
    for at, row in enumerate(rows):
        out[at] = folded(row.astype(out.dtype), groups)
    return out


def _slots(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def summarise(documents: DataFrame, width: int) -> DataFrame:
    """Per document (doc_id, text_hash, n, set_key, counts), and per task the chunks of its shingle count sketch.

    Sketch rows have ``chunk`` set, document rows have not.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << SKETCH_BITS, dtype=np.int32)
        names = ["doc_id", "text_hash", "n", "set_key", "counts", "chunk"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32()]
        seen: set[int] = set()
        for batch in batches:
            n, keys, counts = [], [], []
            for text in batch.column(2):
                shingles = shingle_set(text.as_py() or b"", width)
                n.append(len(shingles))
                keys.append(set_key(shingles))
                counts.append(packed(count_vector(shingles)))
                if keys[-1] not in seen:
                    seen.add(keys[-1])
                    np.add.at(sketch, _slots(shingles), 1)
            columns = [batch.column(0), batch.column(1), n, keys, counts, [None] * len(n)]
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types)], names=names
            )
        size = 1 << CHUNK_BITS
        chunks = [c for c in range(len(sketch) // size) if sketch[c * size : (c + 1) * size].any()]
        empty = [None] * len(chunks)
        rows = [empty, empty, empty, empty, [sketch[c * size : (c + 1) * size].tobytes() for c in chunks], chunks]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types)], names=names)

    schema = "doc_id BIGINT, text_hash BIGINT, n BIGINT, set_key BIGINT, counts BINARY, chunk INT"
    return _whole(documents).mapInArrow(run, schema)


def _whole(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text")
    )


def frequency_levels(sketch: DataFrame) -> np.ndarray:
    """Per slot a rough logarithm of how many shingle occurrences fall there; 2^20 bytes on the driver."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch.column(0), batch.column(1)):
                values = np.frombuffer(counts.as_py(), dtype=np.int32).astype(np.int64)
                at = chunk.as_py()
                total[at] = total[at] + values if at in total else values
        packed = [np.minimum(255, 4 * np.log2(1 + v)).astype(np.uint8).tobytes() for v in total.values()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array(packed, pa.binary())], names=["chunk", "levels"]
        )

    chunks = 1 << (SKETCH_BITS - CHUNK_BITS)
    summed = sketch.select("chunk", "counts").repartition(chunks, "chunk").mapInArrow(add, "chunk INT, levels BINARY")
    levels = np.zeros((chunks, 1 << CHUNK_BITS), dtype=np.uint8)
    for row in summed.collect():  # at most 64 rows of 16 KB
        levels[row.chunk] = np.frombuffer(row.levels, dtype=np.uint8)
    return levels.reshape(-1)


def postings(documents: DataFrame, levels: np.ndarray, width: int, percent: int) -> DataFrame:
    """(shingle, set_key): the rarest shingles of every set, as many as must hold one that a linked set has."""
    shared = documents.sparkSession.sparkContext.broadcast(levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = shared.value
        seen: set[int] = set()
        for batch in batches:
            out, keys = [], []
            for text in batch.column(2):
                shingles = shingle_set(text.as_py() or b"", width)
                key = set_key(shingles)
                if not len(shingles) or key in seen:
                    continue
                seen.add(key)
                take = len(shingles) - (len(shingles) * percent + 99) // 100 + 1
                ranked = np.lexsort((shingles, level[_slots(shingles)]))[:take]
                out.append(shingles[ranked])
                keys.append(np.full(take, key, dtype=np.int64))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(out).view(np.int64)), pa.array(np.concatenate(keys))],
                    names=["shingle", "set_key"],
                )

    return _whole(documents).mapInArrow(run, "shingle BIGINT, set_key BIGINT")


def _needed(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """The least overlap of two sets of these sizes that link: 100 * i >= percent * (a + b - i)."""
    return -(-percent * (a + b) // (100 + percent))


class CountTree:
    """An R-tree over count vectors: leaves of neighbouring points, each node with the maximum of its coordinates.

    Counts are not negative, so the upper corner alone bounds the summed coordinate minima.
    """

    def __init__(self, points: np.ndarray, sizes: np.ndarray, leaf: int = LEAF):
        self.order = self._tile(points, np.arange(len(points)), leaf, 0)
        self.points, self.sizes, self.leaf = points[self.order], sizes[self.order], leaf
        self.levels = []
        corner, least = self.points, self.sizes
        while len(corner) > leaf:
            starts = np.arange(0, len(corner), leaf)
            corner, least = np.maximum.reduceat(corner, starts), np.minimum.reduceat(least, starts)
            self.levels.append((corner, least))

    @staticmethod
    def _tile(points: np.ndarray, rows: np.ndarray, leaf: int, depth: int) -> np.ndarray:
        """Halve by the coordinate of the widest spread, so that a leaf's points lie near each other."""
        if len(rows) <= leaf:
            return rows
        spread = np.ptp(points[rows], axis=0)
        ordered = rows[np.argsort(points[rows, np.argmax(spread)], kind="stable")]
        half = -(-len(rows) // (2 * leaf)) * leaf
        return np.concatenate([CountTree._tile(points, part, leaf, depth + 1) for part in (ordered[:half], ordered[half:])])

    def search(self, point: np.ndarray, size: int, percent: int) -> np.ndarray:
        """Rows whose summed coordinate minima with ``point`` allow a link; sizes too far apart are left out."""
        nodes = None
        for corner, least in reversed(self.levels):
            nodes = np.arange(len(corner)) if nodes is None else nodes[nodes < len(corner)]
            bound = np.minimum(corner[nodes], point).sum(axis=1)
            nodes = nodes[bound >= _needed(least[nodes], size, percent)]
            nodes = (nodes[:, None] * self.leaf + np.arange(self.leaf)).reshape(-1)
        rows = np.arange(len(self.points)) if nodes is None else nodes[nodes < len(self.points)]
        bound = np.minimum(np.minimum(self.points[rows], point).sum(axis=1), np.minimum(self.sizes[rows], size))
        return self.order[rows[bound >= _needed(self.sizes[rows], size, percent)]]


def _bounded(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose count vectors allow a link."""
    side = lambda name: classes.select(F.col("set_key").alias(name), F.col("counts").alias(f"{name}_counts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                # Rows with vectors of the same lengths at a time, so that a short text does not fold the others.
                lengths = [pc.binary_length(batch.column(i)).to_numpy(zero_copy_only=False).astype(np.int64) for i in (2, 3)]
                _, kind = np.unique(lengths[0] << 32 | lengths[1], return_inverse=True)
                passes = np.zeros(batch.num_rows, dtype=bool)
                for k in range(kind.max() + 1):
                    at = np.flatnonzero(kind == k)
                    a, b = (unpacked(batch.column(i).take(pa.array(at))) for i in (2, 3))
                    groups = min(a.shape[1], b.shape[1])
                    a, b = folded(a, groups), folded(b, groups)
                    bound = np.minimum(a, b).sum(axis=1)
                    passes[at] = bound >= _needed(a.sum(axis=1, dtype=np.int64), b.sum(axis=1, dtype=np.int64), percent)
                yield batch.select([0, 1]).filter(pa.array(passes))

    joined = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "a_counts", "b_counts")
    return joined.mapInArrow(run, "a BIGINT, b BIGINT")


def _id_filter(ids: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """A Bloom filter of fixed size (2 MB) of the ``id`` column. It only saves moving text; joins decide."""
    words = (
        ids.select(F.explode(F.array(*[F.pmod(F.xxhash64("id", F.lit(s)), F.lit(1 << bits)) for s in (1, 2)])).alias("at"))
        .select(F.floor(F.col("at") / 32).alias("word"), F.expr("shiftleft(1L, CAST(at % 32 AS INT))").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    out = np.zeros(1 << (bits - 5), dtype=np.uint32)
    out[words.column("word").to_numpy().astype(np.int64)] = words.column("bits").to_numpy().astype(np.uint32)
    return out


def _texts(documents: DataFrame, wanted: DataFrame, classes: DataFrame) -> DataFrame:
    """``wanted`` (set_key and other columns) with the ``text`` of each row's class; few other texts leave the scan.

    Rows get their texts in one join, so a text moves once and not once more for every table it is needed in.
    """
    wanted = materialize(wanted.join(classes.select("set_key", "doc_id", "text_hash"), "set_key"))
    address = F.xxhash64(F.col("text_hash"), F.col("doc_id"))
    bits = documents.sparkSession.sparkContext.broadcast(_id_filter(wanted.select(address.alias("id"))))
    places = [F.pmod(F.xxhash64(address, F.lit(s)), F.lit(1 << FILTER_BITS)) for s in (1, 2)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = bits.value
        for batch in batches:
            at = [batch.column(i).to_numpy() for i in (3, 4)]
            hit = [(words[p >> 5] >> (p & 31).astype(np.uint32)) & np.uint32(1) for p in at]
            yield batch.select([0, 1, 2]).filter(pa.array((hit[0] & hit[1]).astype(bool)))

    found = (
        _whole(documents)
        .select("doc_id", "text_hash", "text", *[p.alias(f"p{i}") for i, p in enumerate(places)])
        .mapInArrow(run, "doc_id BIGINT, text_hash BIGINT, text BINARY")
    )
    f, w = found.alias("f"), wanted.alias("w")
    same = (F.col("f.text_hash") == F.col("w.text_hash")) & F.col("f.doc_id").eqNullSafe(F.col("w.doc_id"))
    return f.join(w, same).select(*[f"w.{c}" for c in wanted.columns if c not in ("doc_id", "text_hash")], "f.text")


def verified(pairs: DataFrame, documents: DataFrame, classes: DataFrame, width: int, percent: int) -> DataFrame:
    """Those of the pairs (a, b) that link, tested on the whole sets.

    All pairs of one ``a`` are read in a row after its own text, so a task holds one set besides the current one;
    many pairs of one ``a`` are salted over several tasks.
    """
    spread = F.pmod(F.xxhash64("b"), F.ceil(F.col("pairs") / 128)).cast("int")
    counted = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("pairs"))
    salted = materialize(pairs.join(counted, "a").withColumn("salt", spread).select("a", "b", "salt"))
    own_text = salted.select("a", "salt", F.lit(None).cast("bigint").alias("b"), F.col("a").alias("set_key")).distinct()
    wanted = own_text.unionByName(salted.select("a", "salt", "b", F.col("b").alias("set_key")))
    rows = _texts(documents, wanted, classes).select("a", "salt", "b", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, own = None, None
        for batch in batches:
            links = []
            for a, salt, b, text in zip(*[batch.column(i) for i in range(4)]):
                a, b = a.as_py(), b.as_py()
                shingles = shingle_set(text.as_py() or b"", width)
                if b is None:
                    key, own = a, shingles
                elif a == key:
                    both = _shared(own, shingles)
                    if 100 * both >= percent * (len(own) + len(shingles) - both):
                        links.append((a, b))
            columns = [pa.array([link[i] for link in links], pa.int64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])

    dealt = rows.repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    return dealt.mapInArrow(run, "a BIGINT, b BIGINT").distinct()


def _cells(members: DataFrame, percent: int) -> DataFrame:
    """(pivot, band, i, j, own, set_key, component): where the classes of (pivot, set_key, n, component) meet.

    Sets of linking sizes lie in the same or in neighbouring bands, so each class goes to its own band and the next of its pivot.
    Bands with one component are left out, and bands with classes of the band below only, which have met there. What is left of a pivot and band is cut into blocks by hash of the class, and each
    two blocks meet once.
    """
    width = max(math.log(100 / percent), 1e-9) * (1 + 1e-6)
    banded = members.withColumn("own_band", F.floor(F.ln("n") / width))
    banded = banded.withColumn("band", F.explode(F.array(F.col("own_band"), F.col("own_band") + 1)))
    rows = F.greatest(F.lit(1), F.least(F.lit(BLOCK_ROWS), F.floor(BLOCK_SHINGLES / F.max("n"))))
    lists = (
        banded.groupBy("pivot", "band")
        .agg(
            F.ceil(F.count(F.lit(1)) / rows).cast("int").alias("blocks"),
            F.min("component").alias("low"),
            F.max("component").alias("high"),
            F.max("own_band").alias("top"),
        )
        .filter("low <> high AND top = band")
        .drop("low", "high", "top")
    )
    own = F.pmod(F.xxhash64("set_key"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return (
        banded.join(lists, ["pivot", "band"])
        .withColumn("own", own)
        .withColumn("other", other)
        .withColumn("i", F.least("own", "other"))
        .withColumn("j", F.greatest("own", "other"))
        .select(*CELL, "own", "set_key", "component")
    )


CELL = ["pivot", "band", "i", "j"]


def _block_links(
    members: DataFrame, documents: DataFrame, classes: DataFrame, width: int, percent: int
) -> DataFrame:
    """Links (a, b) between different components, a forest in every cell, from (pivot, set_key, n, component)."""
    placed = _cells(members, percent).join(classes.select("set_key", "counts"), "set_key")
    placed = placed.select(*CELL, "own", "set_key", "component", "counts")
    kinds = {f.name: f.dataType.simpleString() for f in placed.schema.fields}
    schema = ", ".join(f"{c} {kinds[c]}" for c in placed.columns)
    near = materialize(_dealt(placed).mapInArrow(lambda b: _near_classes(b, percent), schema))
    full = _texts(documents, near, classes).select(*near.columns, "text")
    return _dealt(full).mapInArrow(lambda b: _cell_links(b, width, percent), "a BIGINT, b BIGINT").distinct()


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition(*CELL).sortWithinPartitions(*CELL)


def _runs(batches: Iterator[pa.RecordBatch], change=lambda batch: batch) -> Iterator[pa.Table]:
    """The rows of each cell as one table, though they span batches; ``change`` is applied to every batch as it is read."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        names = [batch.column(i).to_numpy() for i in range(4)]
        edges = np.flatnonzero(np.any([c[1:] != c[:-1] for c in names], axis=0)) + 1
        changed = change(batch)
        first = tuple(c[0] for c in names)
        if held and first != last:
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
        last = tuple(c[-1] for c in names)
        for start, end in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
            held.append(changed.slice(start, end - start))
            if end < batch.num_rows:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _candidates(table: pa.Table, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """Per row of a cell, the rows after it of other components that pass the bound, each two of them once."""
    i, j = table.column(2)[0].as_py(), table.column(3)[0].as_py()
    own, component = table.column(4).to_numpy(), table.column(6).to_numpy()
    if component.min() == component.max():
        return
    points = unpacked(table.column(7).combine_chunks())
    sizes = points.sum(axis=1, dtype=np.int64)
    tree = CountTree(points, sizes)
    for row in range(table.num_rows):
        at = tree.search(points[row], sizes[row], percent)
        fits = (at > row) & (component[at] != component[row])
        if i != j:
            fits &= own[at] != own[row]
        if fits.any():
            yield row, at[fits]


def _near_classes(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The rows of each cell that have a candidate there."""
    for table in _runs(batches):
        found = np.zeros(table.num_rows, dtype=bool)
        for row, others in _candidates(table, percent):
            found[row] = True
            found[others] = True
        if found.any():
            yield from table.filter(pa.array(found)).to_batches()


def _cell_links(batches: Iterator[pa.RecordBatch], width: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Candidates of each cell verified on their sets. What a link has united is not tested again."""

    def sets(batch: pa.RecordBatch) -> pa.RecordBatch:
        shingles = [shingle_set(text.as_py() or b"", width).tobytes() for text in batch.column(8)]
        return pa.RecordBatch.from_arrays([*batch.columns[:8], pa.array(shingles, pa.binary())], names=batch.schema.names)

    for table in _runs(batches, sets):
        keys = table.column(5).to_numpy()
        whole = [np.frombuffer(v, dtype=np.uint64) for v in table.column(8).to_pylist()]
        # Classes of one component count as united from the start.
        _, root = np.unique(table.column(6).to_numpy(), return_inverse=True)
        links = []
        for row, others in _candidates(table, percent):
            mine = whole[row]
            for other in others.tolist():
                if root[other] == root[row]:
                    continue
                theirs = whole[other]
                both = _shared(mine, theirs)
                if 100 * both >= percent * (len(mine) + len(theirs) - both):
                    links.append((keys[row], keys[other]))
                    root[root == root[other]] = root[row]
        if links:
            columns = [pa.array([link[side] for link in links], pa.int64()) for side in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    """How many values two sorted sets share."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    return int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())


def groups(documents: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """(doc_id, text_hash, n, component, component_id) of every row of ``documents`` (doc_id, text).

    ``component`` is a label of linked sets, null for an empty set. The rest is as in ``jaccard_components``.
    """
    summary = materialize(summarise(documents, width))
    members = summary.filter("chunk IS NULL").select("doc_id", "text_hash", "n", "set_key", "counts")
    levels = frequency_levels(summary.filter("chunk IS NOT NULL"))
    grouped = members.filter("n > 0").groupBy("set_key").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("one"), F.min("doc_id").alias("least"),
        F.max("n").alias("n"), F.first("counts").alias("counts"),
    )
    classes = materialize(grouped.select("set_key", "one.*", "least", "n", "counts"))
    posted = materialize(postings(documents, levels, width, percent))
    spans = posted.groupBy("shingle").agg(F.min("set_key").alias("low"), F.max("set_key").alias("high"))
    hits = materialize(posted.join(spans.filter("low <> high").select("shingle"), "shingle").distinct())
    pivots = materialize(_pivots(hits))
    others = hits.join(pivots, "shingle").filter("pivot <> set_key")
    stars = others.select(F.col("pivot").alias("a"), F.col("set_key").alias("b")).distinct()
    stars = materialize(_of_like_size(stars, classes, percent))
    linked = materialize(verified(materialize(_bounded(stars, classes, percent)), documents, classes, width, percent))
    # What is left of the posting lists without their pivots, which have been compared with all of them.
    near = components(linked).withColumnRenamed("node", "set_key")
    placed = (
        others.join(near, "set_key", "left")
        .join(classes.select("set_key", "n"), "set_key")
        .select("shingle", "pivot", "set_key", "n", F.coalesce("component", "set_key").alias("component"))
    )
    spans = placed.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    open_lists = placed.join(spans.filter("low <> high").select("shingle"), "shingle")
    # Lists of one pivot hold much the same classes: each class meets the others of its pivot once.
    open_pivots = materialize(open_lists.select("pivot", "set_key", "n", "component").distinct())
    # Read in every round of the last components.
    links = materialize(linked.unionByName(_block_links(open_pivots, documents, classes, width, percent)))
    named = classes.select("set_key", "least").join(
        components(links).withColumnRenamed("node", "set_key"), "set_key", "left"
    )
    named = named.withColumn("component", F.coalesce("component", "set_key"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    ids = materialize(named.select("set_key", "component").join(least, "component"))
    full = members.filter("n > 0").select("doc_id", "text_hash", "n", "set_key").join(ids, "set_key")
    empty = members.filter("n = 0").select(
        "doc_id", "text_hash", "n", F.lit(None).cast("bigint").alias("component"), F.col("doc_id").alias("component_id")
    )
    return full.select(empty.columns).unionByName(empty)


def _pivots(hits: DataFrame) -> DataFrame:
    """(shingle, pivot): of each posting list a class that shares most postings. Any choice gives the same components."""
    ranked = hits.join(hits.groupBy("set_key").agg(F.count(F.lit(1)).alias("rank")), "set_key")
    return ranked.groupBy("shingle").agg(F.max_by("set_key", "rank").alias("pivot"))


def _of_like_size(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sizes allow a link, tested before the wider count vectors are joined."""
    size = lambda name: classes.select(F.col("set_key").alias(name), F.col("n").alias(f"n_{name}"))
    near = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    return pairs.join(size("a"), "a").join(size("b"), "b").filter(near).select("a", "b")


def jaccard_components(documents: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``documents`` (doc_id, text).

    Two documents link when ``100 * |A and B| >= percent * |A or B|``; the component id is the smallest doc_id
    that links reach. A text that is null or has no words has an empty set and links with nothing. Rows
    that repeat a doc_id are documents of their own; a null doc_id is never a component's id unless all are null.
    """
    return groups(documents, width, percent).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def one_per_group(documents: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """The rows of ``documents`` without near duplicates: of each component the smallest doc_id stays.

    Documents without words are groups of their own and all stay.
    """
    found = groups(documents, width, percent)
    order = F.struct(F.col("doc_id").isNull().alias("_last"), "doc_id", "text_hash")
    one = found.filter("n > 0").groupBy("component").agg(F.min(order).alias("one"))
    empty = found.filter("n = 0").select("doc_id", "text_hash").distinct()
    kept = one.select("one.doc_id", "one.text_hash", F.lit(True).alias("_single")).unionByName(
        empty.withColumn("_single", F.lit(False))
    )
    hashed = documents.select(
        whole_row(documents).alias("_row"), F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("_hash")
    ).alias("d")
    k = kept.alias("k")
    same = (F.col("d._hash") == F.col("k.text_hash")) & F.col("d.doc_id").eqNullSafe(F.col("k.doc_id"))
    # A row that is repeated with its id and text is a near duplicate of itself.
    number = F.row_number().over(Window.partitionBy("doc_id", "_hash").orderBy(F.lit(0)))
    joined = hashed.join(k, same).select("d.*", "k._single").withColumn("_n", number)
    return joined.filter("NOT _single OR _n = 1").select("_row.*")
