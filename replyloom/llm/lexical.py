"""Ranked lexical search over posting lists in geometric blocks, exact for any number of documents.

A document is a vector with one integer per term of the queries: the term's share of its score. Documents are cut into
shards of bounded size, where they lie. In a shard each term's posting list is clustered by the similarity of its documents into
blocks, and a block keeps the coordinatewise maximum of its vectors. For a query the sum of a block's maxima
over the query's terms bounds every score in it: a block is skipped only when this bound is below the score that
is already sure to be reached k times. Terms whose greatest shares together stay below it need no list at all.

That score is found first: the documents with a query's rarest terms are scored, and the k-th best of all of them is a lower bound.
Nothing is dealt by term, so a term that most documents hold costs a task no more than its own documents.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from replyloom.operators.ordering import first_rows
from replyloom.session import materialize

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
#: Characters of a text that are split at a time, and of the queries that are searched in one pass over the documents.
WINDOW = 1 << 20
QUERY_CHARS = 1 << 22
#: Postings of a shard, documents of a block, coordinates of the sketch that blocks are clustered by, queries with common summaries.
SHARD_POSTINGS = 1 << 19
BLOCK = 64
SKETCH = 16
QUERY_GROUP = 256


def term_counts(text: str) -> Counter:
    """How often each term stands in a text; only A-Z are lower-cased."""
    if len(text) <= WINDOW:
        return Counter(TERM.findall(text.translate(_LOWER)))
    counts: Counter = Counter()
    start = 0
    while start < len(text):
        end = min(len(text), start + WINDOW)
        # A window ends where a term does.
        while end < len(text) and TERM.match(text, end):
            end = TERM.match(text, end).end()
        counts.update(TERM.findall(text[start:end].translate(_LOWER)))
        start = end
    return counts


@dataclass
class Queries:
    """Queries with their terms as numbers, and what is known of the terms after the documents were read."""

    ids: list
    terms: list[np.ndarray]
    vocabulary: dict[str, int]
    k: int
    weights: np.ndarray | None = None
    documents: int = 0
    length: int = 0
    #: Per query the terms whose documents are scored first, and the score that is then sure to be reached.
    probes: list[np.ndarray] = field(default_factory=list)
    least: np.ndarray | None = None


def read_queries(rows: list[tuple], k: int) -> Queries:
    """Queries of (id, text) rows; each row is a query of its own."""
    found = [(i, sorted(term_counts(text or ""))) for i, text in rows]
    vocabulary = {t: n for n, t in enumerate(sorted({t for _, terms in found for t in terms}))}
    terms = [np.array([vocabulary[t] for t in own], dtype=np.int64) for _, own in found]
    return Queries([i for i, _ in found], terms, vocabulary, k, least=np.ones(len(found), dtype=np.int64))


def forward_rows(documents: DataFrame, queries: Queries, key: str, text: str) -> DataFrame:
    """(key, n, terms, tfs) of every document with a term: its length in terms, and which of the queries' terms it holds how often."""
    shared = documents.sparkSession.sparkContext.broadcast(queries.vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        names = vocabulary.keys()
        for batch in batches:
            lengths, offsets, terms, tfs = [], [0], [], []
            for value in batch.column(1):
                counts = term_counts(value.as_py() or "")
                lengths.append(sum(counts.values()))
                held = counts.keys() & names
                terms.extend(map(vocabulary.__getitem__, held))
                tfs.extend(map(counts.__getitem__, held))
                offsets.append(len(terms))
            at = pa.array(offsets, pa.int32())
            lists = [pa.ListArray.from_arrays(at, pa.array(v, t)) for v, t in ((terms, pa.int32()), (tfs, pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lengths, pa.int64()), *lists], names=["key", "n", "terms", "tfs"]
            )

    kind = documents.schema[key].dataType.simpleString()
    chosen = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return chosen.mapInArrow(run, f"key {kind}, n BIGINT, terms ARRAY<INT>, tfs ARRAY<BIGINT>").filter("n > 0")


def weigh(queries: Queries, forward: DataFrame) -> None:
    """Weights of the terms, and each query's rarest terms with at least k documents together where it has so many."""
    sizes = forward.agg(F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
    queries.documents, queries.length = int(sizes.documents), int(sizes.length)
    # One row per term of the queries.
    held = forward.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).toPandas()
    df = np.zeros(len(queries.vocabulary), dtype=np.int64)
    df[held["term"].to_numpy()] = held["df"].to_numpy()
    weight = [math.floor(1000 * math.log((2 * queries.documents + 2) / (2 * n + 1))) for n in df.tolist()]
    queries.weights = np.array(weight, dtype=np.int64)
    queries.probes = []
    for terms in queries.terms:
        own = terms[(df[terms] > 0) & (queries.weights[terms] > 0)]
        own = own[np.argsort(df[own], kind="stable")]
        queries.probes.append(own[: 1 + int(np.searchsorted(np.cumsum(df[own]), queries.k))])


@dataclass
class Shard:
    """Documents as sparse rows: row r has the entries ``starts[r]`` to ``starts[r + 1]``; and the same by term."""

    keys: list
    starts: np.ndarray
    terms: np.ndarray
    shares: np.ndarray

    @staticmethod
    def of(table: pa.Table, queries: Queries) -> Shard:
        table = table.combine_chunks()
        lists = [table.column(name).combine_chunks() for name in ("terms", "tfs")]
        lengths = lists[0].value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        terms, tf = (c.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in lists)
        # Python's integers, since the product may be wider than 64 bits.
        m = [10 + 90 * n * queries.documents // queries.length for n in table.column("n").to_pylist()]
        m = np.repeat(np.array(m, dtype=np.int64), lengths)
        shares = queries.weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
        return Shard(table.column("key").to_pylist(), np.append(0, np.cumsum(lengths)), terms, shares)

    def entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of all entries of the rows, and where each row's begin among them."""
        lengths = self.starts[rows + 1] - self.starts[rows]
        ends = np.cumsum(lengths)
        return np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[rows] - ends + lengths, lengths), ends - lengths

    def scores(self, rows: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Summed shares of the ``wanted`` terms (flags by term) of rows that have entries."""
        at, begin = self.entries(rows)
        return np.add.reduceat(np.where(wanted[self.terms[at]], self.shares[at], 0), begin)


class Best:
    """The best k (score, key) of every query; equal scores by key, null keys last."""

    def __init__(self, queries: Queries):
        self.k = queries.k
        self.least = queries.least.copy()
        self.held: list[list[tuple]] = [[] for _ in queries.ids]

    def offer(self, query: int, keys: list, scores: np.ndarray) -> None:
        good = np.flatnonzero(scores >= self.least[query])
        if not len(good):
            return
        ranked = [(-int(scores[i]), keys[i] is None, keys[i] or 0) for i in good]
        self.held[query] = sorted(self.held[query] + ranked)[: self.k]
        if len(self.held[query]) == self.k:
            self.least[query] = max(self.least[query], -self.held[query][-1][0])

    def batch(self, kind: pa.DataType) -> pa.RecordBatch:
        rows = [(q, None if null else key, -score) for q, held in enumerate(self.held) for score, null, key in held]
        columns = list(zip(*rows)) or [[], [], []]
        arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int32(), kind, pa.int64()))]
        return pa.RecordBatch.from_arrays(arrays, names=["query", "key", "score"])


def probe(shard: Shard, queries: Queries, best: Best) -> None:
    """Score the documents that hold one of a query's probe terms."""
    order = np.argsort(shard.terms, kind="stable")
    by_term = shard.terms[order]
    row_of = np.repeat(np.arange(len(shard.keys)), np.diff(shard.starts))
    wanted = np.zeros(len(queries.vocabulary), dtype=bool)
    for q, terms in enumerate(queries.probes):
        low, high = np.searchsorted(by_term, terms), np.searchsorted(by_term, terms, side="right")
        rows = np.unique(np.concatenate([row_of[order[a:b]] for a, b in zip(low, high)])) if (high > low).any() else []
        if len(rows):
            wanted[queries.terms[q]] = True
            best.offer(q, [shard.keys[r] for r in rows], shard.scores(rows, wanted))
            wanted[queries.terms[q]] = False


@dataclass
class Blocks:
    """One posting list: rows block by block, where blocks begin, and their maxima of the summarised terms."""

    rows: np.ndarray
    begin: np.ndarray
    columns: np.ndarray
    summary: np.ndarray


class BlockedShard:
    """Posting lists of a shard; a list is clustered when a query needs it, for the terms of the queries of one group."""

    def __init__(self, shard: Shard, terms: int):
        self.shard = shard
        self.row_of = np.repeat(np.arange(len(shard.keys)), np.diff(shard.starts))
        self.order = np.argsort(shard.terms, kind="stable")
        self.present, self.begin = np.unique(shard.terms[self.order], return_index=True)
        self.end = np.append(self.begin[1:], len(self.order))
        self.most = np.maximum.reduceat(shard.shares[self.order], self.begin) if len(self.order) else self.begin
        self.sketch = self._sketches()
        self.column = np.full(terms, -1, dtype=np.int64)
        self.blocks: dict[int, Blocks] = {}
        self.seen = self.skipped = 0

    def _sketches(self) -> np.ndarray:
        """Unit vectors of few coordinates whose products follow those of the documents."""
        mixed = self.shard.terms * 0x9E3779B1 & 0xFFFFFFFF
        mixed ^= mixed >> 15
        sign = np.where(mixed & 1, 1.0, -1.0)
        place = self.row_of * SKETCH + (mixed >> 4) % SKETCH
        out = np.bincount(place, sign * self.shard.shares, len(self.shard.keys) * SKETCH).reshape(-1, SKETCH)
        return out / np.maximum(np.linalg.norm(out, axis=1), 1e-9)[:, None]

    def list_of(self, at: int, summarised: np.ndarray) -> Blocks:
        """Blocks of the list of the ``at``-th present term: rows go to the most similar of evenly spread rows of the list."""
        if at not in self.blocks:
            rows = self.row_of[self.order[self.begin[at] : self.end[at]]]
            if len(rows) > BLOCK:
                centres = rows[:: -(-len(rows) // -(-len(rows) // BLOCK))]
                nearest = (self.sketch[rows] @ self.sketch[centres].T).argmax(axis=1)
                by_centre = np.argsort(nearest, kind="stable")
                rows, nearest = rows[by_centre], nearest[by_centre]
                first = np.searchsorted(nearest, nearest)
                # A cluster of more rows than a block holds is several blocks.
                block = np.arange(len(rows)) - first
                begin = np.flatnonzero(block % BLOCK == 0)
            else:
                begin = np.zeros(1, dtype=np.int64)
            self.column[summarised] = np.arange(len(summarised))
            entries, _ = self.shard.entries(rows)
            sizes = np.diff(np.append(begin, len(rows)))
            of_row = np.repeat(np.arange(len(begin)), sizes)
            of_entry = np.repeat(of_row, self.shard.starts[rows + 1] - self.shard.starts[rows])
            column = self.column[self.shard.terms[entries]]
            kept = column >= 0
            summary = np.zeros(len(begin) * len(summarised), dtype=np.int64)
            np.maximum.at(summary, of_entry[kept] * len(summarised) + column[kept], self.shard.shares[entries[kept]])
            self.column[summarised] = -1
            self.blocks[at] = Blocks(rows, begin, summarised, summary.reshape(len(begin), -1))
        return self.blocks[at]

    def search(self, query: int, queries: Queries, together: dict[int, np.ndarray], best: Best) -> None:
        """Offer every document of the shard that can be among the query's best."""
        terms = queries.terms[query]
        at = np.searchsorted(self.present, terms)
        at = at[(at < len(self.present)) & (self.present[np.minimum(at, len(self.present) - 1)] == terms)]
        at = at[np.argsort(self.most[at], kind="stable")]
        reach = np.cumsum(self.most[at])
        done = np.zeros(len(self.shard.keys), dtype=bool)
        wanted = np.zeros(len(queries.vocabulary), dtype=bool)
        wanted[terms] = True
        # Lists of the greatest shares first; what holds only terms before ``i`` reaches ``reach[i]`` at most.
        for i in range(len(at) - 1, -1, -1):
            if reach[i] < best.least[query]:
                break
            blocks = self.list_of(int(at[i]), together[int(self.present[at[i]])])
            bounds = blocks.summary[:, np.searchsorted(blocks.columns, terms)].sum(axis=1)
            open_blocks = bounds >= best.least[query]
            self.seen += len(bounds)
            self.skipped += int((~open_blocks).sum())
            sizes = np.diff(np.append(blocks.begin, len(blocks.rows)))
            rows = blocks.rows[np.repeat(open_blocks, sizes)]
            rows = rows[~done[rows]]
            if len(rows):
                done[rows] = True
                best.offer(query, [self.shard.keys[r] for r in rows], self.shard.scores(rows, wanted))


def search_shard(shard: Shard, queries: Queries, best: Best) -> tuple[int, int]:
    """Search all queries in a shard; returns how many blocks were looked at and how many of them were skipped."""
    seen = skipped = 0
    for start in range(0, len(queries.ids), QUERY_GROUP):
        group = range(start, min(start + QUERY_GROUP, len(queries.ids)))
        # A block's summary has the terms of the queries that can ask for it.
        asked: dict[int, list[int]] = {}
        for q in group:
            for t in queries.terms[q].tolist():
                asked.setdefault(t, []).append(q)
        together = _Together(asked, queries)
        blocked = BlockedShard(shard, len(queries.vocabulary))
        for q in group:
            blocked.search(q, queries, together, best)
        seen, skipped = seen + blocked.seen, skipped + blocked.skipped
    return seen, skipped


class _Together(dict):
    """Per term the sorted terms of all queries that hold it."""

    def __init__(self, asked: dict[int, list[int]], queries: Queries):
        super().__init__()
        self.asked, self.queries = asked, queries

    def __missing__(self, term: int) -> np.ndarray:
        self[term] = np.unique(np.concatenate([self.queries.terms[q] for q in self.asked[term]]))
        return self[term]


def _shards(batches: Iterator[pa.RecordBatch], queries: Queries) -> Iterator[Shard]:
    held, postings = [], 0
    for batch in batches:
        start = 0
        counts = np.cumsum(batch.column(2).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
        while start < batch.num_rows:
            before = counts[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(counts - before, SHARD_POSTINGS - postings, side="right")))
            held.append(batch.slice(start, end - start))
            postings += int(counts[end - 1] - before)
            start = end
            if postings >= SHARD_POSTINGS or start < batch.num_rows:
                yield Shard.of(pa.Table.from_batches(held), queries)
                held, postings = [], 0
    if held:
        yield Shard.of(pa.Table.from_batches(held), queries)


def _found(forward: DataFrame, queries: Queries, visit) -> DataFrame:
    """(query, key, score): each task's best of every query, as ``visit`` offers them shard by shard."""
    queries_of_task = forward.sparkSession.sparkContext.broadcast(queries)
    key = forward.schema["key"]
    kind = pa.int64() if isinstance(key.dataType, T.LongType) else pa.int32()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = queries_of_task.value
        best = Best(own)
        for shard in _shards(batches, own):
            visit(shard, own, best)
        yield best.batch(kind)

    held = forward.filter(F.size("terms") > 0).select("key", "n", "terms", "tfs")
    return held.mapInArrow(run, f"query INT, key {key.dataType.simpleString()}, score BIGINT")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    return first_rows(found, ["query"], [F.desc("score"), F.col("key").asc_nulls_last()], k, keep="rank")


def ranked_documents(
    documents: DataFrame, items: DataFrame, k: int = 10, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """(item, rank, key, score): the ``k`` best documents of every item by summed term shares, from all documents.

    Equal scores go by ascending key, null keys last; only scores above 0 count, so an item may have fewer rows or none.
    Null and empty texts have no terms. Every row of ``items`` is an item of its own and every row of ``documents`` a document, also where they
    repeat. Texts of any length are read whole; empty tables give no rows; other columns of any name are not read. The items are
    searched in parts of about ``QUERY_CHARS`` characters, with a pass over the documents for each part.
    """
    chosen = items.select(F.col(item).alias("item"), F.col(item_text).alias("text"))
    parts = 1 + (chosen.agg(F.sum(F.char_length("text"))).first()[0] or 0) // QUERY_CHARS
    out = None
    for part in range(parts):
        rows = chosen.filter(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == part).collect()
        queries = read_queries(sorted(map(tuple, rows), key=repr), k)
        forward = materialize(forward_rows(documents, queries, key, text))
        weigh(queries, forward)
        for row in _ranked(_found(forward, queries, probe), k).filter(F.col("rank") == k).collect():
            queries.least[row.query] = row.score
        ranked = _ranked(_found(forward, queries, search_shard), k)
        # One row per item of this part.
        schema = T.StructType([T.StructField("query", T.IntegerType()), T.StructField(item, chosen.schema["item"].dataType)])
        names = documents.sparkSession.createDataFrame(list(enumerate(queries.ids)), schema)
        named = ranked.join(names, "query").select(item, "rank", F.col("key").alias(key), "score")
        out = named if out is None else out.unionByName(named)
    return out
