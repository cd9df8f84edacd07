"""Exact most frequent word runs from mergeable summaries of bounded size.

Every task keeps a fixed number of counters (Misra-Gries): a counter is never above the true count, and below it by at
most the task's stated error. Summaries are added up by term, errors over all tasks. A term can be among the first k
only if its counter and the summed error reach the k-th largest counter, so only such terms are counted again. Terms
without any counter have at most the summed error, which must lie below the k-th largest counter; where it
does not, the summaries are taken again with more counters, and what is still open is counted in full.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replyloom.functions.text import ngrams
from replyloom.functions.vectors import cut
from replyloom.operators.ordering import first_rows
from replyloom.session import materialize

#: Counters per task and run length, tried one after the other.
COUNTERS = (1 << 17, 1 << 20)
#: Items that wait in a task before they are added to its counters.
WAITING = 1 << 19


class Summary:
    """Counters of one task. ``error`` bounds by how much a counter, or a term without one, may be too low."""

    def __init__(self, counters: int):
        self.counters = counters
        self.error = 0
        self.terms = pa.array([], pa.string())
        self.counts = np.empty(0, dtype=np.int64)
        self._waiting: list[pa.Array] = []
        self._held = 0

    def add(self, items: pa.Array) -> None:
        self._waiting.append(items)
        self._held += len(items)
        if self._held >= WAITING:
            self.settle()

    def settle(self) -> None:
        """Add what waits to the counters, then lower all of them by as much as leaves no more than there may be."""
        if not self._held:
            return
        fresh = pc.value_counts(pa.chunked_array(self._waiting, pa.string()))
        self._waiting, self._held = [], 0
        table = pa.table(
            {
                "term": pa.chunked_array([self.terms, fresh.field("values")]),
                "n": pa.chunked_array([pa.array(self.counts, pa.int64()), fresh.field("counts")]),
            }
        )
        table = table.group_by("term").aggregate([("n", "sum")])
        terms, counts = table.column("term").combine_chunks(), table.column("n_sum").to_numpy()
        if len(counts) > self.counters:
            place = len(counts) - self.counters - 1
            lowered = int(np.partition(counts, place)[place])
            kept = counts > lowered
            terms, counts = terms.filter(pa.array(kept)), counts[kept] - lowered
            self.error += lowered
        self.terms, self.counts = terms, counts


def word_runs(words: pa.ListArray, n: int) -> pa.Array:
    """Blank-joined runs of ``n`` neighbouring words of every row, one after the other."""
    return placed_runs(words, n)[1]


def placed_runs(words: pa.ListArray, n: int) -> tuple[np.ndarray, pa.Array]:
    """The row of every run, and the runs of ``n`` neighbouring words."""
    flat = words.flatten()
    row = pc.list_parent_indices(words).to_numpy()
    if n == 1:
        return row, flat
    count = len(flat) - n + 1
    if count <= 0:
        return row[:0], flat.slice(0, 0)
    inside = row[:count] == row[n - 1 :]
    kept = pa.array(inside)
    return row[:count][inside], pc.binary_join_element_wise(*[flat.slice(i, count).filter(kept) for i in range(n)], " ")


def summaries(rows: DataFrame, words: str, lengths: Sequence[int], counters: int) -> DataFrame:
    """(n, term, low): each task's counters, and with a null term its error. At most ``counters + 1`` rows per task and length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = {n: Summary(counters) for n in lengths}
        for batch in cut(batches):
            for n in lengths:
                own[n].add(word_runs(batch.column(0), n))
        for n in lengths:
            summary = own.pop(n)
            summary.settle()
            terms = pa.concat_arrays([summary.terms, pa.array([None], pa.string())])
            low = np.append(summary.counts, summary.error)
            columns = [pa.array(np.full(len(low), n), pa.int64()), terms, pa.array(low, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["n", "term", "low"])

    return rows.select(words).mapInArrow(run, "n BIGINT, term STRING, low BIGINT")


def recount(rows: DataFrame, words: str, candidates: Mapping[int, Sequence[str]]) -> DataFrame:
    """(n, term, occurrences) of the candidates of each run length, counted in full."""
    shared = rows.sparkSession.sparkContext.broadcast({n: pa.array(t, pa.string()) for n, t in candidates.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        counts = {n: np.zeros(len(t), dtype=np.int64) for n, t in wanted.items()}
        # The candidates are looked up once per slice, so slices are as long as what waits elsewhere.
        for batch in cut(batches, 0, WAITING):
            for n, terms in wanted.items():
                at = pc.drop_null(pc.index_in(word_runs(batch.column(0), n), value_set=terms)).to_numpy()
                counts[n] += np.bincount(at, minlength=len(terms))
        for n, terms in wanted.items():
            columns = [pa.array(np.full(len(terms), n), pa.int64()), terms, pa.array(counts[n])]
            yield pa.RecordBatch.from_arrays(columns, names=["n", "term", "occurrences"])

    counted = rows.select(words).mapInArrow(run, "n BIGINT, term STRING, occurrences BIGINT")
    return counted.groupBy("n", "term").agg(F.sum("occurrences").alias("occurrences"))


def _counted(rows: DataFrame, words: str, lengths: Sequence[int]) -> DataFrame:
    """(n, term, occurrences) of all runs, one shuffled row per distinct run and task."""

    def tagged(n: int) -> Column:
        return F.transform(ngrams(F.col(words), n), lambda t: F.struct(F.lit(n).cast("bigint").alias("n"), t.alias("term")))

    every = rows.select(F.inline(F.concat(*[tagged(n) for n in lengths])))
    return every.groupBy("n", "term").agg(F.count(F.lit(1)).alias("occurrences"))


def _ranked(counts: DataFrame, top: Mapping[int, int], by: str) -> DataFrame:
    """The first rows of each length: as many as ``top`` says, ties alphabetical."""
    ranked = first_rows(counts, ["n"], [F.desc(by), "term"], max(top.values()), keep="rank")
    wanted = F.lit(False)
    for n, k in top.items():
        wanted = wanted | ((F.col("n") == n) & (F.col("rank") <= k))
    return ranked.filter(wanted).drop("rank")


def top_runs(rows: DataFrame, words: str, top: Mapping[int, int], counters: Sequence[int] = COUNTERS) -> DataFrame:
    """(n, term, occurrences): the ``top[n]`` most frequent runs of ``n`` words, ties alphabetical.

    ``rows`` is read once for the summaries and, where a summary left something out, once more to count the candidates; a
    null array has no runs. Shuffled are at most ``counters`` rows per task and length. The driver holds the candidates, at most
    ``counters`` terms of a length.
    """
    found, left = [], {n: k for n, k in top.items() if k > 0}
    for size in counters:
        if not left:
            break
        merged = materialize(summaries(rows, words, list(left), size).groupBy("n", "term").agg(F.sum("low").alias("low")))
        errors = {r.n: r.low for r in merged.filter("term IS NULL").collect()}
        terms = merged.filter("term IS NOT NULL")
        reached = _ranked(terms, left, "low").groupBy("n").agg(F.min("low").alias("least"), F.count(F.lit(1)).alias("k")).collect()
        least = {r.n: r.least if r.k == left[r.n] else 0 for r in reached}
        exact = [n for n in left if not errors.get(n, 0)]
        if exact:
            whole = terms.filter(F.col("n").isin(exact)).withColumnRenamed("low", "occurrences")
            found.append(_ranked(whole, {n: left[n] for n in exact}, "occurrences"))
        open_ = F.lit(False)
        for n in left:
            if n not in exact and least.get(n, 0) > errors[n]:
                open_ = open_ | ((F.col("n") == n) & (F.col("low") + errors[n] >= least[n]))
        chosen = terms.filter(open_)
        sizes = {r.n: r["count"] for r in chosen.groupBy("n").count().collect()}
        fitting = [n for n, count in sizes.items() if count <= size]
        candidates: dict[int, list[str]] = {n: [] for n in fitting}
        for row in chosen.filter(F.col("n").isin(fitting)).select("n", "term").collect() if fitting else []:
            candidates[row.n].append(row.term)
        if candidates:
            found.append(_ranked(recount(rows, words, candidates), {n: left[n] for n in candidates}, "occurrences"))
        left = {n: k for n, k in left.items() if n not in exact and n not in candidates}
    if left:
        found.append(_ranked(_counted(rows, words, list(left)), left, "occurrences"))
    if not found:
        return _counted(rows, words, [1]).limit(0)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.select("n", "term", "occurrences")
