"""Exact top-k search by inner product with a table of pivot distances.

Every vector's distances to many pivots are computed once. For a query they give, by the triangle inequality, a lower
bound of the distance to a vector, the greatest over all pivots, and so an upper bound of the inner product, which is
half of (squared norms minus squared distance). Candidates are evaluated in the order of their bounds until no bound
reaches the k-th best score found, so results are exact.

Vectors lie in blocks of bounded size, dealt by their nearest pivot. A query first searches its own block, which gives it
a score to beat; it is then sent only to the blocks whose pivot intervals allow such a score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from replyloom.session import materialize

PIVOTS = 32
#: Rows the pivots are chosen from. A documented bound; the choice affects speed only.
PIVOT_SAMPLE = 1024
BLOCK_ROWS = 4096
QUERY_ROWS = 1024
BATCH = 512


def quantised(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """(row, vec_id, dim, v): components as floor(scale * x); vectors that are null or hold null or non-finite are left out.

    ``row`` tells rows apart that share a vec_id.
    """
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    return (
        vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
        .withColumn("row", F.monotonically_increasing_id())
        .filter(F.col("embedding").isNotNull() & ~F.coalesce(bad, F.lit(True)))
        .select("row", "vec_id", F.size("embedding").alias("dim"), whole.alias("v"))
    )


def choose_pivots(rows: DataFrame, pivots: int = PIVOTS, sample: int = PIVOT_SAMPLE) -> dict[int, np.ndarray]:
    """Per dimension up to ``pivots`` vectors far from each other, from a bounded sample drawn by hash."""
    order = Window.partitionBy("dim").orderBy(F.xxhash64("vec_id", "row"), "row")
    drawn = rows.select("dim", "v", F.row_number().over(order).alias("_n")).filter(F.col("_n") <= sample).drop("_n")
    by_dim: dict[int, list] = {}
    for r in drawn.collect():
        by_dim.setdefault(r.dim, []).append(r.v)
    out = {}
    for dim, values in by_dim.items():
        points = np.unique(np.array(values, dtype=np.float64).reshape(len(values), dim), axis=0)
        chosen = [int(np.argmax(((points - points.mean(axis=0)) ** 2).sum(axis=1)))]
        nearest = ((points - points[chosen[0]]) ** 2).sum(axis=1)
        while len(chosen) < min(pivots, len(points)):
            chosen.append(int(np.argmax(nearest)))
            nearest = np.minimum(nearest, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
        out[dim] = points[chosen]
    return out


def pivot_table(rows: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Add ``cell``, the nearest pivot, ``norm2``, the squared norm, and ``d``, the distances to all pivots."""
    shared = rows.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, norms, tables = [], [], []
            for dim, v in zip(batch.column(2).to_pylist(), batch.column(3)):
                x = np.asarray(v.values.to_numpy(), dtype=np.float64)
                d = np.sqrt(((shared.value[dim] - x) ** 2).sum(axis=1))
                cells.append(int(np.argmin(d)))
                norms.append(float(x @ x))
                tables.append(d)
            added = [pa.array(cells, pa.int32()), pa.array(norms, pa.float64()), pa.array(tables, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=["row", "vec_id", "dim", "v", "cell", "norm2", "d"])

    return rows.mapInArrow(
        run, "row BIGINT, vec_id BIGINT, dim INT, v ARRAY<BIGINT>, cell INT, norm2 DOUBLE, d ARRAY<DOUBLE>"
    )


def _products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact integer inner products; floats are used while no sum can leave their exact range."""
    limit = float(np.abs(vectors).max(initial=0)) * float(np.abs(query).max(initial=0)) * max(1, vectors.shape[1])
    if limit < 2**53:
        return (vectors.astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
    return np.array([sum(int(a) * int(b) for a, b in zip(v, query)) for v in vectors], dtype=np.int64)


class Block:
    """Vectors of one block with their pivot table."""

    def __init__(self, frame: pd.DataFrame):
        self.rows = frame["row"].to_numpy()
        ids = frame["vec_id"]
        self.ids = np.where(ids.isna(), np.iinfo(np.int64).max, ids.fillna(0)).astype(np.int64)
        self.null = ids.isna().to_numpy()
        self.vectors = np.array(frame["v"].tolist(), dtype=np.int64)
        self.floats = self.vectors.astype(np.float64)
        self.norm2 = frame["norm2"].to_numpy()
        self.table = np.array(frame["d"].tolist(), dtype=np.float32)
        self.largest = float(np.abs(self.vectors).max(initial=0))

    def bounds(self, norm2: float, distances: np.ndarray) -> np.ndarray:
        """Upper bounds of the scores, a little widened so that rounding cannot exclude a vector."""
        apart = np.abs(self.table - distances.astype(np.float32)).max(axis=1).astype(np.float64)
        slack = 1e-6 * (distances.max(initial=0.0) + self.table.max(initial=0.0)) + 1e-6
        apart = np.maximum(apart - slack, 0.0)
        bound = (norm2 + self.norm2 - apart * apart) / 2
        return bound + 1e-6 * (np.abs(bound) + 1)

    def search(
        self, row: int, query: np.ndarray, norm2: float, distances: np.ndarray, k: int, beat: float
    ) -> tuple[np.ndarray, np.ndarray]:
        """Positions and scores of the k best of this block that reach ``beat``, ties to the smaller id."""
        bound = self.bounds(norm2, distances)
        open_ = np.flatnonzero((bound >= beat) & (self.rows != row))
        open_ = open_[np.argsort(-bound[open_], kind="stable")]
        limit = self.largest * float(np.abs(query).max(initial=0)) * max(1, len(query))
        best, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        for start in range(0, len(open_), BATCH):
            part = open_[start : start + BATCH]
            if len(best) == k and bound[part[0]] < scores[-1]:
                break
            if limit < 2**53:
                found = (self.floats[part] @ query.astype(np.float64)).astype(np.int64)
            else:
                found = _products(self.vectors[part], query)
            reach = found >= max(beat, scores[-1] if len(best) == k else -np.inf)
            best, scores = np.concatenate([best, part[reach]]), np.concatenate([scores, found[reach]])
            order = np.lexsort((self.null[best], self.ids[best], -scores))[:k]
            best, scores = best[order], scores[order]
        return best, scores


_FOUND = "query BIGINT, query_id BIGINT, vec_id BIGINT, score BIGINT, row BIGINT"


def _search_blocks(points: DataFrame, visits: DataFrame, k: int) -> DataFrame:
    """Results of ``visits`` (block, part, q: a query with the score to beat) in the blocks of ``points``."""

    def run(key: tuple, block: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        columns = ["query", "query_id", "vec_id", "score", "row"]
        if block.empty or queries.empty:
            return pd.DataFrame(columns=columns)
        index = Block(block)
        out = []
        for q in queries.itertuples(index=False):
            at, scores = index.search(
                q.query, np.array(q.v, dtype=np.int64), q.norm2, np.array(q.d), k, -np.inf if pd.isna(q.beat) else q.beat
            )
            ids = block["vec_id"].iloc[at].to_numpy()
            out.append(
                pd.DataFrame({"query": q.query, "query_id": q.query_id, "vec_id": ids, "score": scores, "row": index.rows[at]})
            )
        return pd.concat(out).astype({"vec_id": "Int64"})

    parts = visits.select(F.col("block").alias("_block"), F.col("part").alias("_part")).distinct()
    dealt = points.join(parts, F.col("block") == F.col("_block")).select(
        F.col("_block").alias("block"), F.col("_part").alias("part"), "row", "vec_id", "v", "norm2", "d"
    )
    return dealt.groupBy("block", "part").cogroup(visits.groupBy("block", "part")).applyInPandas(run, _FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best per query, with their rank; Spark keeps k rows per query in each task before it shuffles."""
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _upper(norm2: Column, d: Column, most: Column, low: Column, high: Column) -> Column:
    """The highest score a block allows: from the greatest gap between a query and the block's pivot intervals."""
    gaps = F.zip_with(d, F.arrays_zip(low.alias("l"), high.alias("h")), lambda x, i: F.greatest(x - i["h"], i["l"] - x, F.lit(0.0)))
    apart = F.greatest(F.array_max(gaps) - 1e-6, F.lit(0.0))
    return (norm2 + most - apart * apart) / 2 + 1e-6 * (norm2 + most + 1)


def top_k(
    vectors: DataFrame, k: int = 20, every: int = 20, pivots: int = PIVOTS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of highest inner product for each row whose id ``every`` divides.

    Ties go to the smaller vec_id. A query's own row is no candidate, other rows with its id are. Only vectors of one
    length are compared. Null ids are candidates, last among ties, and no queries. An empty table gives an empty one.
    """
    rows = materialize(quantised(vectors))
    table = materialize(pivot_table(rows, choose_pivots(rows, pivots)))
    sizes = table.groupBy("dim", "cell").agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("_blocks"))
    sub = F.pmod(F.xxhash64("row"), F.col("_blocks"))
    points = materialize(
        table.join(sizes, ["dim", "cell"]).withColumn("block", F.concat_ws("-", "dim", "cell", sub)).drop("_blocks", "cell")
    )
    part = F.pmod(F.xxhash64("row"), F.lit(1 << 20)).cast("int")
    queries = points.filter(F.col("vec_id") % every == 0).select(
        F.col("row").alias("query"), F.col("vec_id").alias("query_id"), "dim", "v", "norm2", "d", "block", part.alias("part")
    )
    queries = materialize(queries)
    chunks = max(1, -(-queries.count() // QUERY_ROWS))
    queries = queries.withColumn("part", F.col("part") % chunks)
    home = _search_blocks(points, queries.withColumn("beat", F.lit(None).cast("double")).drop("dim"), k)
    home = materialize(_best(home, k))
    beat = home.filter(F.col("rank") == k).select("query", F.col("score").cast("double").alias("beat"))
    d = F.posexplode("d").alias("p", "x")
    ranges = points.select("dim", "block", "norm2", d).groupBy("dim", "block", "p").agg(
        F.min("x").alias("low"), F.max("x").alias("high"), F.max("norm2").alias("norm2")
    )
    intervals = ranges.groupBy("dim", "block").agg(
        F.array_sort(F.collect_list(F.struct("p", "low", "high"))).alias("i"), F.max("norm2").alias("most")
    )
    intervals = materialize(
        intervals.select(
            "dim", F.col("block").alias("to"), "most", F.col("i.low").alias("low"), F.col("i.high").alias("high")
        )
    )
    upper = _upper(F.col("norm2"), F.col("d"), F.col("most"), F.col("low"), F.col("high"))
    visits = (
        queries.join(beat, "query", "left")
        .join(intervals, "dim")
        .filter((F.col("to") != F.col("block")) & (F.col("beat").isNull() | (upper >= F.col("beat"))))
        .select("query", "query_id", "v", "norm2", "d", F.col("to").alias("block"), "part", "beat")
    )
    found = _best(home.drop("rank").unionByName(_search_blocks(points, visits, k)), k)
    return found.select("query_id", "rank", "vec_id", "score")
