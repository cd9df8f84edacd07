"""Vector arithmetic on ARRAY<FLOAT> columns, Arrow batch by Arrow batch."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


#: List items (words, numbers of sparse vectors) that a task works on at once.
PIECE = 1 << 18


def cut(batches: Iterator[pa.RecordBatch], at: int = 0, most: int = PIECE) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``most`` items in the lists or vectors of column ``at``.

    A batch has a fixed number of rows, so what a task holds would grow with their length. A row with more items is a slice of its own.
    """
    for batch in batches:
        column = batch.column(at)
        lists = column.field("values") if pa.types.is_struct(column.type) else column
        ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def nearest(vector: Column, labels: Sequence[str], centers: np.ndarray) -> Column:
    """Struct of the label whose centre has the largest dot product, and that product.

    The centres travel with the task, so their number must be bounded by the caller's label list.
    Ties go to the earlier label.
    """
    matrix = np.ascontiguousarray(centers, dtype=np.float64)
    names = np.array(labels, dtype=object)

    @F.arrow_udf("struct<label: string, score: double>")
    def score(batch: pa.Array) -> pa.Array:
        rows = rows_of(batch, matrix.shape[1])
        products = rows @ matrix.T
        best = products.argmax(axis=1)
        return pa.StructArray.from_arrays(
            [pa.array(names[best], pa.string()), pa.array(products[np.arange(len(best)), best])], ["label", "score"]
        )

    return score(vector)


def rows_of(batch: pa.Array, width: int) -> np.ndarray:
    """An Arrow array of equally long vectors as a matrix."""
    if batch.null_count:
        raise ValueError("vectors must not be null")
    flat = batch.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if flat.size != len(batch) * width:
        raise ValueError(f"every vector must have {width} elements")
    return flat.reshape(len(batch), width)


@dataclass(frozen=True)
class SparseBatch:
    """One Arrow batch of Spark ML vectors as coordinate arrays, rows in order."""

    rows: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    height: int

    @staticmethod
    def of(vectors: pa.StructArray) -> SparseBatch:
        indices, values = vectors.field("indices"), vectors.field("values")
        lengths = values.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        rows = np.repeat(np.arange(len(vectors)), lengths)
        # A dense vector has no indices: its values stand at 0, 1, 2 and so on.
        columns = np.arange(len(rows)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        sparse = indices.is_valid().to_numpy(zero_copy_only=False)[rows]
        columns[sparse] = indices.flatten().to_numpy(zero_copy_only=False)
        return SparseBatch(rows, columns, values.flatten().to_numpy(zero_copy_only=False), len(vectors))

    def times(self, matrix: np.ndarray) -> np.ndarray:
        """This batch (height x terms) times a dense (terms x k) matrix."""
        out = np.zeros((self.height, matrix.shape[1]))
        for j in range(matrix.shape[1]):
            out[:, j] = np.bincount(self.rows, self.values * matrix[self.columns, j], self.height)
        return out

    def transposed_times(self, matrix: np.ndarray, terms: int) -> np.ndarray:
        """The transposed batch (terms x height) times a dense (height x k) matrix."""
        out = np.zeros((terms, matrix.shape[1]))
        for j in range(matrix.shape[1]):
            out[:, j] = np.bincount(self.columns, self.values * matrix[self.rows, j], terms)
        return out
