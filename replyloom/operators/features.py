"""TF-IDF features: vocabulary fitted on one table, weights for any other."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from replyloom.functions.text import model_words, ngrams
from replyloom.functions.vectors import SparseBatch, cut
from replyloom.operators.frequent import placed_runs
from replyloom.session import materialize


def _words(df: DataFrame, text: str, stop_words: Sequence[str]) -> Column:
    """The words of a text column; a column that holds arrays holds the words already."""
    is_text = isinstance(df.schema[text].dataType, T.StringType)
    return model_words(F.col(text), stop_words) if is_text else F.col(text)


def tokens(df: DataFrame, key: str, text: Column, stop_words: Sequence[str], output: str = "_tokens") -> DataFrame:
    """(key, words) of every text, written once for the steps that read the words several times."""
    return materialize(df.select(key, model_words(text, stop_words).alias(output)))


@dataclass(frozen=True)
class TfidfModel:
    """At most ``max_features`` terms with their smoothed idf."""

    terms: list[str]
    idf: list[float]
    stop_words: list[str]
    max_n: int
    rows: int

    def _terms(self, df: DataFrame, text: str) -> DataFrame:
        # Kept apart from the n-grams so that the words are extracted once per row.
        words = df.withColumn("_words", _words(df, text, self.stop_words))
        runs = F.concat(*[ngrams(F.col("_words"), n) for n in range(1, self.max_n + 1)])
        return words.withColumn("_terms", runs).drop("_words")

    def vectors(self, df: DataFrame, text: str, output: str = "features") -> DataFrame:
        """L2-normalised sparse vectors. Works row by row and needs no shuffle."""
        counts = CountVectorizerModel.from_vocabulary(self.terms, inputCol="_terms", outputCol="_tf")
        scaled = ElementwiseProduct(scalingVec=Vectors.dense(self.idf), inputCol="_tf", outputCol="_tfidf")
        unit = Normalizer(p=2.0, inputCol="_tfidf", outputCol=output)
        out = unit.transform(scaled.transform(counts.transform(self._terms(df, text))))
        return out.drop("_terms", "_tf", "_tfidf")

    def weights(self, df: DataFrame, key: str, text: str) -> DataFrame:
        """(key, position, term, weight) rows of the non-zero vector entries, again without a shuffle."""
        terms = pa.array(self.terms, pa.string())

        def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in cut(batches, 1):
                sparse = SparseBatch.of(batch.column(1))
                at = pa.array(sparse.columns, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(sparse.rows)), at, terms.take(at), pa.array(sparse.values)],
                    [key, "position", "term", "weight"],
                )

        kind = df.schema[key].dataType.simpleString()
        vectors = self.vectors(df, text, "_features").select(key, "_features")
        return vectors.mapInArrow(entries, f"`{key}` {kind}, position int, term string, weight double")


#: Distinct terms that a task holds before it sends them.
HELD_TERMS = 1 << 19


def _counted(batches: Iterator[pa.RecordBatch], max_n: int) -> Iterator[pa.RecordBatch]:
    """(term, tf, df) of the runs of up to ``max_n`` words in the rows of a task; a null term counts the rows."""
    held: list[pa.Table] = []
    rows = 0

    def combined() -> pa.Table:
        table = pa.concat_tables(held).group_by("term").aggregate([("tf", "sum"), ("df", "sum")])
        return table.rename_columns(["term", "tf", "df"])

    for batch in cut(batches):
        rows += batch.num_rows
        parts = [placed_runs(batch.column(0), n) for n in range(1, max_n + 1)]
        coded = pa.chunked_array([terms for _, terms in parts], pa.string()).combine_chunks().dictionary_encode()
        terms, codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        row = np.concatenate([r for r, _ in parts]).astype(np.int64)
        tf = np.bincount(codes, minlength=len(terms))
        df = np.bincount(np.unique(row * max(len(terms), 1) + codes) % max(len(terms), 1), minlength=len(terms))
        held.append(pa.table({"term": terms, "tf": pa.array(tf, pa.int64()), "df": pa.array(df, pa.int64())}))
        if sum(t.num_rows for t in held) >= HELD_TERMS:
            held = [combined()]
            if held[0].num_rows >= HELD_TERMS // 2:
                yield from held.pop().to_batches()
    if held:
        yield from combined().to_batches()
    yield pa.RecordBatch.from_arrays([pa.array([None], pa.string()), pa.array([rows]), pa.array([0])], names=["term", "tf", "df"])


def fit_tfidf(
    train: DataFrame,
    text: str,
    max_features: int = 10_000,
    min_df: int = 2,
    max_df: float = 0.95,
    stop_words: Sequence[str] = (),
    max_n: int = 2,
) -> TfidfModel:
    """Choose the terms and their idf = ln((1 + n) / (1 + df)) + 1.

    Tasks count terms batch by batch and send each distinct one with its term and document frequency; only the ``max_features``
    most frequent terms reach the driver.
    """
    words = train.select(_words(train, text, stop_words).alias("words"))
    counts = materialize(
        words.mapInArrow(lambda batches: _counted(batches, max_n), "term STRING, tf BIGINT, df BIGINT")
        .groupBy("term")
        .agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))
    )
    rows = counts.filter("term IS NULL").agg(F.coalesce(F.max("tf"), F.lit(0))).first()[0]
    chosen = (
        counts.filter((F.col("df") >= min_df) & (F.col("df") <= max_df * rows) & F.col("term").isNotNull())
        .orderBy(F.desc("tf"), "term")
        .limit(max_features)
        .collect()
    )
    if not chosen:
        raise ValueError("no term is left after the document-frequency limits")
    chosen.sort(key=lambda r: r.term)
    return TfidfModel(
        terms=[r.term for r in chosen],
        idf=[math.log((1 + rows) / (1 + r.df)) + 1 for r in chosen],
        stop_words=list(stop_words),
        max_n=max_n,
        rows=rows,
    )


def class_weights(df: DataFrame, label: str = "intent") -> DataFrame:
    """Balanced weights n / (classes * rows of the class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    # One row per class: small enough for a window over all of them.
    everything = Window.partitionBy()
    rows, classes = F.sum("n").over(everything), F.count(F.lit(1)).over(everything)
    return counts.select(label, "n", (rows / (classes * F.col("n"))).alias("weight"))
