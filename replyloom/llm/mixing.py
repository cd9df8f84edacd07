"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

A source's target is its share of a common budget. A target of several times the source's size is met by
complete epochs first; what is left is a weighted sample without replacement: every document gets an
exponential key divided by its quality weight, documents are taken in key order until their sizes, summed in
that order, reach what is left.

The sorted prefix sums are never built for a whole source. Sizes are summed per key cell in two levels
(``CELLS`` each), so that only the documents of the one cell that holds the cut are ordered by key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from replyloom.operators.ordering import number_rows
from replyloom.llm.rows import whole_row
from replyloom.session import materialize

SPACE = r"\x20\x09-\x0D"
CELLS = 1024
HASH_RANGE = 2**52


def count_words(text: Column) -> Column:
    """Number of maximal runs of other than white space (null: 0), without building an array of them."""
    led = F.concat(F.lit(" "), text)
    without_first = F.regexp_replace(led, f"(?<=[{SPACE}])[^{SPACE}]", "")
    return F.coalesce(F.char_length(led) - F.char_length(without_first), F.lit(0)).cast("bigint")


def uniform(key: Column, seed: int) -> Column:
    """A number in (0, 1) that depends on ``key`` alone, so that reruns and retries agree."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")))), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 1) / F.lit(float(HASH_RANGE + 1))


def quality(text: Column, least: float = 0.05) -> Column:
    """A weight in [least, 1]: the square of the share of letters and white space (null or empty: least)."""
    plain = F.char_length(F.regexp_replace(text, r"[^\p{L}\x20\x09-\x0D]+", ""))
    share = plain / F.nullif(F.char_length(text), F.lit(0))
    return F.greatest(F.coalesce(share * share, F.lit(0.0)), F.lit(least))


def measured(documents: DataFrame, seed: int = 17) -> DataFrame:
    """(doc_id, source, _size in words, the exponential key _key), and ``_row`` where there is one."""
    key = -F.ln(uniform(F.col("doc_id"), seed)) / quality(F.col("text"))
    own = [c for c in ("_row",) if c in documents.columns]
    return documents.select(*own, "doc_id", "source", count_words(F.col("text")).alias("_size"), key.alias("_key"))


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """(source, source_size, target) of a table with one row (source, source_size) per source.

    Sources in code point order, null last, get the weights in turn and share ``share`` of all sizes. A
    target stops at ``most`` times its source's size and the excess goes to the others by weight, until
    none is above. Only sums over the sources reach the driver.
    """
    keyed = sizes.withColumn("_null", F.col("source").isNull().cast("int"))
    turn = ((F.col("_n") - 1) % len(weights)).cast("int")
    table = materialize(
        number_rows(keyed, [], ["_null", "source"], "_n").select(
            "source",
            F.col("source_size").cast("bigint").alias("source_size"),
            F.get(F.array(*[F.lit(float(w)) for w in weights]), turn).alias("_w"),
        )
    )
    # A source is full when its size divided by its weight is small, so full sources stay full.
    limit = F.col("source_size") * F.lit(float(most))
    budget = share * float(table.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0])
    level, full = 0.0, -1
    while True:
        is_full = F.lit(full >= 0) & (F.col("_w") * F.lit(level) >= limit)
        row = table.agg(
            F.count_if(is_full).alias("n"),
            F.coalesce(F.sum(F.when(is_full, limit)), F.lit(0.0)).alias("given"),
            F.coalesce(F.sum(F.when(~is_full, F.col("_w"))), F.lit(0.0)).alias("w"),
        ).first()
        if row.n == full or row.w == 0:
            return table.select("source", "source_size", F.least(F.col("_w") * F.lit(level), limit).alias("target"))
        level, full = (budget - row.given) / row.w, row.n


def fit_mix(
    rows: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """What the mix takes of each source: one row per source, to be applied by ``passes``.

    ``rows`` (doc_id, source, _size, _key) should be a written table, it is read several times. ``target`` is met
    by ``epochs`` complete passes and a sample of ``_rest`` words. Documents are taken by key, then doc_id,
    then size; the last one is taken when that brings the sum nearer to the rest. ``_cut`` is the key cell in
    which the sample ends and ``_last`` the last document taken in that cell.
    """
    sums = rows.groupBy("source").agg(F.sum("_size").alias("source_size"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.try_divide("target", "source_size"))).otherwise(0)
    targets = materialize(
        source_targets(sums, weights, share, most)
        .withColumn("epochs", whole.cast("bigint"))
        .withColumn("_rest", F.col("target") - F.col("epochs") * F.col("source_size"))
        .withColumn("_s", _named(F.col("source")))
    )
    placed = (
        rows.select("doc_id", "_size", "_key", _cell().alias("_cell"), _named(F.col("source")).alias("_s"))
        .withColumn("_high", F.floor(F.col("_cell") / CELLS))
        .join(targets.select("_s", "_rest"), "_s")
    )
    sums = [F.sum("_size").alias("n"), F.max("_rest").alias("_rest")]
    high = _cut(placed.groupBy("_s", "_high").agg(*sums), "_high")
    inside = placed.join(high.select("_s", F.col("_at").alias("_high"), "_before"), ["_s", "_high"])
    per_cell = inside.groupBy("_s", "_cell").agg(*sums, F.max("_before").alias("_start"))
    cuts = materialize(_cut(per_cell, "_cell", "_start").select("_s", F.col("_at").alias("_cut"), "_before"))
    order = Window.partitionBy("_s").orderBy("_key", "doc_id", "_size").rowsBetween(Window.unboundedPreceding, 0)
    last = (
        placed.join(cuts.withColumnRenamed("_cut", "_cell"), ["_s", "_cell"])
        .withColumn("_sum", F.col("_before") + F.sum("_size").over(order))
        .filter("2 * _sum - _size <= 2 * _rest")
        .groupBy("_s")
        .agg(F.max(F.struct("_key", "doc_id", "_size")).alias("_last"))
    )
    return targets.join(cuts.drop("_before"), "_s", "left").join(last, "_s", "left").drop("source", "_rest")


def _named(source: Column) -> Column:
    """A source as a key that is never null."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def _cell() -> Column:
    """Keys in order are cells in order: 1 - exp(-key) lies in (0, 1)."""
    place = -F.expm1(-F.col("_key")) * CELLS * CELLS
    return F.least(F.floor(place), F.lit(CELLS * CELLS - 1)).cast("bigint")


def passes(rows: DataFrame, fitted: DataFrame) -> DataFrame:
    """Add ``source_size``, ``target`` and ``passes``, how often the mix takes a document.

    Each source's decision is a comparison with its last document, so rows are neither sorted nor moved
    once Spark finds ``fitted``, a table of one row per source, small enough to broadcast. Beyond that it splits hot sources.
    """
    sampled = (F.col("_cell") < F.col("_cut")) | (
        (F.col("_cell") == F.col("_cut")) & (F.struct("_key", "doc_id", "_size") <= F.col("_last"))
    )
    joined = rows.withColumns({"_s": _named(F.col("source")), "_cell": _cell()}).join(fitted, "_s")
    return joined.withColumn(
        "passes", F.col("epochs") + F.coalesce(sampled, F.lit(False)).cast("bigint")
    ).select(*rows.columns, "source_size", "target", "passes")


def mix(documents: DataFrame, seed: int = 17, **shares) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken.

    A null text has size 0 and a null source is a source. Documents without words are taken for nothing, rows
    that are equal are taken as one would be, at the cut both or one. An empty table gives an empty table.
    """
    rows = materialize(measured(documents.select("doc_id", "source", "text"), seed))
    taken = (F.col("_size") * F.col("passes")).alias("taken")
    out = passes(rows, materialize(fit_mix(rows, **shares)))
    return out.select("doc_id", "source", F.col("_size").alias("size"), "source_size", "target", taken)


def mixed_documents(documents: DataFrame, seed: int = 17, **shares) -> DataFrame:
    """The documents themselves, each as often as the mix takes it; those not drawn are left out."""
    rows = materialize(measured(documents.select("doc_id", "source", "text"), seed))
    whole = documents.select(whole_row(documents).alias("_row"), "doc_id", "source", "text")
    drawn = passes(measured(whole, seed), materialize(fit_mix(rows, **shares))).filter("passes > 0")
    times = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("passes")))
    return drawn.select("_row", times).select("_row.*")


def _cut(sums: DataFrame, cell: str, start: str | None = None) -> DataFrame:
    """The cell of each source in which the running sum reaches the rest, and the sum before that cell."""
    order = Window.partitionBy("_s").orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(order), F.lit(0)) + (F.col(start) if start else F.lit(0))
    return (
        sums.withColumn("_before", before)
        .filter((F.col("_before") <= F.col("_rest")) & (F.col("_rest") < F.col("_before") + F.col("n")))
        .select("_s", F.col(cell).alias("_at"), "_before")
    )
