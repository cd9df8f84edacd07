"""Row numbering, first rows and exact order statistics that hold up under skew."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from replyloom.session import materialize


def first_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], n: int = 1, keep: str | None = None
) -> DataFrame:
    """The first ``n`` rows of each group, with their rank as column ``keep`` when named.

    Spark keeps only ``n`` rows per group in every map task before the shuffle (WindowGroupLimit), so a
    group with a third of all rows costs no more than any other.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    rank = keep or "_rank"
    ranked = df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)
    return ranked if keep else ranked.drop(rank)


SLICES_PER_BLOCK = 1000


def number_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], output: str, slice_rows: int = 1_000_000
) -> DataFrame:
    """Dense 1-based numbers in ``order`` within ``keys`` (or over all rows when ``keys`` is empty).

    Rows are range-partitioned by key and order, so one big group spreads over many slices. Slices are
    numbered locally and shifted by the sizes of the earlier slices of the same group, which are summed in
    blocks of ``SLICES_PER_BLOCK`` slices, then over the blocks. ``df`` is computed once. At most one group
    continues from one slice into the next, so there are fewer shifts than slices.
    """
    rows = materialize(df)
    slices = max(1, -(-rows.count() // slice_rows))
    sliced = materialize(
        rows.repartitionByRange(slices, *[F.col(c) for c in [*keys, *order]]).withColumn("_slice", F.spark_partition_id())
    )
    group = [*keys, "_slice"]
    local = sliced.withColumn("_local", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    sizes = (
        sliced.groupBy(*group)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_block", F.floor(F.col("_slice") / SLICES_PER_BLOCK))
    )
    before = lambda of: of.rowsBetween(Window.unboundedPreceding, -1)
    blocks = sizes.groupBy(*keys, "_block").agg(F.sum("_rows").alias("_rows"))
    blocks = blocks.withColumn("_earlier", F.sum("_rows").over(before(Window.partitionBy(*keys).orderBy("_block"))))
    inside = F.sum("_rows").over(before(Window.partitionBy(*keys, "_block").orderBy("_slice")))
    shifts = (
        sizes.withColumn("_inside", inside)
        .alias("s")
        .join(blocks.select(*[F.col(k).alias(f"_b{i}") for i, k in enumerate([*keys, "_block"])], "_earlier").alias("b"),
              [F.col(f"s.{k}").eqNullSafe(F.col(f"b._b{i}")) for i, k in enumerate([*keys, "_block"])])
        .select(
            *[F.col(f"s.{k}").alias(f"_g{i}") for i, k in enumerate(group)],
            (F.coalesce("_inside", F.lit(0)) + F.coalesce("_earlier", F.lit(0))).alias("_shift"),
        )
        .filter("_shift > 0")
    )
    on = [F.col(k).eqNullSafe(F.col(f"_g{i}")) for i, k in enumerate(group)]
    return local.join(shifts, on, "left").select(
        *df.columns, (F.col("_local") + F.coalesce("_shift", F.lit(0))).alias(output)
    )


def order_statistics(df: DataFrame, column: str, ranks: Sequence[int], buckets: int = 1024):
    """Exact values at the given 0-based ranks of a numeric column, without sorting the data.

    Each pass is one job over the rows that are still in question. It counts rows per equal-width bucket of every
    interval that holds a wanted rank, at most ``buckets + 2`` groups per interval, and keeps the
    bucket the rank falls into, until that bucket holds a single value. Nulls are left out; a column with
    NaN or infinite values is refused, whatever its size.
    """
    values = df.select(F.col(column).alias("v")).filter("v is not null")
    whole = values.agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count("v").alias("n")).first()
    if whole.n and not (math.isfinite(whole.low) and math.isfinite(whole.high)):
        raise ValueError(f"{column} holds values that are not finite")
    # rank -> (lowest and highest value in question, rows below them)
    intervals = {rank: (whole.low, whole.high, 0) for rank in ranks}
    while wide := sorted({i for i in intervals.values() if i[0] != i[1]}):
        which, bucket = F.lit(None).cast("int"), F.lit(None).cast("bigint")
        for number, (low, high, _) in enumerate(wide):
            inside = F.col("v").between(F.lit(low), F.lit(high))
            which = F.when(inside, number).otherwise(which)
            bucket = F.when(inside, _bucket(low, high, buckets)).otherwise(bucket)
        counted = (
            values.select("v", which.alias("i"), bucket.alias("b"))
            .filter("i is not null")
            .groupBy("i", "b")
            .agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count("v").alias("n"))
            .collect()
        )
        for number, interval in enumerate(wide):
            found = sorted((row for row in counted if row.i == number), key=lambda row: row.low)
            for rank in [r for r, i in intervals.items() if i == interval]:
                below = interval[2]
                for row in found:
                    if rank < below + row.n:
                        intervals[rank] = (row.low, row.high, below)
                        break
                    below += row.n
    return [intervals[r][0] for r in ranks]


def _bucket(low, high, buckets: int) -> Column:
    """Bucket numbers that grow with the value and split any two values in the end."""
    if isinstance(low, int):
        # Integers are cut exactly: doubles would not tell neighbours beyond 2^53 apart.
        width = -(-(high - low + 1) // buckets)
        return F.floor((F.col("v").cast("decimal(38,0)") - F.lit(low)) / F.lit(width)).cast("bigint")
    start, end = float(low) / 2, float(high) / 2
    if start == end or start + (end - start) / buckets == start:
        # Few doubles lie between: count the steps from one to the next.
        step = min(math.ulp(low), math.ulp(high))
        return F.floor((F.col("v").cast("double") - F.lit(low)) / F.lit(step)).cast("bigint")
    # Halved, so that the width of the widest interval is still a finite number.
    return F.width_bucket(F.col("v").cast("double") / 2, F.lit(start), F.lit(end), F.lit(buckets))


def quantiles(df: DataFrame, column: str, probabilities: Sequence[float]) -> list[Column]:
    """Exact quantiles with linear interpolation, as columns for use in ``df.agg``; null without rows.

    ``df`` is read more than once, so it should be a table, not a long computation. Every size takes the same way,
    ``order_statistics``, which also states what happens to nulls, NaN and infinities.
    """
    rows = df.select(F.count(column)).first()[0]
    if not rows:
        return [F.lit(None).cast("double") for _ in probabilities]
    ranks = sorted({r for p in probabilities for r in _neighbours(p, rows)})
    at = dict(zip(ranks, order_statistics(df, column, ranks)))
    out = []
    for p in probabilities:
        lower, upper = _neighbours(p, rows)
        share = p * (rows - 1) - lower
        out.append(F.lit(float(at[lower]) + share * (float(at[upper]) - float(at[lower]))))
    return out


def _neighbours(p: float, rows: int) -> tuple[int, int]:
    lower = int(p * (rows - 1))
    return lower, min(lower + 1, rows - 1)


def group_quantiles(
    df: DataFrame, keys: Sequence[str], column: str, probabilities: Mapping[str, float], buckets: int = 256
) -> DataFrame:
    """Exact quantiles with linear interpolation for all groups at once: (keys, n, one column per name in ``probabilities``).

    A group of at most ``buckets`` rows is settled by its sorted values. The intervals of all larger groups are narrowed together in
    tables: each pass counts the rows of every interval that holds a wanted rank by bucket, at most ``buckets + 1`` counts an
    interval, and keeps the bucket the rank falls into, with the least and greatest value seen there, until that is a single value. Nothing about a group reaches the driver. A group with a third of all rows is counted
    in the map tasks like any other. Nulls of ``column`` are left out, so a group of nulls has no row; null keys are a group. NaN and
    infinite values are refused.
    """
    group, kind = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]), df.schema[column].dataType
    whole = isinstance(kind, T.IntegralType)
    value = F.col(column).cast("bigint" if whole else "double")
    rows = materialize(df.select(group.alias("g"), value.alias("v")).filter("v IS NOT NULL"))
    if not whole and rows.agg(F.count_if(~(F.abs("v") < float("inf")))).first()[0]:
        raise ValueError(f"{column} holds values that are not finite")
    sizes = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    # At most one group for every ``buckets`` rows.
    sizes = materialize(sizes.filter(F.col("n") > buckets))
    place = {name: F.lit(float(p)) * (F.col("n") - 1) for name, p in probabilities.items()}
    ranks = [r for at in place.values() for r in (F.floor(at), F.least(F.floor(at) + 1, F.col("n") - 1))]
    intervals = materialize(
        sizes.select("g", "low", "high", F.lit(0).cast("bigint").alias("below"), F.array_distinct(F.array(*ranks)).alias("ranks"))
    )
    settled = []
    while True:
        settled.append(intervals.filter("low = high").select("g", F.explode("ranks").alias("rank"), F.col("low").alias("v")))
        wide = intervals.filter("low < high")
        if wide.isEmpty():
            break
        intervals = materialize(_narrowed(rows, wide, buckets, whole))
    found = reduce(DataFrame.unionByName, settled)
    by_rank = found.groupBy("g").agg(F.map_from_entries(F.collect_list(F.struct("rank", F.col("v").cast("double")))).alias("at"))
    joined = sizes.select("g", "n").join(by_rank, "g")
    out = []
    for name, at in place.items():
        lower = F.element_at("at", F.floor(at))
        upper = F.element_at("at", F.least(F.floor(at) + 1, F.col("n") - 1))
        out.append((lower + (at - F.floor(at)) * (upper - lower)).alias(name))
    large = joined.select("g", "n", *out)
    small = rows.join(sizes.select("g"), "g", "left_anti").groupBy("g").agg(F.sort_array(F.collect_list("v")).alias("all"))
    small = small.select("g", "all", F.size("all").cast("bigint").alias("n"))
    out = []
    for name, at in place.items():
        lower = F.get("all", F.floor(at).cast("int")).cast("double")
        upper = F.get("all", F.least(F.floor(at) + 1, F.col("n") - 1).cast("int")).cast("double")
        out.append((lower + (at - F.floor(at)) * (upper - lower)).alias(name))
    found = large.unionByName(small.select("g", "n", *out))
    return found.select(*[F.col("g").getField(f"k{i}").alias(k) for i, k in enumerate(keys)], "n", *probabilities)


def _narrowed(rows: DataFrame, wide: DataFrame, buckets: int, whole: bool) -> DataFrame:
    """The intervals (g, low, high, below, ranks) after one more pass over the rows that lie in them."""
    # One row per group, so that a group's rows meet its intervals once.
    per_group = wide.groupBy("g").agg(F.collect_list(F.struct("low", "high", "below", "ranks")).alias("open"))
    inside = rows.join(per_group, "g").select(
        "g", "v", F.get(F.filter("open", lambda i: F.col("v").between(i["low"], i["high"])), 0).alias("i")
    )
    v, low, high = F.col("v"), F.col("i.low"), F.col("i.high")
    if whole:
        # Exact for the widest intervals of 64-bit numbers too.
        wide_decimal = lambda c: c.cast("decimal(38,0)")
        v, low, high = wide_decimal(v), wide_decimal(low), wide_decimal(high)
        bucket = F.floor((v - low) * buckets / (high - low + 1)).cast("bigint")
    else:
        # Halved, so that the width of the widest interval is finite; the narrowest has no half.
        width = high / 2 - low / 2
        bucket = F.when(width > 0, F.floor((v / 2 - low / 2) / width * buckets)).otherwise((v > low).cast("bigint"))
    counted = (
        inside.filter("i IS NOT NULL")
        .groupBy("g", F.col("i.below").alias("below"), bucket.alias("b"))
        .agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count(F.lit(1)).alias("n"), F.first("i.ranks").alias("ranks"))
    )
    earlier = Window.partitionBy("g", "below").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("below") + F.coalesce(F.sum("n").over(earlier), F.lit(0))
    placed = counted.select("g", "low", "high", "n", start.alias("start"), "ranks")
    mine = F.filter("ranks", lambda r: (r >= F.col("start")) & (r < F.col("start") + F.col("n")))
    return placed.select("g", "low", "high", F.col("start").alias("below"), mine.alias("ranks")).filter("size(ranks) > 0")
